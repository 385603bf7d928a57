import hashlib
from collections import defaultdict

from emberledger.llm import line_dedup as L
from emberledger.llm.common import BLANKS


def key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(BLANKS))


def brute(rows):
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            h = holders.get(key(line), ())
            keeper = max((x for x in h if x is not None), default=None)
            if len(h) < 3 or i == keeper:
                kept.append(line)
        out.append((str(i), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def check(df):
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in L.line_digests(df).collect())
    assert got == brute([(r.doc_id, r.text) for r in df.collect()])


def test_awkward_documents(spark, awkward, empty):
    check(awkward)
    assert L.line_digests(empty).count() == 0


def test_hot_lines_ties_and_long_documents(spark):
    hot = "a line that every one of them holds"
    rows = [(i, "\n".join([hot] * (i % 4) + [f"own line number {i}", "short"] * 3)) for i in range(200)]
    rows += [(7, f"{hot}\nsame id, other text"), (500, "\n".join([f"\t {hot.upper()} \r", "x"] * 300)), (None, hot)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_documents_keep_their_columns(spark, awkward):
    got = L.dedup_lines(awkward)
    assert got.columns == awkward.columns and got.count() == awkward.count()
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[1].text is None and rows[10].text == "x\ny" and rows[11].text == "z" and rows[10].n_chars == 3
