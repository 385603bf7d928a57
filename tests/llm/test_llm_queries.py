"""Registered queries against their SQL, and the pipeline's stages."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from emberledger.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries()[name](spark, SF)
    res = con.execute(oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = sorted(repr([r[cols.index(c)] for c in df.columns]) for r in res.fetchall())
    assert sorted(cols) == sorted(df.columns)
    assert sorted(repr(list(r)) for r in df.collect()) == want


def test_every_operator_is_registered():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES}
    assert numbers == set(range(1, 14)) and set(QUERIES) <= set(queries()) and "pipeline" in queries()


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as C

    larger = "/root/testdata/sf0.01"  # the smallest has too few labels to judge a classifier by
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    columns, first, kept = docs.columns, {r.doc_id for r in docs.collect()}, {}
    for k, (name, stage) in enumerate(C.STAGES):
        out = f"file:{tmp_path}/{k}"
        stage(spark, docs, larger).write.parquet(out)
        docs = spark.read.parquet(out)
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == columns
    assert kept["toxicity"] <= first and kept["line_dedup"] == kept["toxicity"]
    assert kept["ngram_join"] <= kept["line_dedup"] and kept["packing"] == kept["mixing"] <= kept["ngram_join"]
    labels = spark.read.parquet(f"{larger}/labels.parquet").collect()
    clean = {r.doc_id for r in labels if r.toxic == 0}
    assert len(clean - kept["toxicity"]) <= 0.01 * len(clean)
    got = C.run(spark, SF)
    assert got.columns == docs.columns and got.count() > 0
