import random

import numpy as np

from emberledger.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def test_thresholds_are_ordered_and_weights_shared():
    rng = np.random.default_rng(1)
    n = 600
    x = rng.poisson(1.0, n)
    grades = np.clip(x, 0, 2)
    rows = np.flatnonzero(x)
    w, cuts = T.fit_cumulative(rows, np.zeros(len(rows), int), x[rows].astype(float), grades, 1)
    assert w[0] > 0 and (np.diff(cuts) > 0).all()
    p = 1 - T._sigmoid(cuts[None, :] - w[0] * x[:, None])
    assert (np.rint(p.sum(axis=1)) == grades).mean() > 0.9


def test_gradient_fits_against_brute_force():
    """The fitted likelihood is at least that of nearby parameters."""
    grades = np.array([0] * 20 + [1] * 10 + [2] * 10)
    x = np.array([0.0] * 18 + [1.0] * 12 + [2.0] * 10)
    rows = np.arange(40)

    def loss(w, cuts):
        cum = np.concatenate([[-np.inf], cuts, [np.inf]])
        p = T._sigmoid(cum[grades + 1] - w * x) - T._sigmoid(cum[grades] - w * x)
        return -np.log(np.maximum(p, 1e-12)).sum() + 0.5 * w * w

    w, cuts = T.fit_cumulative(rows, np.zeros(40, int), x, grades, 1, rounds=3000, rate=0.05)
    best = loss(w[0], cuts)
    for d in (-0.2, 0.2):
        assert loss(w[0] + d, cuts) > best - 1e-3
        assert loss(w[0], cuts + np.array([d, 0])) > best - 1e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    train, held = labels.filter("doc_id % 3 <> 0"), labels.filter("doc_id % 3 = 0")
    got = T.grade_documents(docs, train).join(held.withColumnRenamed("toxic", "truth"), "doc_id").select("toxic", "truth", "expected_severity").collect()
    hit = [r.toxic for r in got if r.truth == 1]
    false = [r.toxic for r in got if r.truth == 0]
    assert sum(hit) / len(hit) >= 0.9 and sum(false) / len(false) < 0.01
    assert all(0 <= r.expected_severity <= T.GRADES - 1 for r in got)


def test_awkward_documents(spark, awkward, empty):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(50)]
    texts = [(1000 + i, " ".join(rng.choice(words) for _ in range(30)) + (" Scum!" if i % 2 else ""), i % 2) for i in range(80)]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string"))
    docs = docs.unionByName(spark.createDataFrame([(2000, "a SCUM, here")], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, y) for i, _, y in texts] + [(1, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    got = T.grade_documents(docs, labels)
    rows = {r.doc_id: r for r in got.collect()}
    assert got.count() == docs.count() and rows[2000].toxic and not rows[1].toxic and not rows[2].toxic
    kept = T.drop_toxic(docs, labels)
    assert 2000 not in {r.doc_id for r in kept.collect()} and kept.columns == docs.columns
    assert T.grade_documents(empty, labels).count() == 0
    none = T.grade_documents(docs, labels.limit(0)).collect()
    assert len(none) == docs.count() and not any(r.toxic for r in none)


def test_features_against_plain_counts(spark):
    """The chosen features and their odds, counted one document after the other."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30)] + ["vile", "Vile!", "scumbag", "scummy"]
    rows = [(i, " ".join(rng.choice(words if i % 3 == 0 else words[:31]) for _ in range(25)), int(i % 3 == 0)) for i in range(90)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    held = {0: {}, 1: {}}
    for _, t, y in rows:
        for f in T.counts(t):
            held[y][f] = held[y].get(f, 0) + 1
    n1, n0 = sum(r[2] for r in rows), sum(1 - r[2] for r in rows)
    want = {}
    for f, a in held[1].items():
        b = held[0].get(f, 0)
        odds = np.log((a + 0.5) / (n1 - a + 0.5)) - np.log((b + 0.5) / (n0 - b + 0.5))
        if a + b >= T.MIN_DOCS and odds / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) >= T.MIN_Z:
            want[f] = odds
    got = dict(T.telling_features(T.training_rows(docs, labels)))
    assert want and got.keys() == want.keys() and all(abs(got[f] - want[f]) < 1e-9 for f in want)
    # the expected grade of every document, from the fitted weights
    model = T.fit(docs, labels)
    for r in T.grade_documents(docs, labels).collect():
        text = rows[r.doc_id][1]
        score = sum(model.weights[i] * (1 + np.log(n)) for f, n in T.counts(text).items() if (i := model.names.get(f)) is not None)
        assert abs(r.expected_severity - sum(1 / (1 + np.exp(c - score)) for c in model.thresholds)) < 1e-9


def test_sample_is_bounded_and_repeats(spark):
    docs = spark.createDataFrame([(i % 40, f"t{i}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    picks = [sorted(map(tuple, T.training_rows(docs.repartition(n), labels, 5).collect())) for n in (1, 4)]
    assert picks[0] == picks[1] and 0 < len(picks[0]) <= 10


def test_executors_need_no_copy_of_the_package(spark):
    import pickle

    model = T.Model({"x": 0}, np.ones(1), np.zeros(2))
    assert b"emberledger" not in pickle.dumps(model.plain())


def test_workers_drop_what_earlier_operators_kept(spark, monkeypatch):
    """In a chain, packing's encoder stays in the workers; toxicity must not add its own memory to it."""
    import sys

    from emberledger.llm.common import per_process

    docs = spark.createDataFrame([(i, ("vile " if i % 2 else "kind ") + f"w{i % 7}") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    frame, taken = type(docs), []
    plain = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, f, *a: taken.append(f) or plain(self, f, *a))
    T.drop_toxic(docs, labels)
    T.grade_documents(docs, labels)
    assert len(taken) == 6
    for run in taken:
        per_process("test", list)
        list(run(iter([])))
        assert "_emberledger_kept" not in sys.modules


def test_drop_toxic_takes_small_batches(spark, monkeypatch):
    """Whole documents go to Python and back ``BATCH_ROWS`` at a time, also when the result is used later."""
    monkeypatch.setattr(T, "BATCH_ROWS", 7)
    docs = spark.createDataFrame([(i, ("vile " if i % 2 else "kind ") + f"w{i % 7}") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    kept = T.drop_toxic(docs, labels)
    assert "MapInArrow" not in kept._jdf.queryExecution().toString()
    model = T.fit(docs, labels)
    want = [r.doc_id for r in docs.collect() if model.expected(T.counts(r.text, model.names)) < T.REJECT]
    assert 0 < len(want) < 80 and sorted(r.doc_id for r in kept.collect()) == want
