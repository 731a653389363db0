import zlib

import numpy as np

from ledgerlake.llm import quality


def test_held_out_accuracy_and_folds(spark):
    sf = "/root/testdata/sf0.1"
    got = quality.op5_quality(spark, sf).toPandas()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got.doc_id, got.held_out))
    both = got[got.held_out].merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    right = (both.predicted == both.quality).mean()
    bad = both[both.quality == 0]
    print("accuracy", right, "bad found", (bad.predicted == 0).mean(), "good kept", (both[both.quality == 1].predicted == 1).mean())
    assert right > 0.95 and (bad.predicted == 0).mean() > 0.8


def test_tables_learn_steps_and_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((6000, 4))
    y = ((x[:, 0] > 0.6) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_model(x, y)
    assert np.mean((model.score(x) > 0.5) == y) > 0.95
    assert (1, 0) in [(i, j) for i, j, _ in model.pairs]


def test_edges(spark, docs_of):
    labels = spark.createDataFrame([(1, 1, 1), (2, None, 0)], "doc_id long, quality int, toxic int")
    df = docs_of([(1, "Some words."), (2, None), (None, ""), (3, "a" * 100_000), (4, "x\n" * 9000), (1, "Some words.")])
    got = quality.score(df, quality.fit(df, labels)).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert quality.score(docs_of([]), quality.fit(docs_of([]), labels.limit(0))).collect() == []
