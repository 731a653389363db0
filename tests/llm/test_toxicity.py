import zlib

import numpy as np

from ledgerlake.llm import toxicity


def test_held_out_accuracy_and_folds(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.op2_toxicity(spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert len(got) == docs and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got.doc_id, got.held_out))
    both = got[got.held_out].merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    hit = ((both.predicted == 1) & (both.toxic == 1)).sum()
    recall, precision = hit / (both.toxic == 1).sum(), hit / max(1, (both.predicted == 1).sum())
    print("recall", recall, "precision", precision)
    assert recall > 0.8 and precision > 0.9


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    y = rng.random(20_000) < 0.2
    v = np.stack([np.where(rng.random(len(y)) < a, y, ~y) for a in (0.9, 0.8, 0.95, 0.85)], 1).astype(int)
    v = np.hstack([v, v[:, :1]])  # a copy of the first voter: fully correlated
    model = toxicity.fit_label_model(v)
    q = model.posterior(v)
    assert np.mean((q > 0.5) == y) > 0.95
    assert model.correlation[4, 0] == model.correlation.max()


def test_edges(spark, docs_of):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    df = docs_of([(1, "you idiot moron stupid scum"), (2, "kind words"), (3, None), (None, ""), (4, "idiot " * 5000 + "moron"), (2, "kind words")])
    got = toxicity.score(df, toxicity.fit(df, labels)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 6 and by[1].predicted == 1 and by[2].predicted == 0
    assert by[3].score == by[None].score < 0.5
    assert toxicity.score(docs_of([]), toxicity.fit(docs_of([]), labels.limit(0))).collect() == []
    kept = toxicity.without_toxic(df, labels)
    assert kept.columns == df.columns and 1 not in {r.doc_id for r in kept.collect()}
