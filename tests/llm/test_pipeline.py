import random

import corpus_pipeline
from ledgerlake.llm import toxicity
from tests.llm.test_ngram_join import shingles


def test_stages_take_effect_and_keep_columns(spark, docs_of, sf_of):
    rng = random.Random(8)
    say = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    clean = [say(rng.randrange(20, 120)) for _ in range(60)]
    item = say(30)
    rows = list(enumerate(clean))
    rows += [(100 + i, t) for i, t in enumerate(clean[:10])]  # copies: the larger id stays
    near = {}
    for i in range(10, 20):
        w = clean[i].split()
        w[-1] = "changed"
        near[200 + i] = " ".join(w)
    rows += list(near.items())  # near copies: the smaller id stays where they link
    rows += [(300, f"{say(40)} {item} {say(40)}"), (301, "you idiot moron stupid scum loser trash"), (302, None), (303, "")]
    labels = spark.createDataFrame([(i, 1, int(i == 301)) for i, _ in rows], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    sf = sf_of(documents=docs_of(rows), labels=labels, benchmark=bench)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
    kept = {r.doc_id for r in docs.collect()}
    want = {i for i, _ in rows} - set(range(10)) - {300, 301, 302}
    for i in range(10, 20):
        a, b = shingles(clean[i]), shingles(near[200 + i])
        if 100 * len(a & b) >= 75 * len(a | b):
            want.discard(200 + i)
    assert kept == want
    final = corpus_pipeline.run(spark, sf)
    assert final.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r.doc_id for r in final.collect()} == kept


def test_toxicity_stage_equals_scores(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, sf).collect()}
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert kept == {r.doc_id for r in scored if not r.predicted}


def test_stages_meet_nulls_empty_texts_repeats_and_clashing_columns(spark, sf_of):
    clash = ["rk", "row_key", "gone_id", "gone_sha", "removed_lines", "score", "label", "h"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clash)
    row = lambda i, t: (i, t, None, None, None, *[f"own {c}" for c in clash])
    rows = [row(1, "one two three four five six seven"), row(1, "one two three four five six seven"), row(2, None), row(3, ""), row(4, " \n"), row(None, "words of a row without an id stand here"), row(None, None), row(5, "long " * 30_000)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 1, 0), (None, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "a benchmark item that no document holds at all"), (2, None), (None, "x"), (3, "")], "item_id long, text string")
    sf = sf_of(documents=docs, labels=labels, benchmark=bench)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf).collect()
        assert all(r[c] == f"own {c}" for r in out for c in clash), name
        if name != "exact_dedup":
            assert len(out) == len(rows), name
        else:  # of the empty texts that of the largest id stays; the row without an id owns its own text
            assert sorted((str(r.doc_id), r.text is None) for r in out if not (r.text or "").strip()) == [("3", False), ("4", False)]
            assert sum(r.doc_id is None for r in out) == 1 and sum(r.doc_id == 1 for r in out) == 2
        empty = stage(spark, docs.limit(0), sf)
        assert empty.columns == docs.columns and empty.collect() == [], name
    coded = {(r.doc_id, r.n_tokens > 0) for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()}
    assert (2, False) in coded and (3, False) in coded and (None, True) in coded and (5, True) in coded
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf).collect() == []
