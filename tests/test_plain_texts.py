"""Documents are plain texts: those that could be read as JSON are hashed as they stand."""

import hashlib

from ledgerlake.plans import catalog


def test_json_like_documents(spark, tmp_path):
    texts = [(1, "src0", "[1, 2]"), (2, "src1", "[1,2]"), (3, "src1", "[1,  2]"), (5, "src2", "[1, 2]"), (7, "src1", None)]
    spark.createDataFrame(texts, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.id for r in catalog.QUERIES["S12_record_id"](spark, str(tmp_path)).collect()}
    assert got[1] == "sha256:" + hashlib.sha256(b"[1, 2]").hexdigest() and got[3] == "sha256:" + hashlib.sha256(b"[1,  2]").hexdigest()
    assert sorted(r.doc_id for r in catalog.QUERIES["S01_land_new"](spark, str(tmp_path)).collect()) == [2, 3]
