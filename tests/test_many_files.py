"""Files of unknown layout stay whole documents when many are written by one task."""

from ledgerlake.plans import catalog


def test_a_file_a_group(spark, tmp_path):
    spark.range(60_000).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name").write.parquet(f"{tmp_path}/customer.parquet")
    rows = catalog.QUERIES["S11_unknown_files"](spark, str(tmp_path)).collect()
    assert len(rows) == 60_000 and {(r.c_custkey, r.format, r.name) for r in rows} == {(k, ("json", "xml", "csv")[k % 3], f"Customer#{k}") for k in range(60_000)}
