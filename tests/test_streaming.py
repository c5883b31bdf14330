"""The streaming upsert: late rows do not replace newer ones."""


def test_late_rows_lose(spark, tmp_path):
    from turnstone.streaming.upsert import upsert_stream

    schema = "id int, at int, text string"
    batches = [[(1, 5, "five"), (2, 1, "one")], [(1, 3, "late"), (2, 1, "again"), (3, 1, "new")], [(1, 9, "nine")]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/b={k}")
        query = upsert_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*"), f"{tmp_path}/out", ["id"], "at", f"{tmp_path}/check")
        query.processAllAvailable()
        query.stop()
    versions = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert len(versions) == 2
    got = {r["id"]: r["text"] for r in spark.read.schema(schema).parquet(f"{tmp_path}/out/{versions[-1]}").collect()}
    assert got == {1: "nine", 2: "again", 3: "new"}
