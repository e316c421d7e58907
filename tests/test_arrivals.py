from pyspark.sql import functions as F

from lumbung.streaming.arrivals import week_arrivals

AS_OF = "2026-11-26T12:00:00"
SCHEMA = "id string, pub timestamp, v string"


def rows(spark, values):
    return spark.createDataFrame(values, "id string, pub string, v string").withColumn("pub", F.to_timestamp("pub"))


def test_the_first_row_of_an_id_wins_across_batches(spark, tmp_path):
    batches = [
        [("a", "2026-11-24 10:00:00", "1"), ("b", "2026-11-29 23:59:59", "1"), ("x", "2026-11-22 23:59:59", "1"), ("n", None, "1")],
        [("a", "2026-11-28 10:00:00", "2"), ("c", "2026-11-23 00:00:00", "2"), ("y", "2026-11-30 00:00:00", "2")], [("c", "2026-11-25 00:00:00", "3"), ("d", "2026-11-26 00:00:00", "3")],
    ]
    found = {}
    for k, values in enumerate(batches):
        rows(spark, values).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        week_arrivals(stream, AS_OF).writeStream.option("checkpointLocation", str(tmp_path / "ck")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
        found = {r["id"]: r["v"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == {"a": "1", "b": "1", "c": "2", "d": "3"} and spark.read.parquet(str(tmp_path / "out")).count() == 4
    whole = rows(spark, [r for b in batches for r in b])
    assert {r["id"] for r in week_arrivals(whole, AS_OF).collect()} == set(found)
