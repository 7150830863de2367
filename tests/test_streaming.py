from pyspark.sql import functions as F

from textloom.operators.schema import record_hash
from textloom.streaming import ingest


def test_file_stream_feeds_the_batch_transforms(spark, tmp_path):
    rows = [("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 11:00:00"), ("b", "2024-01-02 09:00:00")]
    df = spark.createDataFrame(rows, "text string, at string").withColumn("collected_at", F.to_timestamp("at")).drop("at")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.read(spark, str(tmp_path / "in"), df.schema)
    seen = []
    q = ingest.run(record_hash(stream, ("text",)), lambda batch, _: seen.extend(r["record_hash"] for r in batch.select("record_hash").collect()), str(tmp_path / "cp"))
    q.awaitTermination()
    assert len(seen) == 3 and len(set(seen)) == 2
    first = ingest.first_within(record_hash(ingest.read(spark, str(tmp_path / "in"), df.schema), ("text",)))
    q = first.writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("firsts").count() == 2


def test_windowed_counts(spark, tmp_path):
    df = spark.createDataFrame([("x", "2024-01-01 10:00:00"), ("x", "2024-01-01 12:00:00"), ("y", "2024-01-05 00:00:00")], "s string, at string").withColumn("at", F.to_timestamp("at"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    counted = ingest.counts(ingest.read(spark, str(tmp_path / "in"), df.schema), "s", "at")
    q = counted.writeStream.format("memory").outputMode("complete").queryName("counted").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r["s"], r["n"]) for r in spark.table("counted").collect()} == {("x", 2), ("y", 1)}
