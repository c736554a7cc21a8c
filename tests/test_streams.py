"""Windowed counts of a stream: closed windows are those of the batch, and rows that are too late don't count."""

import datetime as dt

from pyspark.sql import functions as F

from frameloom.streaming.pairs import stream_counts


def test_closed_windows_equal_the_batch_without_late_rows(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    at = lambda minutes: start + dt.timedelta(minutes=minutes)
    batches = [[(i, "ab"[i % 2], at(i)) for i in range(0, 30)], [(i, "ab"[i % 2], at(i)) for i in range(30, 90)], [(900, "a", at(3)), (901, "b", at(89)), (902, "a", at(200))], [(903, "a", at(201))]]
    schema = "i int, k string, t timestamp"
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in/*"))
    counted = stream_counts(stream, "t", ["k"], "10 minutes", "15 minutes").select(F.col("window.start").alias("start"), "k", "n")
    query = counted.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r["start"], r["k"]): r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {}
    for i, k, t in [r for b in batches[:2] for r in b] + [(901, "b", at(89))]:
        key = (start + dt.timedelta(minutes=int((t - start).total_seconds() // 600) * 10), k)
        want[key] = want.get(key, 0) + 1
    assert got == want  # the row at minute 3 came after its window was closed; the last window is still open
