"""Streaming results equal batch results, across a restart."""

import os
import shutil

from pyspark.sql import functions as F

from cachescope.operators.hits import detect_hits
from cachescope.session import ensure_checkpoint_dir
from cachescope.sources.tables import request_log
from cachescope.streaming.hits import stream_hit_rates, stream_hits, stream_totals
from conftest import SF001


def _write_parts(spark, log, folder, n_parts=3):
    """The log as ``n_parts`` files in seq order (file order = arrival order)."""
    os.makedirs(folder)
    rows = log.withColumn("_part", F.ntile(n_parts).over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.orderBy("seq")))
    names = []
    for k in range(1, n_parts + 1):
        tmp = f"{folder}_tmp{k}"
        rows.where(F.col("_part") == k).drop("_part").coalesce(1).write.parquet(tmp)
        part = [f for f in os.listdir(tmp) if f.endswith(".parquet")][0]
        names.append(f"{folder}/part-{k:03d}.parquet")
        shutil.copy(f"{tmp}/{part}", names[-1])
    return names


def _run(spark, src, schema, out, ckpt, fn, mode="append"):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (fn(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()


def test_stream_hits_equal_batch_after_restart(spark, scratch):
    log = request_log(spark, SF001)
    parts = _write_parts(spark, log, f"{scratch}/all")
    src = f"{scratch}/src"
    os.makedirs(src)
    for p in parts[:2]:
        shutil.copy(p, src)
    ckpt = f"{ensure_checkpoint_dir(spark)}/s1-{os.path.basename(scratch)}"
    out = f"{scratch}/out"
    _run(spark, src, log.schema, out, ckpt, stream_hits)
    shutil.copy(parts[2], src)  # restart from the checkpoint with one more file
    _run(spark, src, log.schema, out, ckpt, stream_hits)

    got = spark.read.parquet(out).select("run_id", "seq", "cache_hit", "src_seq", "correct")
    want = detect_hits(log).select("run_id", "seq", "cache_hit", "src_seq", "correct")
    assert got.count() == want.count() == log.count()
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


def near_answers(spark, n=240):
    """A log whose numeric answers lie 4e-7 to 2.4e-6 apart, also across bucket edges; seq counts each run from 0."""
    import random
    rng = random.Random(4)
    rows = []
    for run in ("a", "b"):
        for k in range(n):
            base = rng.choice([1.0, 2.0005, -3.0004999, 7.25])
            text = f"Answer: {base + rng.choice([0, 4e-7, 8e-7, 1.2e-6, 2.4e-6, -4e-7]):.10f}"
            text = rng.choice([text, text, text, "Paris", None, "Answer: 99999999999999999999.5"])
            rows.append((run, k, f"q{rng.randrange(40)}", text, rng.choice([0.05, 0.2, 0.4, 0.9, 1.7, 3.0]) * rng.uniform(0.5, 1.5), ["1"],
                         1_700_000_000 + 60 * k))
    df = spark.createDataFrame(rows, "run_id string, seq long, prompt string, response string, latency_sec double, "
                                     "expected array<string>, t long")
    return df.withColumn("ts", F.timestamp_seconds("t")).drop("t")


def test_stream_hits_within_tolerance_equal_batch_after_restart(spark, scratch):
    log = near_answers(spark)
    parts = _write_parts(spark, log, f"{scratch}/all")
    src = f"{scratch}/src"
    os.makedirs(src)
    ckpt, out = f"{ensure_checkpoint_dir(spark)}/s1n-{os.path.basename(scratch)}", f"{scratch}/out"
    for some in (parts[:2], parts[2:]):
        for p in some:
            shutil.copy(p, src)
        _run(spark, src, log.schema, out, ckpt, stream_hits)
    cols = ["run_id", "seq", "cache_hit", "hit_source", "correct"]
    got, want = spark.read.parquet(out).select(*cols), detect_hits(log).select(*cols)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert want.where("hit_source like 'semantic%'").count() > 50


def test_stream_hit_rates_equal_batch_and_drop_late_rows(spark, scratch):
    log = near_answers(spark)
    parts = _write_parts(spark, log, f"{scratch}/all", 4)
    late = log.where("seq < 3").withColumn("seq", F.col("seq") + 10_000)             # far behind the watermark by then
    end = log.where("seq = 0").withColumn("seq", F.lit(20_000).cast("long")).withColumn(
        "ts", F.col("ts") + F.expr("interval 30 days"))                            # closes the other windows
    more = [_write_parts(spark, d, f"{scratch}/m{k}", 1)[0] for k, d in enumerate((late, end))]
    src = f"{scratch}/src"
    os.makedirs(src)
    for k, p in enumerate(parts + more):
        shutil.copy(p, f"{src}/part-{k:03d}.parquet")
        os.utime(f"{src}/part-{k:03d}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (stream_hit_rates(stream, "1 hour", "10 minutes").writeStream.format("parquet").option("path", f"{scratch}/out")
         .option("checkpointLocation", f"{ensure_checkpoint_dir(spark)}/s2n-{os.path.basename(scratch)}")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    assert dropped > 0                                              # counted per window and run, after partial sums
    want = detect_hits(log).join(log.select("run_id", "seq", F.col("ts").alias("_t")), ["run_id", "seq"]).groupBy(
        F.window("_t", "1 hour").start.alias("window_start"), "run_id").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("cache_hit").alias("cache_hits"))
    cols = ["window_start", "run_id", "requests", "cache_hits"]
    got = spark.read.parquet(f"{scratch}/out")
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
    assert all(r.hit_rate == r.cache_hits / r.requests for r in got.collect())


def test_stream_totals_equal_batch(spark, scratch):
    log = request_log(spark, SF001)
    _write_parts(spark, log, f"{scratch}/src")
    ckpt = f"{ensure_checkpoint_dir(spark)}/s2-{os.path.basename(scratch)}"
    name = "s2_" + os.path.basename(scratch).replace("-", "_")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/src")
    q = (stream_totals(stream, window="1 day", watermark="400 days").writeStream.format("memory")
         .queryName(name).option("checkpointLocation", ckpt).outputMode("complete")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table(name)
    want = stream_totals(log, window="1 day", watermark="400 days")
    cols = ["window_start", "run_id", "requests", "correct", "fast"]
    assert want.count() > 0
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert want.select(*cols).exceptAll(got.select(*cols)).count() == 0
