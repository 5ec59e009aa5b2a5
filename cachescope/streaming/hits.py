"""Structured Streaming: S1 incremental hit detection, S2 running totals and hit rates per window.

S1.  ``applyInPandasWithState`` keyed by the run and an answer bucket.  The state maps
each exact answer of the bucket to its *prefix-maximum* rows -- (seq, g = max(0.25, 0.7 * lat), prompt hash)
with strictly increasing g -- which is all a later request needs: its source is the first earlier row
with g above its latency (binary search).  Expected state is O(log n) rows an answer when latencies arrive in
random order (O(n) only for an answer whose latencies keep rising).  ``idle_ms`` drops the answers of a bucket that
nothing has touched for so long (a processing-time timeout; such a query keeps running trigger after trigger, so it
never ends under ``availableNow``).

Numeric answers within 1e-6 are the same answer.  A bucket is 1e-3 wide; a request is judged in its own bucket only, and
an answer within the tolerance of a bucket's edge is entered in the neighbour as well, so one stateful step sees every
candidate and picks the earliest over all answers in reach.  Requests without an answer class can only be timing
hits; they are spread over keys without state.

Rows of a key inside a trigger are processed in ``seq`` order (bound a trigger by the source's admission options);
rows of later triggers are taken to be later requests (file or offset order).  Sources are named by ``seq``; where
``seq`` counts a run from 0 that is the position that batch D1 names.

S2.  ``stream_totals``: windowed counts.  ``stream_hit_rates``: the hit state above and a watermarked window after it,
chained in one query.  Spark's check of chained stateful steps refuses any step with own state before a window,
because such a step may emit rows later than their input; this one emits every row in the trigger that
brought it, so ``stream_hit_rates`` turns that check off for the session.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from cachescope.functions.grading import grade, safe_ratio
from cachescope.functions.text import NUM_TOL
from cachescope.operators.hits import (BAND_LIMIT, HIT_THRESHOLD_SEC, LATENCY_FACTOR, LATENCY_FLOOR_SEC,
                                       answer_features)

OUT_SCHEMA = ("run_id string, seq bigint, ts timestamp, latency_sec double, correct boolean, cache_hit boolean, "
              "hit_source string, src_seq bigint")
#: Per answer its class, number and number of rows; the rows of all answers behind each other.
STATE_SCHEMA = ("classes array<string>, nums array<double>, sizes array<int>, seqs array<bigint>, gs array<double>, "
                "prompts array<string>")
BUCKETS_PER_ONE = 1000
LOOSE_KEYS = 256
CHAIN_CHECK = "spark.sql.streaming.statefulOperator.checkCorrectness.enabled"


def _tracker(factor: float, floor_sec: float, hit_threshold_sec: float, idle_ms: int | None):
    columns = [c.split()[0] for c in OUT_SCHEMA.split(", ")]
    tolerance = NUM_TOL

    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known: dict[str, list] = {}
        if state.exists:
            classes, nums, sizes, *rows = (list(x) for x in state.get)
            at = np.r_[0, np.cumsum(sizes)].astype(int)
            known = {c: [n, *[part[a:b] for part in rows]] for c, n, a, b in zip(classes, nums, at[:-1], at[1:])}
        frame = pd.concat(list(pdfs), ignore_index=True).sort_values("seq", kind="stable")
        loose = key[1].startswith("-")
        seqs, lats, nums = frame["seq"].to_numpy(), frame["latency_sec"].to_numpy(), frame["ans_num"].to_numpy()
        classes, prompts, guests = frame["cls"].to_list(), frame["prompt_h"].to_list(), frame["guest"].to_numpy()
        sources, kinds = np.full(len(frame), -1), [None] * len(frame)
        for r in range(len(frame)):
            lat = lats[r]
            if loose or np.isnan(lat):
                continue
            if not guests[r]:
                for cls, (num, s, g, p) in known.items():
                    if cls != classes[r] and not abs(num - nums[r]) <= tolerance:
                        continue
                    k = bisect_right(g, lat)
                    if k < len(g) and (kinds[r] is None or s[k] < sources[r]):
                        sources[r], kinds[r] = s[k], "exact" if p[k] == prompts[r] else "semantic"
            entry = known.setdefault(classes[r], [float(nums[r]), [], [], []])
            g = max(floor_sec, lat * factor)
            if not entry[2] or g > entry[2][-1]:
                for part, value in zip(entry[1:], (int(seqs[r]), float(g), prompts[r])):
                    part.append(value)
        if not loose:
            state.update((list(known), [e[0] for e in known.values()], [len(e[1]) for e in known.values()],
                          *[[x for e in known.values() for x in e[k]] for k in (1, 2, 3)]))
            if idle_ms is not None:
                state.setTimeoutDuration(idle_ms)
        fast = lats < hit_threshold_sec
        out = frame.assign(src_seq=pd.array(sources, "Int64"), cache_hit=(sources >= 0) | fast, hit_source=[
            f"{k}_match_query_{s}" if k else "timing_based" if f else None for k, s, f in zip(kinds, sources, fast)])
        out.loc[sources < 0, "src_seq"] = pd.NA
        yield out.loc[~guests, columns]

    return fn


def _keyed(requests: DataFrame, ts: str) -> DataFrame:
    """Requests with their answer bucket; an answer near a bucket's edge stands in the neighbour as a guest."""
    x = answer_features(requests)
    x = x.withColumn("correct", grade(F.col("expected"), F.col("response"), F.col("ans_num"), F.col("ans_norm")))
    num = F.col("ans_num")
    banded = F.coalesce(F.abs(num) < BAND_LIMIT, F.lit(False)) & F.col("cls").isNotNull()
    bucket = lambda c: F.floor(c * BUCKETS_PER_ONE + 0.5)
    name = lambda c: F.concat(F.lit("#"), c.cast("string"))
    sides = F.array_distinct(F.array(*[F.struct(name(bucket(num + d)).alias("bucket"),
                                                (bucket(num + d) != bucket(num)).alias("guest"))
                                       for d in (0.0, -2 * NUM_TOL, 2 * NUM_TOL)]))
    loose = F.concat(F.lit("-"), F.pmod(F.xxhash64("seq"), F.lit(LOOSE_KEYS)).cast("string"))
    own = F.array(F.struct(F.coalesce("cls", loose).alias("bucket"), F.lit(False).alias("guest")))
    x = x.select("run_id", "seq", F.col(ts).alias("ts"), F.col("latency_sec").cast("double").alias("latency_sec"), "correct",
                 "cls", "ans_num", F.sha2(F.col("prompt"), 256).alias("prompt_h"),
                 F.explode(F.when(banded, sides).otherwise(own)).alias("_k"))
    return x.select("run_id", F.col("_k.bucket").alias("bucket"), "seq", "ts", "latency_sec", "correct", "cls", "ans_num",
                    "prompt_h", F.col("_k.guest").alias("guest"))


def stream_hits(requests: DataFrame, factor: float = LATENCY_FACTOR, floor_sec: float = LATENCY_FLOOR_SEC,
                hit_threshold_sec: float = HIT_THRESHOLD_SEC, idle_ms: int | None = None, ts: str = "ts") -> DataFrame:
    """S1 over a stream of requests (run_id, seq, prompt, response, latency_sec, expected, ts)."""
    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    x = requests.withColumn(ts, F.col(ts).cast("timestamp"))
    return _keyed(x, ts).groupBy("run_id", "bucket").applyInPandasWithState(
        _tracker(factor, floor_sec, hit_threshold_sec, idle_ms), OUT_SCHEMA, STATE_SCHEMA, "append", timeout)


def stream_hit_rates(requests: DataFrame, window: str = "1 day", watermark: str = "1 hour", ts: str = "ts",
                     **options) -> DataFrame:
    """Requests, correct answers, hits, bad hits and the rates of each (event-time window, run).

    Two stateful steps in one query: hit detection, then the window; a window is written once the watermark has
    passed it (append mode), and rows behind the watermark are dropped and counted by Spark."""
    requests.sparkSession.conf.set(CHAIN_CHECK, "false")
    h = stream_hits(requests, ts=ts, **options).withWatermark("ts", watermark)
    g = h.groupBy(F.window("ts", window).alias("w"), "run_id").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("correct").alias("correct"),
        F.count_if("cache_hit").alias("cache_hits"), F.count_if(F.col("cache_hit") & ~F.col("correct")).alias("bad_cache_hits"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "run_id", "requests", "correct",
                    "cache_hits", "bad_cache_hits", safe_ratio("cache_hits", "requests").alias("hit_rate"),
                    safe_ratio("correct", "requests").alias("correct_rate"))


def stream_totals(requests: DataFrame, window: str = "1 day", watermark: str = "1 hour",
                  ts: str = "ts", hit_threshold_sec: float = HIT_THRESHOLD_SEC) -> DataFrame:
    """Per (event-time window, run) counts of requests, correct answers and
    answers faster than the timing threshold; late rows beyond the watermark
    are dropped by Spark."""
    x = answer_features(requests)
    x = x.withColumn("correct", grade(F.col("expected"), F.col("response"), F.col("ans_num"), F.col("ans_norm")))
    # watermarks need TIMESTAMP (local-time TIMESTAMP_NTZ is read as session time)
    x = x.withColumn(ts, F.col(ts).cast("timestamp"))
    return (x.withWatermark(ts, watermark)
             .groupBy(F.window(ts, window).alias("w"), "run_id")
             .agg(F.count(F.lit(1)).alias("requests"), F.count_if("correct").alias("correct"),
                  F.count_if(F.coalesce(F.col("latency_sec") < hit_threshold_sec, F.lit(False))).alias("fast"))
             .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "run_id",
                     "requests", "correct", "fast"))
