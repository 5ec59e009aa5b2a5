"""Hit detection (D1), seed/paraphrase pairing (D7), hits by source kind.

D1 semantics.  Request i of a run is a *content hit* of the first earlier
request j of the same run with the same answer and
``lat_i < max(0.25, 0.7 * lat_j)``; the source is ``exact_match_query_<pos_j>``
when the prompts are equal, else ``semantic_match_query_<pos_j>``.  Otherwise
it is a ``timing_based`` hit when ``lat_i < 0.1``, else a miss.

Plan (no pair explosion, no whole-run task):

1. answer class per row: the exact number, or the SHA-256 of the normalised
   text; ``g = max(0.25, 0.7 * lat)``.
2. positions inside the run and the running max of ``g`` over strictly earlier
   rows of the same (run, class): chunked scans (``operators.scan``).
3. *prefix-maximum* rows (``g`` above every earlier ``g`` of the class) are the
   only possible sources: the first j with ``g_j > lat_i`` is always one.  In
   random arrival order a class of n rows keeps about ln n of them.
4. each prefix-maximum row x owns the latency interval
   ``[g of the previous one, g_x)``: a request with latency in it has x as the
   first row with ``g > lat``.  A class of at most ``DIRECT`` intervals (nearly
   all) meets its requests in one equi-join on (run, class) with the interval
   as condition; at most one interval matches, and the source is valid when
   ``pos_x < pos_i``.
5. a class of more intervals is swept: its intervals and the *different*
   latencies of its requests are ordered by latency in chunks of equal depth, and
   the running maximum is the interval a latency lies in.  No interval is copied,
   and crowded or equal latencies make no large task.
6. numbers match within 1e-6, which is not transitive: distinct values of a run
   are paired with a band join on ``floor(v * 5e5)`` and its neighbours, and the
   intervals of a class go to every neighbouring class of requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachescope.functions.grading import grade
from cachescope.functions.text import NUM_TOL, final_number, is_finite, normalize_text
from cachescope.operators.scan import CHUNK_ROWS, pos_chunk, positions, running, value_chunks
from cachescope.session import cut_lineage

# Fixed values of the reference's detector.
HIT_THRESHOLD_SEC = 0.1
LATENCY_FACTOR = 0.7
LATENCY_FLOOR_SEC = 0.25

DIRECT = 64  # intervals of a class that meet each of its requests without a sweep
BAND_SCALE = 5e5          # bucket width 2e-6 > tolerance 1e-6
BAND_LIMIT = float(2 ** 33)  # above this one ulp exceeds 1e-6: only equal values match


def answer_features(log: DataFrame, response: str = "response") -> DataFrame:
    """Add ``ans_num``, ``ans_norm`` and the answer class ``cls`` once per row."""
    num = final_number(response)
    x = log.withColumn("ans_num", num).withColumn("ans_norm", normalize_text(response))
    cls = (F.when(F.col(response).isNull(), F.lit(None).cast("string"))
           .when(F.col("ans_num").isNotNull(),
                 F.when(is_finite(F.col("ans_num")), F.concat(F.lit("n:"), F.col("ans_num").cast("string"))))
           .otherwise(F.concat(F.lit("t:"), F.sha2(F.col("ans_norm"), 256))))
    return x.withColumn("cls", cls)


def _neighbour_classes(classed: DataFrame) -> DataFrame:
    """(run_id, cls, ncls): classes whose answers count as the same answer."""
    text = classed.where(F.col("ans_num").isNull()).select("run_id", "cls").distinct() \
        .withColumn("ncls", F.col("cls"))
    vals = classed.where(F.col("ans_num").isNotNull()).select("run_id", "cls", "ans_num").distinct()
    small = F.abs(F.col("ans_num")) < BAND_LIMIT
    big = vals.where(~small).select("run_id", "cls", F.col("cls").alias("ncls"))
    v = vals.where(small).withColumn("_b", F.floor(F.col("ans_num") * BAND_SCALE).cast("long"))
    left = v.select("run_id", "cls", F.col("ans_num").alias("_a"),
                    F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1)).alias("_b"))
    right = v.select("run_id", F.col("cls").alias("ncls"), F.col("ans_num").alias("_v"), "_b")
    band = left.join(right, ["run_id", "_b"]).where(F.abs(F.col("_a") - F.col("_v")) <= NUM_TOL) \
        .select("run_id", "cls", "ncls")
    return text.unionByName(big).unionByName(band)


def _swept_sources(classed: DataFrame, pm: DataFrame, nbr: DataFrame, chunk_rows: int) -> DataFrame:
    """(run_id, seq, src): the interval of every request among those of classes with many intervals."""
    probes = classed.where(F.col("latency_sec").isNotNull()).join(
        nbr.join(pm.select("run_id", "ncls").distinct(), ["run_id", "ncls"]), ["run_id", "cls"])
    key, src = F.col("latency_sec"), F.struct("src_pos", "src_seq", "src_prompt_h", "hi")
    points = probes.select("run_id", "ncls", key.alias("key")).distinct().select(
        "*", F.lit(1).alias("kind"), F.lit(None).cast(pm.select(src.alias("s")).schema["s"].dataType).alias("src"))
    starts = pm.select("run_id", "ncls", F.col("lo").alias("key"), F.lit(0).alias("kind"), src.alias("src"))
    part = ["run_id", "ncls"]
    line = value_chunks(starts.unionByName(points), part, "key", chunk_rows, "_vchunk")
    found = running(line, part, ["key", "kind"], "_vchunk", [("at", "max", F.col("src"))])
    found = found.where((F.col("kind") == 1) & (F.col("key") < F.col("at.hi"))) \
        .select("run_id", "ncls", F.col("key").alias("latency_sec"), "at")
    return probes.join(found, ["run_id", "ncls", "latency_sec"]).where(F.col("at.src_pos") < F.col("pos")) \
        .select("run_id", "seq", "prompt_h", "at.src_pos", "at.src_seq", "at.src_prompt_h")


def detect_hits(log: DataFrame, hit_threshold_sec: float = HIT_THRESHOLD_SEC,
                factor: float = LATENCY_FACTOR, floor_sec: float = LATENCY_FLOOR_SEC,
                chunk_rows: int = CHUNK_ROWS, with_grade: bool = True,
                carry: Sequence[str] | None = None, direct: int = DIRECT) -> DataFrame:
    """D1 over a request log (run_id, seq, prompt, response, latency_sec[, expected]).

    Adds pos, correct, cache_hit, hit_source, src_pos, src_seq, bad_hit.  ``carry`` names the columns
    of the log that the result keeps beside run_id, seq and latency_sec (default: all); texts that nobody
    asks for are read once and not written again.  A request without a run id is judged by its time alone.
    """
    keep = [c for c in log.columns if carry is None or c in carry or c in ("run_id", "seq", "latency_sec")]
    x = answer_features(log)
    if with_grade:
        x = x.withColumn("correct", grade(F.col("expected"), F.col("response"),
                                          F.col("ans_num"), F.col("ans_norm")))
    lat = F.col("latency_sec")
    x = x.withColumn("g", F.when(lat.isNotNull(), F.greatest(F.lit(floor_sec), lat * factor))) \
         .withColumn("prompt_h", F.unhex(F.sha2(F.col("prompt"), 256)))  # 32 bytes in every shuffle, not 64 digits
    extra = ["correct"] if with_grade else []
    if carry is None:
        extra = ["ans_num", "ans_norm", *extra]
    x = x.select(*keep, *([] if carry is None else ["ans_num"]), *extra, "cls", "g", "prompt_h")
    x = positions(x, ["run_id"], "seq", "pos", chunk_rows)
    # The per-row features feed the branches below.  Write them once to the
    # shared checkpoint folder: the regexes and the position scan run once,
    # every branch starts from a small leaf (analysis of the branches no
    # longer re-walks the whole upstream plan), and the table survives
    # executor loss.
    x = cut_lineage(x)

    classed = x.where(F.col("cls").isNotNull()).select(
        "run_id", "seq", "pos", "cls", "ans_num", "latency_sec", "g", "prompt_h")

    # prefix maxima of g per (run, class), strictly earlier rows
    pm = running(classed, ["run_id", "cls"], ["pos"], pos_chunk("pos", chunk_rows),
                 [("lo", "max", F.col("g"))], inclusive=False)
    pm = pm.where(F.col("g").isNotNull() & (F.col("lo").isNull() | (F.col("g") > F.col("lo"))))
    pm = cut_lineage(pm.select(
        "run_id", F.col("cls").alias("ncls"), F.col("pos").alias("src_pos"), F.col("seq").alias("src_seq"),
        F.col("prompt_h").alias("src_prompt_h"), "lo", F.col("g").alias("hi")))
    many = pm.groupBy("run_id", "ncls").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") > direct) \
        .select("run_id", "ncls")
    swept = not many.isEmpty()

    nbr = _neighbour_classes(classed)
    few = pm.join(many, ["run_id", "ncls"], "left_anti") if swept else pm
    inside = (F.col("lo").isNull() | (lat >= F.col("lo"))) & (lat < F.col("hi")) & (F.col("src_pos") < F.col("pos"))
    found = classed.join(few.join(nbr, ["run_id", "ncls"]), ["run_id", "cls"]).where(inside) \
        .select("run_id", "seq", "prompt_h", "src_pos", "src_seq", "src_prompt_h")
    if swept:
        found = found.unionByName(_swept_sources(
            classed, pm.join(many, ["run_id", "ncls"], "left_semi"), nbr, chunk_rows))
    first = found.groupBy("run_id", "seq").agg(
        F.min(F.struct("src_pos", F.col("src_prompt_h").eqNullSafe(F.col("prompt_h")).alias("same_prompt"),
                       "src_seq"))
        .alias("_src"))

    out = x.join(first, ["run_id", "seq"], "left")
    content = F.col("_src").isNotNull()
    timing = F.coalesce(lat < hit_threshold_sec, F.lit(False))
    source = (F.when(content, F.concat(
                F.when(F.col("_src.same_prompt"), F.lit("exact_match_query_"))
                 .otherwise(F.lit("semantic_match_query_")),
                F.col("_src.src_pos").cast("string")))
              .when(timing, F.lit("timing_based")))
    out = out.withColumn("cache_hit", content | timing) \
             .withColumn("hit_source", source) \
             .withColumn("src_pos", F.col("_src.src_pos")) \
             .withColumn("src_seq", F.col("_src.src_seq"))
    if with_grade:
        out = out.withColumn("bad_hit", F.col("cache_hit") & ~F.col("correct"))
    return out.drop("_src", "g", "prompt_h", "cls", *([] if carry is None else ["ans_num"]))


def hit_sources(hits: DataFrame) -> DataFrame:
    """Hits per run by source kind (exact / semantic / timing)."""
    kind = F.regexp_extract(F.col("hit_source"), r"^(exact_match|semantic_match|timing_based)", 1)
    return hits.where(F.col("cache_hit")).groupBy("run_id", kind.alias("source_kind")) \
        .agg(F.count(F.lit(1)).alias("hits"))


def paired_hits(seed: DataFrame, para: DataFrame, factor: float = LATENCY_FACTOR,
                floor_sec: float = LATENCY_FLOOR_SEC, keys=("run_id", "subset", "row_index"),
                carry: Sequence[str] = ()) -> DataFrame:
    """Second (paraphrase) call is a hit when the outputs are identical and
    ``lat2 < max(floor, factor * lat1)``.  Equi-join on the item key; ``carry`` names columns of ``seed`` to keep."""
    s = seed.select(*keys, *carry, F.col("response").alias("seed_output"), F.col("latency_sec").alias("seed_latency_sec"))
    p = para.select(*keys, F.col("response").alias("paraphrase_output"),
                    F.col("latency_sec").alias("paraphrase_latency_sec"))
    j = s.join(p, list(keys))
    hit = (F.col("paraphrase_output") == F.col("seed_output")) & (
        F.col("paraphrase_latency_sec") < F.greatest(F.lit(floor_sec), F.col("seed_latency_sec") * factor))
    return j.withColumn("semantic_hit_likely", F.coalesce(hit, F.lit(False)))
