"""cachescope: answer-reuse analytics on Spark.

Grades answers against gold labels, detects which requests were probably served
from an earlier answer, matches requests to identical or semantically close
earlier ones, and reports hit rate, wrong-hit rate, latency percentiles,
throughput and the correctness lost to bad reuse.  Everything is DataFrame /
Spark SQL code; Python workers only run user encoders, user answer functions
and the streaming state function.
"""

from cachescope.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
