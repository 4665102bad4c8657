"""clickwin: incremental page-view analytics on PySpark.

Counts comma-separated content labels and dimension combinations per time
window over click logs, decides which window to run next from recorded
results, gates a window on later data having arrived, and stores results by
key so that reruns change nothing.  Everything is expressed with DataFrame /
SQL operators so Catalyst can push filters and prune columns.
"""

from clickwin.session import get_spark, scratch_path  # noqa: F401

__all__ = ["get_spark", "scratch_path"]
