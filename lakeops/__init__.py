"""lakeops: data-engineering operators for lakehouse-style retail data, on plain PySpark.

Every operator takes and returns DataFrames and declares a logical plan; Spark chooses the
physical one. See README.md for the map of modules.
"""

from lakeops.session import build_session, scratch_dir, tune

__all__ = ["build_session", "scratch_dir", "tune"]
