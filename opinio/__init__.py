"""Review analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or a small set of
DataFrames) built from Spark's own column expressions, so Catalyst can prune,
push down and fuse the whole chain.  Only small values reach the driver (a run's
name, minima and maxima of id columns, one number per rank partition).

Subpackages
-----------
functions   column expressions (text normalisers, rating parsers, labels)
operators   frame-to-frame steps (cleaning, ranking, reports, keyed tables, ALS)
sources     readers and writers (CSV, Parquet, run folders, document collections)
plans       composed jobs and the registry of named queries
llm         operators of a training-data pipeline (optional; nothing else imports it)
"""

from opinio.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
