"""File sources and sinks (SRC-1..5, SNK-1..3, SNK-6) and lineage cuts."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from opinio.session import scratch_dir

# CSV writer options that keep values byte-exact on a round trip,
# and the run layout (sub-folder names and the pointer record's field).
CSV_EXACT_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
RUN_TABLES = ("cleaned_data", "sentiment_results", "recommendations")
POINTER_FIELD = "latest_path"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor never forces a recompute of what came
    before) and fixes any value that depends on task placement.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


# --- readers --------------------------------------------------------------

def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """SRC-1: header CSV; types inferred unless ``schema`` is given.

    Inference is a full extra pass over the files; at scale pass ``schema``.
    """
    reader = spark.read.option("header", "true")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return reader.csv(path)


def read_csv_multiline(spark: SparkSession, path: str, schema: StructType | str | None = None,
                       partitions: int | None = None) -> DataFrame:
    """SRC-2: quoted fields may hold newlines and doubled quotes.

    A multi-line file cannot be split, so each file is one task; the
    ``repartition`` spreads the rows before the heavy steps.
    """
    reader = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    df = reader.csv(path)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SRC-4: a Parquet folder read with a declared schema (columns the files lack read as null)."""
    return spark.read.schema(schema).parquet(path)


def declare_table(spark: SparkSession, name: str, path: str, schema: StructType) -> DataFrame:
    """SRC-4, catalog form: an external Parquet table over ``path``; one that is already declared is kept as it is."""
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet LOCATION '{place}'")
    return spark.table(name)


def analyze_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> None:
    """Row count, size and column statistics into the catalog, for the plans of later reports (one scan)."""
    which = "ALL COLUMNS" if columns is None else "COLUMNS " + ", ".join("`" + c.replace("`", "``") + "`" for c in columns)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR {which}")


# --- writers --------------------------------------------------------------

def write_csv(df: DataFrame, path: str, multiline: bool = False) -> None:
    w = df.write.mode("overwrite").options(**CSV_EXACT_WRITE)
    if multiline:
        w = w.option("escape", '"')
    w.csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-1 (``overwrite``) and SNK-2 (``errorifexists``)."""
    df.write.mode(mode).parquet(path)


def save_pair(first: DataFrame, second: DataFrame, base: str,
              names: tuple[str, str] = ("user_recommendations", "product_recommendations")) -> None:
    """SNK-6: two tables under one folder, overwrite."""
    write_parquet(first, f"{base}/{names[0]}")
    write_parquet(second, f"{base}/{names[1]}")


# --- run folders and the pointer (SNK-2, SNK-3, SRC-5) -------------------

def write_run_table(df: DataFrame, run_base: str, name: str) -> str:
    """Write one table of a run; fails if the run already has it."""
    path = f"{run_base}/{name}"
    write_parquet(df, path, mode="errorifexists")
    return path


def _absent(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def publish_run(spark: SparkSession, pointer_path: str, run_base: str) -> None:
    """SNK-3: add a one-row pointer record, after every table of the run exists.

    Each publication is a new folder under ``pointer_path`` (an error if it is
    there), so nothing is overwritten and an interrupted write, which leaves no
    finished file, changes nothing for readers.
    """
    stamp = time.time_ns()
    record = spark.createDataFrame([(run_base, stamp)], f"{POINTER_FIELD} string, published long")
    record.coalesce(1).write.mode("errorifexists").json(f"{pointer_path}/{stamp:020d}")


def latest_run(spark: SparkSession, pointer_path: str) -> str | None:
    """The run folder of the newest pointer record, or None when nothing was published.

    One tiny record is brought to the driver; a damaged one is an error.
    """
    try:
        records = spark.read.schema(f"{POINTER_FIELD} string, published long").option("mode", "FAILFAST").json(f"{pointer_path}/*")
    except AnalysisException as e:
        if _absent(e):
            return None
        raise
    newest = records.orderBy(F.desc("published")).first()
    return newest[0] if newest else None


def read_run_table(spark: SparkSession, pointer_path: str, name: str) -> DataFrame | None:
    """SRC-5: table ``name`` of the latest run, or None if there is no run or no such table."""
    base = latest_run(spark, pointer_path)
    if base is None:
        return None
    try:
        return spark.read.parquet(f"{base}/{name}")
    except AnalysisException as e:
        if _absent(e):
            return None
        raise


# --- run history: every run's tables side by side, by partition --------------------

RUN_ID = "run_id"
_RUNS = "_runs"


def write_history(df: DataFrame, base: str, name: str, run_id: int) -> None:
    """One table of one run, as the partition ``run_id`` of the history's table ``name``; an error if the run has it."""
    write_parquet(df, f"{base}/{name}/{RUN_ID}={run_id}", mode="errorifexists")


def publish_history(spark: SparkSession, base: str, run_id: int) -> None:
    """Make a run visible, after all its tables are written; an error if it already is."""
    record = spark.createDataFrame([(run_id,)], f"{RUN_ID} long")
    record.coalesce(1).write.mode("errorifexists").parquet(f"{base}/{_RUNS}/{run_id}")


def published_runs(spark: SparkSession, base: str) -> DataFrame:
    """``run_id`` of every published run."""
    return spark.read.schema(f"{RUN_ID} long").option("recursiveFileLookup", "true").parquet(f"{base}/{_RUNS}")


def history(spark: SparkSession, base: str, name: str, schema: StructType) -> DataFrame:
    """Table ``name`` of all published runs with its ``run_id``; what an unfinished run has written is not seen."""
    plain = [f for f in schema.fields if f.name != RUN_ID]
    whole = spark.read.schema(StructType([*plain, StructField(RUN_ID, LongType())])).parquet(f"{base}/{name}")
    return whole.join(published_runs(spark, base), RUN_ID, "left_semi")


def latest_of_history(spark: SparkSession, base: str, name: str, schema: StructType) -> DataFrame:
    """Table ``name`` of the newest published run.

    The newest id is a scalar subquery on the partition column, so the scan lists
    and reads that run's files only.
    """
    plain = [f for f in schema.fields if f.name != RUN_ID]
    whole = spark.read.schema(StructType([*plain, StructField(RUN_ID, LongType())])).parquet(f"{base}/{name}")
    newest = published_runs(spark, base).agg(F.max(RUN_ID)).scalar()
    return whole.filter(F.col(RUN_ID) == newest).select(*[F.col("`" + c.replace("`", "``") + "`") for c in (f.name for f in plain)])
