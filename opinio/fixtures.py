"""Review-shaped inputs derived from the driver tables (FIXTURES.md, part B).

The same SQL text builds a Spark frame (``spark.sql`` with the parquet tables
bound as frames) and a DuckDB common table expression for the oracles, so both
engines start from identical rows.  Placeholders ``{lineitem}`` etc. name the
base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

FIXTURE_SQL: dict[str, str] = {
    # B1: dirty review rows with exact copies
    "reviews_raw": """
WITH base AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS product_id, p.p_name AS product_name,
    CASE CAST(l.l_quantity AS INT) % 11
      WHEN 0 THEN NULL WHEN 1 THEN 'not rated' WHEN 2 THEN '4.5/5' WHEN 3 THEN '5.0 out of 5 stars'
      WHEN 4 THEN '1' WHEN 5 THEN '2.5' WHEN 6 THEN '3' WHEN 7 THEN '-2' WHEN 8 THEN '10'
      WHEN 9 THEN '0' ELSE '4' END AS rating_raw,
    CASE WHEN CAST(l.l_quantity AS INT) % 13 = 0 THEN NULL
      ELSE CAST(CAST(l.l_quantity AS INT) % 7 AS DOUBLE) + CAST(l.l_linenumber % 2 AS DOUBLE) / 2
      END AS rating,
    CASE l.l_linenumber % 7
      WHEN 0 THEN NULL WHEN 1 THEN '  GREAT product, love it!!! '
      WHEN 2 THEN 'Terrible waste: broken & useless.' WHEN 3 THEN 'My glove is goodish, not BAD...'
      WHEN 4 THEN 'ok!' WHEN 5 THEN 'Best of the cheap ones' ELSE 'Arrived on time' END
      || CASE WHEN l.l_linenumber % 7 = 4 THEN '' ELSE ' ' || p.p_name END AS review
  FROM {lineitem} l
  JOIN {orders} o ON l.l_orderkey = o.o_orderkey
  JOIN {part} p ON l.l_partkey = p.p_partkey)
SELECT * FROM base
UNION ALL
SELECT * FROM base WHERE product_id % 50 = 0
""",
    # B2: long multilingual text, one row per document
    "doc_reviews": """
SELECT d.doc_id, d.text AS review, d.lang,
  CAST(1 + d.doc_id % 5 AS INT) AS rating, l.quality, l.toxic
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
""",
    # B3: keyed mutation log
    "cell_log": """
SELECT event_id AS seq, CAST(user_id AS STRING) AS row_key, 'info' AS family,
  event_type AS qualifier,
  CASE WHEN event_id % 97 = 0 THEN 'delete_row' WHEN event_id % 7 = 0 THEN 'delete_column'
    ELSE 'put' END AS op,
  CASE WHEN event_id % 97 = 0 OR event_id % 7 = 0 THEN NULL ELSE CAST(value AS STRING) END AS value
FROM {events}
""",
    # B4: fixed scores for the error metric
    "predictions": """
SELECT o.o_custkey AS user_id, l.l_partkey AS product_id,
  CAST(1 + CAST(l.l_quantity AS INT) % 5 AS DOUBLE) AS rating,
  CAST(2 + l.l_linenumber % 4 AS DOUBLE) / 2 + 1 AS prediction
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
""",
    # B5: flat recommendation lists without a model
    "recs_flat": """
SELECT user_id, product_id, predicted_rating, rn FROM (
  SELECT user_id, product_id, predicted_rating,
    CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY predicted_rating DESC, product_id) AS INT) AS rn
  FROM (SELECT o.o_custkey AS user_id, l.l_partkey AS product_id,
          MAX(CAST(l.l_quantity AS DOUBLE)) / 8 AS predicted_rating
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
        GROUP BY o.o_custkey, l.l_partkey) t) u
WHERE rn <= 5
""",
}

FIXTURE_TABLES: dict[str, tuple[str, ...]] = {
    "reviews_raw": ("lineitem", "orders", "part"),
    "doc_reviews": ("documents", "labels"),
    "cell_log": ("events",),
    "predictions": ("lineitem", "orders"),
    "recs_flat": ("lineitem", "orders"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build fixture ``name`` in Spark from the parquet tables under ``sf_dir``."""
    if name == "recs_nested":
        return recs_nested(fixture(spark, sf_dir, "recs_flat"))
    frames = {t: table(spark, sf_dir, t) for t in FIXTURE_TABLES[name]}
    return spark.sql(FIXTURE_SQL[name], **frames)


def recs_nested(recs_flat: DataFrame) -> DataFrame:
    """B5 in nested form: ``user_id, recommendations array<struct<product_id, rating>>``.

    The list of each user holds at most five entries (``rn <= 5``), so the
    per-user collect is bounded.  Entries are ordered by ``rn``.
    """
    entry = F.struct(
        F.col("rn"),
        F.col("product_id").cast("int").alias("product_id"),
        F.col("predicted_rating").cast("float").alias("rating"),
    )
    return (
        recs_flat.groupBy(F.col("user_id").cast("int").alias("user_id"))
        .agg(F.array_sort(F.collect_list(entry)).alias("_l"))
        .select(
            "user_id",
            F.transform("_l", lambda e: F.struct(e["product_id"].alias("product_id"), e["rating"].alias("rating"))).alias(
                "recommendations"
            ),
        )
    )


def duck_cte(name: str) -> str:
    """Fixture text with the plain table names DuckDB has registered."""
    return FIXTURE_SQL[name].format(**{t: t for t in BASE_TABLES})
