"""ALS recommender operators (ML-1..7, FLT-9, AGG-19, PRJ-4).

Training is Spark ML's blocked implementation, on a grid of blocks sized from the
ratings (:func:`als_grid`).  The lists for all users and for all products are
exact, but do not score all pairs: :mod:`opinio.operators.top_lists` stops each
list at a bound.  ``recommendForUserSubset`` is the narrower call when only some
users are needed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.operators import rank
from opinio.operators.top_lists import Lists, top_lists
from opinio.sources.files import materialize

# The two training configurations and the list length.
BATCH_ALS = {"maxIter": 10, "regParam": 0.01, "nonnegative": True, "implicitPrefs": False,
             "coldStartStrategy": "drop"}
UNIVERSAL_ALS = {"maxIter": 5, "regParam": 0.1, "coldStartStrategy": "drop"}
LIST_LENGTH = 5
TRAIN_RATIO = 0.8
MIN_DISTINCT = 2
DEFAULT_RANK = 10


def as_int_id(column: str) -> Column:
    """``column`` as INT; an id that is not one (too wide, or text) is an error, never a null."""
    c = F.col(column)
    usable = c.try_cast("int")
    message = F.concat(F.lit(f"{column} cannot be an INT id, index it first: "), c.cast("string"))
    return F.when(c.isNotNull() & usable.isNull(), F.raise_error(message)).otherwise(usable).cast("int")


def rating_triples(df: DataFrame, user: str = "user_id", item: str = "product_id", rating: str = "rating",
                   rating_out: str = "rating") -> DataFrame:
    """PRJ-4 / FLT-2: ``(INT, INT, FLOAT)`` triples; rows with a missing id or rating are dropped.

    Ids beyond INT or of text are refused; :func:`indexed_triples` takes those.
    """
    return df.select(
        as_int_id(user).alias("user_id"),
        as_int_id(item).alias("product_id"),
        F.col(rating).try_cast("float").alias(rating_out),
    ).dropna()


@dataclass
class Indexed:
    """Triples on dense INT indexes, and the tables ``(_k, index)`` that lead back to the ids."""
    triples: DataFrame
    users: DataFrame
    items: DataFrame


def indexed_triples(df: DataFrame, user: str = "user_id", item: str = "product_id", rating: str = "rating",
                    rating_out: str = "rating") -> Indexed:
    """PRJ-4 for ids of any type: each id's dense rank among the ids of the kept rows stands for it."""
    kept = materialize(df.select(F.col(user).alias("user_id"), F.col(item).alias("product_id"),
                                 F.col(rating).try_cast("float").alias(rating_out)).dropna(), "triples")
    users = materialize(rank.key_ranks(kept, "user_id", "index"), "user-index")
    items = materialize(rank.key_ranks(kept, "product_id", "index"), "item-index")
    u, p = users.toDF("user_id", "user_index"), items.toDF("product_id", "item_index")
    joined = kept.join(u, "user_id").join(p, "product_id")
    triples = joined.select(F.col("user_index").alias("user_id"), F.col("item_index").alias("product_id"), rating_out)
    return Indexed(triples, users, items)


def with_original_ids(flat: DataFrame, ids: Indexed) -> DataFrame:
    """A flat list table with the original ids in place of the indexes."""
    u = ids.users.select(F.col("_k").alias("_user"), F.col("index").alias("user_id"))
    p = ids.items.select(F.col("_k").alias("_item"), F.col("index").alias("product_id"))
    joined = flat.join(u, "user_id").join(p, "product_id")
    named = {"user_id": F.col("_user").alias("user_id"), "product_id": F.col("_item").alias("product_id")}
    return joined.select(*[named.get(c, F.col(c)) for c in flat.columns])


def needs_index(df: DataFrame, columns: tuple[str, ...] = ("user_id", "product_id")) -> bool:
    """Whether an id column holds anything but INT values (two numbers per column to the driver, none for small types)."""
    kinds = {c: df.schema[c].dataType.typeName() for c in columns}
    if any(k not in ("byte", "short", "integer", "long") for k in kinds.values()):
        return True
    wide = [c for c, k in kinds.items() if k == "long"]
    if not wide:
        return False
    row = df.agg(*[f(c) for c in wide for f in (F.min, F.max)]).first()
    return any(x is not None and not -(1 << 31) <= x < 1 << 31 for x in row)


def split(triples: DataFrame, ratio: float = TRAIN_RATIO) -> tuple[DataFrame, DataFrame]:
    """ML-1: split by a hash of the triple, so it is the same on any layout, cluster and engine.

    A triple goes to training if the first four hex digits of its MD5 are below
    ``ratio``; equal triples therefore fall on one side.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in triples.columns])
    low = F.substring(F.md5(text), 1, 4) < F.lit(format(math.ceil(ratio * 65536), "04x"))
    return triples.filter(low), triples.filter(~low)


def split_counts(train: DataFrame, test: DataFrame) -> DataFrame:
    """AGG-19: ``part, records`` for the two halves."""
    return (train.agg(F.count(F.lit(1)).alias("records")).select(F.lit("train").alias("part"), "records")
            .unionByName(test.agg(F.count(F.lit(1)).alias("records")).select(F.lit("test").alias("part"), "records")))


@dataclass
class Fitted:
    model: ALSModel
    rating_col: str
    params: dict


# What one rating, one id and one number of a factor take in a block, and an empty builder of a grid cell.
_RATING_BYTES, _ID_BYTES, _FACTOR_BYTES, _CELL_BYTES = 16, 24, 4, 256
# Spark's own number of blocks, and the ratings that are worth a block of their own.
MIN_BLOCKS = 10
RATINGS_PER_BLOCK = 1_000_000


def task_bytes(spark: SparkSession) -> int:
    """Memory for execution that one task can count on, from the session's executor (or local driver) settings."""
    conf = spark.sparkContext.getConf()
    local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    memory = conf.get("spark.driver.memory" if local else "spark.executor.memory", "1g").strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(memory[-1:], 0)
    heap = int(float(memory.rstrip("kmgt")) * (1 << unit))
    tasks = spark.sparkContext.defaultParallelism if local else int(conf.get("spark.executor.cores", "1"))
    return int(heap * float(conf.get("spark.memory.fraction", "0.6"))) // max(1, tasks)


def als_grid(ratings: int, users: int, items: int, rank_: int, memory: int, parallelism: int) -> tuple[int, int]:
    """Blocks of users and of items for a fit, from the data and the memory of a task.

    A block holds its share of the ratings, its ids with their factors, and the
    factors of the other side that its ratings name; that must fit in a quarter of
    ``memory``.  Beyond that need, a block for every ``RATINGS_PER_BLOCK`` ratings
    is worth a task of its own, up to ``parallelism``.  Every map task keeps a
    builder for each cell of the grid, and all of them must fit in half of
    ``memory``: where they would not, both sides get fewer, larger blocks.
    """
    room = max(1, memory // 4)

    def need(own: int, other: int) -> int:
        blocks = 1
        while True:
            share = -(-ratings // blocks)
            size = share * _RATING_BYTES + (-(-own // blocks) + min(other, share)) * (_ID_BYTES + rank_ * _FACTOR_BYTES)
            if size <= room or blocks >= max(1, ratings):
                return blocks
            blocks = max(blocks + 1, min(2 * blocks, int(blocks * size / room)))

    wanted = max(MIN_BLOCKS, min(parallelism, -(-ratings // RATINGS_PER_BLOCK)))
    user_blocks, item_blocks = max(wanted, need(users, items)), max(wanted, need(items, users))
    cells = max(MIN_BLOCKS**2, memory // 2 // _CELL_BYTES)
    shrink = min(1.0, (cells / (user_blocks * item_blocks)) ** 0.5)
    return max(MIN_BLOCKS, int(user_blocks * shrink)), max(MIN_BLOCKS, int(item_blocks * shrink))


def grid_for(triples: DataFrame, rank_: int) -> tuple[int, int]:
    """The grid for these triples; one aggregate of them (ids are counted approximately)."""
    spark = triples.sparkSession
    row = triples.agg(F.count(F.lit(1)), F.approx_count_distinct("user_id"), F.approx_count_distinct("product_id")).first()
    return als_grid(*row, rank_, task_bytes(spark), spark.sparkContext.defaultParallelism)


def train(triples: DataFrame, rating_col: str = "rating", params: dict | None = None, seed: int | None = None) -> Fitted:
    """ML-2 / ML-3: fit ALS on ``user_id, product_id, <rating_col>``.

    The grid of blocks follows the ratings, not the width of a shuffle;
    ``numUserBlocks`` and ``numItemBlocks`` in ``params`` override it.  The triples
    are read twice, so pass a written table.
    """
    p = dict(BATCH_ALS if params is None else params)
    if not {"numUserBlocks", "numItemBlocks"} <= set(p):
        user_blocks, item_blocks = grid_for(triples, p.get("rank", DEFAULT_RANK))
        p = {"numUserBlocks": user_blocks, "numItemBlocks": item_blocks} | p
    als = ALS(userCol="user_id", itemCol="product_id", ratingCol=rating_col, **p)
    if seed is not None:
        als = als.setSeed(seed)
    return Fitted(als.fit(triples), rating_col, p)


def has_enough_variety(triples: DataFrame, minimum: int = MIN_DISTINCT) -> bool:
    """FLT-9: at least ``minimum`` distinct users and items (one aggregate, a few numbers to the driver).

    For the usual minimum of two, "at least two distinct values" is
    ``min < max``: a partial min/max aggregate, with no distinct shuffle
    over the whole table.  Larger minimums count distinct values exactly.
    """
    if minimum <= 2:
        row = triples.agg(F.min("user_id").alias("u0"), F.max("user_id").alias("u1"),
                          F.min("product_id").alias("i0"), F.max("product_id").alias("i1")).first()
        if row is None or row["u0"] is None or row["i0"] is None:
            return False
        if minimum <= 1:
            return True
        return row["u0"] < row["u1"] and row["i0"] < row["i1"]
    row = triples.agg(F.count_distinct("user_id").alias("u"), F.count_distinct("product_id").alias("i")).first()
    return row is not None and row["u"] >= minimum and row["i"] >= minimum


def factors(fitted: Fitted) -> DataFrame:
    """ML-2 output: ``side, id, features`` for both factor tables."""
    m = fitted.model
    return (m.userFactors.select(F.lit("user").alias("side"), "id", "features")
            .unionByName(m.itemFactors.select(F.lit("item").alias("side"), "id", "features")))


def user_lists(fitted: Fitted, n: int = LIST_LENGTH) -> Lists:
    """ML-4 as ``(query, item, score)`` with the share of pairs that was scored."""
    return top_lists(fitted.model.userFactors, fitted.model.itemFactors, n)


def product_lists(fitted: Fitted, n: int = LIST_LENGTH) -> Lists:
    """ML-5 as ``(query, item, score)``; the products ask, the users are the candidates."""
    return top_lists(fitted.model.itemFactors, fitted.model.userFactors, n)


def nested_user_lists(fitted: Fitted, n: int = LIST_LENGTH) -> DataFrame:
    """ML-4 nested: ``user_id, recommendations array<struct<product_id, rating>>``, best first."""
    return nested(user_lists(fitted, n).rows)


def nested(rows: DataFrame) -> DataFrame:
    """Rows of :func:`user_lists` as one list a user, best first, ties by product."""
    # at most n entries a user
    entry = F.struct((-F.col("score")).alias("_order"), F.col("item").alias("product_id"), F.col("score").cast("float").alias("rating"))
    lists = rows.groupBy(F.col("query").alias("user_id")).agg(F.array_sort(F.collect_list(entry)).alias("_l"))
    plain = F.transform("_l", lambda e: F.struct(e["product_id"].alias("product_id"), e["rating"].alias("rating")))
    return lists.select("user_id", plain.alias("recommendations"))


def explode_user_lists(nested: DataFrame) -> DataFrame:
    """PRJ-6 / SCL-13: one row per (user, product) with the score as ``predicted_rating``."""
    e = nested.select("user_id", F.explode("recommendations").alias("rec"))
    return e.select("user_id", F.col("rec.product_id").alias("product_id"),
                    F.col("rec.rating").alias("predicted_rating"))


def user_recommendations(fitted: Fitted, n: int = LIST_LENGTH) -> DataFrame:
    """ML-4 flat: ``user_id, product_id, predicted_rating``."""
    return flat(user_lists(fitted, n).rows)


def flat(rows: DataFrame) -> DataFrame:
    """Rows of :func:`user_lists` under their public names."""
    return rows.select(F.col("query").alias("user_id"), F.col("item").alias("product_id"),
                       F.col("score").cast("float").alias("predicted_rating"))


def recommendations_for(fitted: Fitted, users: DataFrame, n: int = LIST_LENGTH) -> DataFrame:
    """Flat top-``n`` lists for the users in ``users`` only (``recommendForUserSubset``).

    Scores only the listed users against every item, instead of all users.
    """
    return explode_user_lists(fitted.model.recommendForUserSubset(users.select("user_id").distinct(), n))


def top_users_per_product(fitted: Fitted, n: int = LIST_LENGTH) -> DataFrame:
    """ML-5: for each product the ``n`` users with the highest predicted rating."""
    return product_lists(fitted, n).rows.select(F.col("query").alias("product_id"), F.col("item").alias("user_id"),
                                                F.col("score").cast("float").alias("predicted_rating"))


def predictions(fitted: Fitted, test: DataFrame) -> DataFrame:
    """ML-6: scores for held-out pairs; cold pairs dropped, then any null/NaN row."""
    return fitted.model.transform(test).dropna()


def invariants(training: DataFrame, n: int = LIST_LENGTH) -> DataFrame:
    """Checks of a batch fit on ``training`` as one row.

    Users trained on, users with a list, the longest list, places where a list
    is not in descending order, and list entries whose score is not the product
    of the two factors.
    """
    training = materialize(training, "train")
    fitted = train(training)
    rows = user_lists(fitted, n).rows
    entries = flat(rows)
    lists = entries.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    ordered = nested(rows).select(F.col("recommendations.rating").alias("r"))
    pairs = F.zip_with(F.slice("r", 1, F.size("r") - 1), F.slice("r", 2, F.size("r")), lambda a, b: (a < b).cast("int"))
    falls = ordered.filter(F.size("r") > 1).agg(F.coalesce(F.sum(F.aggregate(pairs, F.lit(0), lambda x, y: x + y)), F.lit(0)).alias("order_violations"))
    u = fitted.model.userFactors.toDF("user_id", "u")
    i = fitted.model.itemFactors.toDF("product_id", "i")
    dot = F.aggregate(F.zip_with("u", "i", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda x, y: x + y)
    wrong = F.count_if(F.abs(dot - F.col("predicted_rating")) > 1e-3 * (1 + F.abs(dot)))
    missed = entries.join(u, "user_id").join(i, "product_id").agg(wrong.alias("score_mismatches"), F.count(F.lit(1)).alias("_matched"))
    total = entries.agg(F.count(F.lit(1)).alias("_entries"))
    trained = training.agg(F.count_distinct("user_id").alias("trained_users"))
    size = lists.agg(F.count(F.lit(1)).alias("users_with_list"), F.max("n").alias("longest_list"))
    # five one-row frames side by side
    one = trained.join(size).join(falls).join(missed).join(total)
    return one.select("trained_users", "users_with_list", "longest_list", "order_violations",
                      (F.col("score_mismatches") + F.col("_entries") - F.col("_matched")).alias("score_mismatches"))


def universal_triples(ids: DataFrame) -> DataFrame:
    """The triples of the universal run, written once."""
    return materialize(ids.select("user_id", "product_id", F.col("Rating_Cleaned").alias("rating_float")).dropna(), "universal-triples")


def universal_recommendations(ids: DataFrame, n: int = LIST_LENGTH) -> DataFrame | None:
    """ML-3 / JOB-5: nested top-``n`` lists from dense-ranked ids, or None below the size gate."""
    triples = universal_triples(ids)
    if not has_enough_variety(triples):
        return None
    fitted = train(triples, "rating_float", UNIVERSAL_ALS)
    return nested_user_lists(fitted, n)


def universal_recommendations_by_id(df: DataFrame, n: int = LIST_LENGTH) -> DataFrame | None:
    """The same on the rows' own ids, of any type: trained on indexes, listed with the ids."""
    ids = indexed_triples(df, rating="Rating_Cleaned", rating_out="rating_float")
    ids.triples = materialize(ids.triples, "universal-triples")
    if not has_enough_variety(ids.triples):
        return None
    lists = with_original_ids(user_recommendations(train(ids.triples, "rating_float", UNIVERSAL_ALS), n), ids)
    return nested(lists.select(F.col("user_id").alias("query"), F.col("product_id").alias("item"), F.col("predicted_rating").alias("score")))
