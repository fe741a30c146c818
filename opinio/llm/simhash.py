"""SimHash near-duplicates by tiled exact comparison.

``fingerprints``: A-Z are lower-cased, words are runs outside space and
U+0009..U+000D, shingles are every ``shingle`` consecutive words (repeats
count) joined by one space; shorter texts are one shingle, texts without words
(null, empty, blank) have fingerprint zero and are linked like any other.  Bit
i of the fingerprint is set if bit i is set in more than half of the shingles'
XXH64 (seed 42) hashes.

``link_components``: distinct fingerprints are grouped into tiles by the
population counts of their four 16-bit quarters.  Two fingerprints within
``radius`` bits have quarter counts whose differences add up to at most
``radius``, so a pair of tiles beyond that is skipped, which loses no pair.
A tile holds about ``TILE`` fingerprints at most: a larger group (many near
copies) is dealt over numbered blocks by a hash, and every pair of blocks is
compared.  One task row is one pair of blocks, compared with numpy exclusive-or
and bit counts; it returns a spanning forest of its links, never all pairs.
The forest's components are found by alternating star contraction with every
round written to the shared folder.

Results for odd input: a null doc_id is a document like any other (the class id
is the smallest non-null id, null if there is none); repeated rows are each
returned; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import cut, free_name, quoted, row_hash, ship, texts_of, words_of

# The hash seed and the defaults of the operator.
SEED = 42
SHINGLE = 3
RADIUS = 2
# Fingerprints in a block, on average; a block is the unit of one comparison.
TILE = 2048
# Shingles hashed at a time, so a very long text needs no more memory than this.
_CHUNK = 1 << 16
_QUARTERS = 4
_BASE = 17


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = words_of(text)
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) <= shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(g, SEED) for g in grams]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = np.array(hashes[at : at + _CHUNK], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, fp)`` for every row; ``fp`` is the fingerprint as a signed long."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in texts_of(b.column(1))), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    source = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, fp long")


def _forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links that connect all fingerprints of two blocks (or of one, b None) that lie within ``radius`` bits."""
    nodes = a if b is None else np.concatenate([a, b])
    other, shift = (a, 0) if b is None else (b, len(a))
    label = np.arange(len(nodes))
    links = []
    step = max(1, (1 << 20) // max(1, len(other)))
    for at in range(0, len(a), step):
        near = np.bitwise_count(a[at : at + step, None] ^ other[None, :]) <= radius
        if b is None:  # each pair once
            near &= np.arange(len(other))[None, :] > np.arange(at, at + len(near))[:, None]
        for i in np.flatnonzero(near.any(axis=1)):
            found = label[np.flatnonzero(near[i]) + shift]
            own = label[at + i]
            if (found == own).all():
                continue
            merged = np.unique(np.append(found, own))
            links += [(int(nodes[x]), int(nodes[merged[0]])) for x in merged[1:]]
            label[np.isin(label, merged[1:])] = merged[0]
    return links


def _tiles(fps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks ``(key, block, fps)`` and their counts ``(key, blocks)``; at most 17^4 keys, whatever the input."""
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(_QUARTERS)]
    keyed = fps.select("fp", sum(q * _BASE**i for i, q in enumerate(quarter)).cast("int").alias("key"))
    counts = keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("blocks"))
    counts = cut(counts, "simhash-keys")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks").cast("long")).cast("int")
    blocks = keyed.join(F.broadcast(counts), "key").groupBy("key", block.alias("block")).agg(F.collect_list("fp").alias("fps"))
    return cut(blocks, "simhash-tiles"), counts


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``(u, v)`` whose components are those of all pairs of distinct ``fps`` within ``radius`` bits."""
    ship(fps.sparkSession)
    blocks, counts = _tiles(fps)
    near = [
        o for o in np.ndindex(*[2 * radius + 1] * _QUARTERS) if sum(abs(x - radius) for x in o) <= radius
    ]
    # the key of a neighbouring tile, digit by digit, so that no digit runs over into the next
    digits = [F.floor(F.col("key") / _BASE**i) % _BASE for i in range(_QUARTERS)]
    steps = [[int(x) - radius for x in o] for o in near]
    steps = [s for s in steps if sum(x * _BASE**i for i, x in enumerate(s)) >= 0]
    options = [
        F.when(
            F.forall(F.array(*[(d + x).cast("int") for d, x in zip(digits, s)]), lambda c: (c >= 0) & (c < _BASE)),
            F.col("key") + F.lit(sum(x * _BASE**i for i, x in enumerate(s))),
        )
        for s in steps
    ]
    here = counts.select(F.col("key").alias("key_a"), F.col("blocks").alias("n_a"), F.explode(F.array_compact(F.array(*options))).alias("key_b"))
    pairs = here.join(F.broadcast(counts.select(F.col("key").alias("key_b"), F.col("blocks").alias("n_b"))), "key_b")
    pairs = pairs.select("key_a", "key_b", "n_b", F.explode(F.sequence(F.lit(0), F.col("n_a") - 1)).alias("block_a"))
    first = F.when(F.col("key_a") == F.col("key_b"), F.col("block_a")).otherwise(0)
    pairs = pairs.select("key_a", "block_a", "key_b", F.explode(F.sequence(first, F.col("n_b") - 1)).alias("block_b"))
    a = blocks.select(F.col("key").alias("key_a"), F.col("block").alias("block_a"), F.col("fps").alias("fps_a"))
    b = blocks.select(F.col("key").alias("key_b"), F.col("block").alias("block_b"), F.col("fps").alias("fps_b"))
    same = (F.col("key_a") == F.col("key_b")) & (F.col("block_a") == F.col("block_b"))
    work = pairs.join(a, ["key_a", "block_a"]).join(b, ["key_b", "block_b"]).select(same.alias("same"), "fps_a", "fps_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, left, right = batch.columns
            found: list[tuple[int, int]] = []
            lo, ro = left.offsets.to_numpy(), right.offsets.to_numpy()
            lv, rv = left.values.to_numpy().view(np.uint64), right.values.to_numpy().view(np.uint64)
            for k, one in enumerate(same.to_pylist()):
                x = lv[lo[k] : lo[k + 1]]
                found += _forest(x, None if one else rv[ro[k] : ro[k + 1]], radius)
            u, v = (np.array(c, dtype=np.uint64).view(np.int64) for c in (zip(*found) if found else ((), ())))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return work.mapInArrow(run, "u long, v long")


def connected(edges: DataFrame) -> DataFrame:
    """``(u, root)`` for every node of ``edges`` (u, v): root is the smallest node that it reaches.

    Alternating large-star and small-star rounds; the edge set is written after
    each round and the rounds end when it no longer changes.
    """
    both = F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("v").alias("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")
    digest = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]

    def large(e: DataFrame) -> DataFrame:
        sym = e.select(both).select("e.u", "e.v")
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return sym.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.union(low.select("u", F.col("m").alias("v"))).distinct()

    edges = cut(edges.filter("u != v").distinct(), "stars")
    before = edges.agg(*digest).first()
    while before[0]:
        edges = cut(small(cut(large(edges), "stars")), "stars")
        after = edges.agg(*digest).first()
        if after == before:
            break
        before = after
    return edges.select("u", F.col("v").alias("root")).union(edges.select("v", "v").distinct())


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(id, fp, component_id)`` for every row of ``docs``."""
    rows = cut(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    distinct = cut(rows.groupBy("fp").agg(F.min("id").alias("low")), "simhash-fps")
    roots = cut(connected(links(distinct.select("fp"), radius)), "simhash-roots")
    rooted = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    low = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = rooted.select("fp", "root").join(low, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component, with all columns of ``docs``: that of the smallest id (nulls last).

    Of rows that share that id, the one with the smallest row hash stays.
    """
    tag = free_name(docs, "row_tag")
    tagged = docs.withColumn(tag, row_hash(docs))
    # the tag stands for the row through fingerprinting, so that repeated ids cannot be mixed up
    ids = tagged.select(F.struct(quoted(id_col).isNull().alias("no_id"), quoted(id_col).alias("id"), quoted(tag).alias("tag")).alias("id"), quoted(text_col).alias("text"))
    stays = components(ids, "id", "text", shingle, radius).select(F.col("component_id.tag").alias(tag)).distinct()
    return tagged.dropDuplicates([tag]).join(stays, tag, "left_semi").select(*[quoted(c) for c in docs.columns])


def op7(spark, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint (16 hex digits) and the smallest doc_id of its component."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return components(docs).select(F.col("id").alias("doc_id"), hexed.alias("fingerprint"), "component_id")
