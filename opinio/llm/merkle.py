"""Merkle manifest of a dataset, stored in van Emde Boas blocks.

Every row is a leaf: ``H`` (lowercase hex SHA-256) of its columns, each ``-``
if null, else its UTF-8 byte count, ``:`` and its value.  The leaves of each
tree (``lang``) ascend by id; while several nodes remain, every ``FAN``
consecutive ones become ``H`` of their digests as hex text.  What remains is
the tree's subroot; the subroots, ordered by tree (null first, by UTF-8 bytes),
give the root in the same way.

``grow`` cuts a tree into blocks: aligned subtrees of ``HEIGHT`` levels over
``FAN ** HEIGHT`` nodes, whose roots are the leaves of the blocks of the next
stage, until one block is left.  Inside a block the digests stand in van Emde
Boas order: the upper half of the levels first, then each lower subtree, both
laid out the same way again.  ``address`` computes a node's place from its
depth and index alone; construction writes through it, ``descend`` reads
siblings through it, from the last stage down: each block hands the path of
each of its leaves to the block below, and the first stage ends at the rows.

Rows of all trees get their place from one range sort with offsets
(``opinio.operators.rank``), so a tree that holds most rows is split like any
other; a task holds one block of at most ``FAN ** HEIGHT`` leaves at a time.
Texts are read once, for the leaves; all else moves digests of 32 bytes.

Results for odd input: a null id stands before all others of its tree and is
never tampered with; rows of equal id are ordered by leaf, equal rows are leaves
of their own (interchangeable); a null text stays null when tampered with; a
tree of one row has that leaf as its subroot; a leaf without siblings has the
SHA-256 of nothing as its proof; an empty table gives an empty result; columns
that are not named are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import cut, quoted, ship, table
from opinio.operators.rank import row_number_global

# Children of a node and the columns of a leaf, in order.
FAN = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# Levels below the root of a block.
HEIGHT = 4
_WIDTH = 32


def size(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (FAN**levels - 1) // (FAN - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places, in van Emde Boas order, of the nodes ``index`` at ``depth`` of a full tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    under = FAN ** (depth - top)
    return size(top) + index // under * size(levels - top) + address(depth - top, index % under, levels - top)


@lru_cache
def _addresses(height: int) -> list[list[int]]:
    """For each depth of a block the places of all its nodes."""
    return [address(d, np.arange(FAN**d), height + 1).tolist() for d in range(height + 1)]


def height_over(n: int) -> int:
    """Levels above n leaves until one node remains."""
    h = 0
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def _hash(digests: Sequence[bytes]) -> bytes:
    return sha256(b"".join(digests).hex().encode()).digest()


def build(leaves: Sequence[bytes], height: int) -> bytes:
    """The nodes of one block over ``leaves`` in van Emde Boas order; places without a node are zero."""
    nodes = bytearray(_WIDTH * size(height + 1))
    row = list(leaves)
    for depth in range(height, -1, -1):
        for at, digest in zip(_addresses(height)[depth], row):
            nodes[at * _WIDTH : (at + 1) * _WIDTH] = digest
        row = [_hash(row[i : i + FAN]) for i in range(0, len(row), FAN)]
    return bytes(nodes)


def siblings(nodes: bytes, leaf: int, count: int, height: int) -> list[tuple[int, list[bytes]]]:
    """From a leaf of a block of ``count`` leaves up: its place in its run and the run's other digests."""
    path = []
    for depth in range(height, 0, -1):
        own, first = leaf % FAN, leaf - leaf % FAN
        run = _addresses(height)[depth][first : min(first + FAN, count)]
        path.append((own, [nodes[at * _WIDTH : (at + 1) * _WIDTH] for i, at in enumerate(run) if i != own]))
        leaf, count = leaf // FAN, -(-count // FAN)
    return path


def fold(digest: bytes, path: Sequence[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and its path lead to."""
    for own, others in path:
        digest = _hash([*others[:own], digest, *others[own:]])
    return digest


def _pack(path: Sequence[tuple[int, list[bytes]]]) -> bytes:
    return b"".join(bytes((own, len(others))) + b"".join(others) for own, others in path)


def _unpack(packed: bytes) -> list[tuple[int, list[bytes]]]:
    path, at = [], 0
    while at < len(packed):
        own, n = packed[at], packed[at + 1]
        path.append((own, [packed[i : i + _WIDTH] for i in range(at + 2, at + 2 + n * _WIDTH, _WIDTH)]))
        at += 2 + n * _WIDTH
    return path


def leaf(columns: dict[str, Column]) -> Column:
    """The digest (32 bytes) of a row whose column values are given as strings."""
    fields = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in columns.values()]
    return F.unhex(F.sha2(F.concat(*fields), 256))


def grow(rows: DataFrame, sizes: DataFrame, name: str) -> list[DataFrame]:
    """The stages of blocks over ``rows`` (t, place, digest, and what belongs to a leaf), ``sizes`` (t, n) giving each tree's leaves.

    A block is ``(t, block, last, height, n, nodes, root, carried)``; ``last`` if its tree
    has no other in this stage, ``carried`` one list for each further column of ``rows``.
    """
    ship(rows.sparkSession)
    span = FAN**HEIGHT
    stages = []
    # one number for the driver: how often the largest tree is cut
    most = sizes.agg(F.max("n")).first()[0] or 0
    while most:
        carried = [f for f in rows.schema.fields if f.name not in ("t", "place", "digest")]
        fields = "t long, block long, last boolean, height int, n int, nodes binary, root binary"
        fields += "".join(f", {f.name} array<{f.dataType.simpleString()}>" for f in carried)
        names = [f.name for f in carried]

        def pack(key: tuple, group: pa.Table) -> pa.Table:
            group = group.sort_by("place")
            n, whole = group.num_rows, group["n"][0].as_py()
            height = HEIGHT if whole > span else height_over(n)
            nodes = build(group["digest"].to_pylist(), height)
            out = {"t": [key[0].as_py()], "block": [key[1].as_py()], "last": [whole <= span], "height": pa.array([height], pa.int32()), "n": pa.array([n], pa.int32()), "nodes": [nodes], "root": [nodes[:_WIDTH]]}
            for c in names:
                values = group[c].combine_chunks()
                values = pa.concat_arrays(values.chunks) if isinstance(values, pa.ChunkedArray) else values
                out[c] = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), values)
            return pa.table(out)

        blocked = rows.join(sizes, "t").withColumn("block", F.floor(F.col("place") / span).cast("long"))
        stages.append(cut(blocked.groupBy("t", "block").applyInArrow(pack, fields), f"merkle-{name}"))
        rows = stages[-1].filter("NOT last").select("t", F.col("block").alias("place"), F.col("root").alias("digest"))
        sizes = sizes.filter(F.col("n") > span).select("t", F.ceil(F.col("n") / span).cast("long").alias("n"))
        most = -(-most // span) if most > span else 0
    return stages


PATHS = "t long, block long, path binary, subroot binary, root binary"


def descend(stages: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """The paths above every block of the first stage; ``tops`` has those above each tree's last block, at block 0."""
    above = None
    for stage in reversed(stages[1:]):
        here = tops.join(stage.filter("last").select("t"), "t", "left_semi")
        above = here if above is None else here.union(above)

        def hand(key: tuple, blocks: pa.Table, paths: pa.Table) -> pa.Table:
            b, p = blocks.to_pylist()[0], paths.to_pylist()[0]
            down = [_pack(siblings(b["nodes"], i, b["n"], b["height"])) + p["path"] for i in range(b["n"])]
            at = b["block"] * FAN**HEIGHT
            k = len(down)
            return pa.table({"t": [b["t"]] * k, "block": list(range(at, at + k)), "path": down, "subroot": [p["subroot"]] * k, "root": [p["root"]] * k})

        above = cut(_together(stage, above, hand, PATHS), f"merkle-{name}-paths")
    here = tops.join(stages[0].filter("last").select("t"), "t", "left_semi")
    return here if above is None else here.union(above)


def _together(blocks: DataFrame, paths: DataFrame, each, fields: str) -> DataFrame:
    # paths may come from the same table as the blocks, so their columns are made anew
    fresh = paths.toDF(*[f"path_{c}" for c in paths.columns]).toDF(*paths.columns)
    return blocks.groupBy("t", "block").cogroup(fresh.groupBy("t", "block")).applyInArrow(each, fields)


@dataclass
class Manifest:
    """``trees`` (t, tree, n), the stages of blocks of all trees, and those over their subroots."""

    trees: DataFrame
    stages: list[DataFrame]
    over: list[DataFrame]


def manifest(cards: DataFrame) -> Manifest:
    """The manifest of ``cards``: ``(tree, id, digest, claimed)``; ``claimed`` is the digest that ``prove`` checks."""
    cards = cut(cards.select("tree", "id", "digest", "claimed"), "merkle-leaves")
    numbered = row_number_global(cards, ["tree", "id"], ["digest", "claimed"], out="number", id_type="bigint")
    first = cut(numbered.groupBy("tree").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n")), "merkle-trees")
    trees = cut(row_number_global(first, ["tree"], [], out="t", collapse_copies=False, id_type="bigint"), "merkle-trees")
    same = numbered["tree"].eqNullSafe(trees["tree"])
    rows = numbered.join(trees.select("t", "tree", "first"), same).select("t", (F.col("number") - F.col("first")).alias("place"), "digest", "id", "claimed")
    stages = grow(rows, trees.select("t", "n"), "tree")
    over: list[DataFrame] = []
    if stages:
        tops = stages[0].filter("last").select("t", "root")
        for stage in stages[1:]:
            tops = tops.union(stage.filter("last").select("t", "root"))
        whole = trees.agg(F.count(F.lit(1)).alias("n")).select(F.lit(0).cast("long").alias("t"), "n")
        over = grow(tops.select(F.lit(0).cast("long").alias("t"), (F.col("t") - 1).alias("place"), F.col("root").alias("digest")), whole, "over")
    return Manifest(trees, stages, over)


PROOFS = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def prove(m: Manifest, id_type: str = "bigint") -> DataFrame:
    """``(id, leaf, subroot, root, proof_sha256, folded_root, verified)`` for every leaf of the manifest.

    ``folded_root`` follows the stored siblings from the claimed digest; ``verified`` says whether it is the root.
    """
    if not m.stages:
        return m.trees.sparkSession.createDataFrame([], f"id {id_type}, {PROOFS}")
    none = F.lit(b"").cast("binary")
    start = m.over[-1].select("t", "block", none.alias("path"), F.col("root").alias("subroot"), "root")

    def subroots(key: tuple, blocks: pa.Table, paths: pa.Table) -> pa.Table:
        b, p = blocks.to_pylist()[0], paths.to_pylist()[0]
        k, at = b["n"], b["block"] * FAN**HEIGHT
        down = [_pack(siblings(b["nodes"], i, k, b["height"])) + p["path"] for i in range(k)]
        places = _addresses(b["height"])[b["height"]][:k]
        own = [b["nodes"][x * _WIDTH : (x + 1) * _WIDTH] for x in places]
        return pa.table({"t": list(range(at + 1, at + 1 + k)), "block": pa.array([0] * k, pa.int64()), "path": down, "subroot": own, "root": [p["root"]] * k})

    tops = cut(_together(m.over[0], descend(m.over, start, "over"), subroots, PATHS), "merkle-tops")

    def rows(key: tuple, blocks: pa.Table, paths: pa.Table) -> pa.Table:
        b = {c: blocks[c][0].as_py() for c in ("n", "height", "nodes", "claimed")}
        p = paths.to_pylist()[0]
        above = _unpack(p["path"])
        tail = b"".join(x for _, others in above for x in others).hex()
        leaves, proofs, folded = [], [], []
        for i, (claimed, at) in enumerate(zip(b["claimed"], _addresses(b["height"])[b["height"]])):
            path = siblings(b["nodes"], i, b["n"], b["height"])
            own = b"".join(x for _, others in path for x in others).hex()
            leaves.append(b["nodes"][at * _WIDTH : (at + 1) * _WIDTH].hex())
            proofs.append(sha256((own + tail).encode()).hexdigest())
            folded.append(fold(claimed, [*path, *above]))
        k = b["n"]
        return pa.table({
            "id": blocks["id"].combine_chunks().flatten(), "leaf": leaves, "subroot": [p["subroot"].hex()] * k, "root": [p["root"].hex()] * k,
            "proof_sha256": proofs, "folded_root": [x.hex() for x in folded], "verified": [x == p["root"] for x in folded],
        })

    return _together(m.stages[0], descend(m.stages, tops, "tree"), rows, f"id {id_type}, {PROOFS}")


def cards(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", tree_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(tree, id, digest, claimed)`` of every row; ``claimed`` is the digest of the row as tampered with.

    Where 3 divides the CRC-32 of the decimal id, A-Z of the text are lower-cased.
    """
    plain = {c: quoted(c).cast("string") for c in columns}
    tampered = plain | {text_col: F.translate(plain[text_col], string.ascii_uppercase, string.ascii_lowercase)}
    hit = F.crc32(quoted(id_col).cast("string")) % 3 == 0
    digest = leaf(plain)
    return docs.select(quoted(tree_col).cast("string").alias("tree"), quoted(id_col).alias("id"), digest.alias("digest"), F.when(hit, leaf(tampered)).otherwise(digest).alias("claimed"))


def op13(spark, sf_dir: str) -> DataFrame:
    """Every document with its leaf, subroot, root, proof digest and what its tampered version folds to."""
    docs = table(spark, sf_dir, "documents")
    return prove(manifest(cards(docs)), docs.schema["doc_id"].dataType.simpleString()).withColumnRenamed("id", "doc_id")
