"""Exact ranked lexical search over posting lists in geometric blocks.

``forward`` counts each document's terms (runs outside the ASCII code points
other than digits and letters; only A-Z lower-cased) and keeps those of the
query set: words that no query asks for have no list.  A term's impact in a
document is an integer, so a document's score for a query is an integer inner
product.

``build`` cuts the documents into segments of at most ``SEGMENT`` and inverts each.
Every posting list of a segment is clustered by document similarity: each
document has a sketch (random signs of its terms, weighted by impact), every
``BLOCK``-th document of a list is a centre, and the others join the centre of
most similar sketch.  A block stores the greatest impact of each term among
its documents.  A document is looked for in the list of the first of its query
terms, those of greatest weight first, so a summary holds the list's term and
the later terms that some query has together with it, and the inner product
of query and summary bounds the score of every document looked for there.

``search`` asks the segments twice.  First each query reads the ``FIRST`` blocks
with the highest bounds; the k-th best score found by all segments together is a
floor of the result.  Then every block whose bound reaches the floor, or the
k-th score that the task has meanwhile, is read, best bounds first; the others are
skipped, which loses nothing, since every document with a score is looked for
somewhere.  Documents are scored whole, from all their terms, once
per query; every task returns at most k of them a query, which are merged.

A segment holds documents, not terms, so a term of a third of all documents
fills no task, and lists of a segment are at most ``SEGMENT`` long.  Queries
are taken in blocks of about ``TERMS`` distinct terms (a longer query is a
block of its own); a block and its document frequencies are what the driver
and the workers hold of the corpus statistics.

Results for odd input: a null or empty text has no terms, matches nothing and
does not count as a document; a query without known terms has no rows; repeated
documents are documents like any other; repeated rows of the query set are
asked once, rows of one id with different texts separately; a null document
id loses ties, a null item id is an id like any other; very long texts are read
piece by piece; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import cut, quoted, ship, table, texts_of

# The code points below 128 that belong to terms, and the formula's constants.
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
WEIGHT, SCALE, TF, LENGTH = 1000, 1_000_000_000, 1000, 12
BASE, SHARE = 75, 25
K = 20
SEGMENT = 4096
BLOCK = 64
FIRST = 2
TERMS = 200_000
_DIMS = 32
_PIECE = 1 << 20
_LOWER = bytes(b if b >= 128 or b in _KEPT else 32 for b in bytes(range(256)).lower())


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in pieces of about a million bytes."""
    if not text:
        return
    data, at = text.encode("utf-8").translate(_LOWER), 0
    while at < len(data):
        end = data.find(b" ", at + _PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


@dataclass
class Queries:
    """A block of queries: their ids, their terms as numbers, and how often each has a term."""

    ids: list
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    number: dict[bytes, int]

    def consulted(self, place: np.ndarray) -> list[np.ndarray]:
        """For each term itself and the terms that a query has together with it and that come after it by ``place``."""
        near: list[list[np.ndarray]] = [[] for _ in self.number]
        for t in self.terms:
            ordered = t[np.argsort(place[t])]
            for i, x in enumerate(ordered.tolist()):
                near[x].append(ordered[i:])
        return [np.unique(np.concatenate(n)) if n else np.zeros(0, dtype=np.int64) for n in near]


def query_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Queries]:
    """The distinct queries in blocks of about ``TERMS`` distinct terms."""
    ship(items.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                n: Counter = Counter()
                for piece in terms_of(b.column(1)[i].as_py()):
                    n.update(piece)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), pa.array([list(n)], pa.list_(pa.binary())), pa.array([list(n.values())], pa.list_(pa.int64()))], names=["id", "terms", "repeats"])

    source = items.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text")).distinct()
    counted = cut(source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, terms array<binary>, repeats array<long>"), "lexical-queries")
    blocks = max(1, -(-(counted.agg(F.sum(F.size("terms"))).first()[0] or 0) // TERMS))
    block = F.pmod(F.xxhash64("id", "terms"), F.lit(blocks))
    for i in range(blocks):
        q = Queries([], [], [], {})
        for r in counted.filter((block == i) & (F.size("terms") > 0)).collect():
            q.ids.append(r["id"])
            q.terms.append(np.array([q.number.setdefault(bytes(t), len(q.number)) for t in r["terms"]], dtype=np.int64))
            q.repeats.append(np.array(r["repeats"], dtype=np.int64))
        if q.ids:
            yield q


def forward(docs: DataFrame, number: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``(id, n, terms, tfs)``: a document's terms with repeats, and its numbered terms with their counts; those with n > 0."""
    sent = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value.get
        for b in batches:
            ids, lengths, terms, tfs = [], [], [], []
            for doc, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                n, found = 0, Counter()
                for piece in terms_of(text):
                    n += len(piece)
                    found.update(map(known, piece))
                if n:
                    found.pop(None, None)
                    ids.append(doc)
                    lengths.append(n)
                    terms.append(list(found))
                    tfs.append(list(found.values()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], names=["id", "n", "terms", "tfs"])

    source = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"))
    return cut(source.mapInArrow(run, "id long, n long, terms array<int>, tfs array<long>"), "lexical-forward")


@dataclass
class Statistics:
    """Documents, words, the weight of each term, and its place when terms of greater weight come first."""

    docs: int
    words: int
    weights: np.ndarray

    @property
    def place(self) -> np.ndarray:
        place = np.empty(len(self.weights), dtype=np.int64)
        place[np.argsort(-self.weights, kind="stable")] = np.arange(len(place))
        return place


def statistics(rows: DataFrame, known: int) -> Statistics:
    """Documents, words and the weight of each of the ``known`` terms."""
    docs, words = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(known)
    for r in rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        df[r["t"]] = r["df"]
    return Statistics(docs, words or 0, np.floor(WEIGHT * np.log((2 * docs + 2) / (2 * df + 1))).astype(np.int64))


def impacts(s: Statistics, n: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
    """The integer impact of each posting; n is its document's length."""
    m = BASE + SHARE * n * s.docs // s.words
    return s.weights[terms] * (SCALE * tfs // (TF * tfs + LENGTH * m))


def _lists(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of several runs, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - np.concatenate([[0], ends[:-1]]).astype(np.int64), lengths)


def _signs(known: int) -> np.ndarray:
    return np.random.default_rng(known).choice(np.array([-1, 1], dtype=np.float32), (known, _DIMS))


# Stored arrays of a segment beside the documents' ids, and the numbers in them.
SEGMENT_ARRAYS = {
    "doc_ends": "<i4", "terms": "<i4", "impacts": "<i8", "list_terms": "<i4", "list_blocks": "<i4", "block_docs": "<i4",
    "members": "<i4", "block_coords": "<i4", "coords": "<i4", "maxima": "<i8",
}


def segment(n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, s: Statistics, near: list[np.ndarray], signs: np.ndarray) -> dict:
    """The index of some documents: forward lists, and per term the blocks with members and summaries."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    value = impacts(s, n[owner], terms, tfs)
    keep = value > 0  # a term of weight 0 adds nothing
    owner, terms, value = owner[keep], terms[keep], value[keep]
    by_place = np.lexsort((s.place[terms], owner))
    terms, value = terms[by_place], value[by_place]
    sizes = np.bincount(owner, minlength=len(sizes))
    doc_ends = np.cumsum(sizes)
    sketch = np.zeros((len(sizes), _DIMS), dtype=np.float32)
    for a in range(0, len(sizes), 256):  # a few documents at a time
        lo, hi = (doc_ends[a - 1] if a else 0), doc_ends[min(a + 256, len(sizes)) - 1]
        for d in range(_DIMS):
            sketch[a : a + 256, d] = np.bincount(owner[lo:hi] - a, signs[terms[lo:hi], d] * value[lo:hi], minlength=min(256, len(sizes) - a))
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)

    order = np.argsort(terms, kind="stable")
    list_terms, first = np.unique(terms[order], return_index=True)
    last = np.append(first[1:], len(order))
    column = np.full(len(near), -1, dtype=np.int64)
    out: dict[str, list] = {k: [] for k in ("list_blocks", "block_docs", "members", "block_coords", "coords", "maxima")}
    for t, a, b in zip(list_terms.tolist(), first.tolist(), last.tolist()):
        postings = order[a:b]
        docs = owner[postings]
        if len(docs) > BLOCK:
            cluster = (sketch[docs] @ sketch[docs[::BLOCK]].T).argmax(axis=1)
            by = np.argsort(cluster, kind="stable")
            postings, docs, cluster = postings[by], docs[by], np.unique(cluster[by], return_inverse=True)[1]
        else:
            cluster = np.zeros(len(docs), dtype=np.int64)
        blocks = int(cluster[-1]) + 1
        column[near[t]] = np.arange(len(near[t]))
        # from the term itself on: what comes before it in its document is not consulted
        later = doc_ends[docs] - postings
        at = _lists(postings, later)
        cols, rows = column[terms[at]], np.repeat(cluster, later)
        inside = cols >= 0
        best = np.zeros((blocks, len(near[t])), dtype=np.int64)
        np.maximum.at(best.reshape(-1), rows[inside] * len(near[t]) + cols[inside], value[at[inside]])
        column[near[t]] = -1
        row, col = np.nonzero(best)
        out["list_blocks"].append(np.array([blocks]))
        out["block_docs"].append(np.bincount(cluster, minlength=blocks))
        out["members"].append(docs)
        out["block_coords"].append(np.bincount(row, minlength=blocks))
        out["coords"].append(near[t][col])
        out["maxima"].append(best[row, col])
    joined = {k: np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for k, v in out.items()}
    return {"doc_ends": doc_ends, "terms": terms, "impacts": value, "list_terms": list_terms} | joined


def build(rows: DataFrame, s: Statistics, near: list[np.ndarray]) -> DataFrame:
    """One row per segment of ``rows`` (those with a term of the query set): ``ids`` and ``SEGMENT_ARRAYS``."""
    sent = rows.sparkSession.sparkContext.broadcast((s, near))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, near = sent.value
        signs = _signs(len(near))
        for whole in batches:
            for at in range(0, whole.num_rows, SEGMENT):
                b = whole.slice(at, SEGMENT)
                sizes = np.diff(b.column(2).offsets.to_numpy()).astype(np.int64)
                terms, tfs = b.column(2).flatten().to_numpy().astype(np.int64), b.column(3).flatten().to_numpy()
                made = segment(b.column(1).to_numpy(), sizes, terms, tfs, s, near, signs)
                ids = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column(0))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array([made[k].astype(v).tobytes()], pa.binary()) for k, v in SEGMENT_ARRAYS.items())], names=["ids", *SEGMENT_ARRAYS])

    fields = ", ".join(["ids array<long>", *(f"{k} binary" for k in SEGMENT_ARRAYS)])
    return cut(rows.filter(F.size("terms") > 0).mapInArrow(run, fields), "lexical-index")


class Segment:
    """A stored segment, ready to be asked."""

    def __init__(self, row: pa.RecordBatch, known: int):
        for i, (k, kind) in enumerate(SEGMENT_ARRAYS.items(), 1):
            setattr(self, k, np.frombuffer(row.column(i)[0].as_buffer(), kind).astype(np.int64))
        ids = row.column(0).flatten()
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        self.sizes = np.diff(self.doc_ends, prepend=0)
        self.starts = self.doc_ends - self.sizes
        self.where = np.full(known, -1, dtype=np.int64)
        self.where[self.list_terms] = np.arange(len(self.list_terms))
        self.block_ends = np.cumsum(self.list_blocks)
        self.member_starts = np.cumsum(self.block_docs) - self.block_docs
        self.coord_starts = np.cumsum(self.block_coords) - self.block_coords

    def blocks_of(self, terms: np.ndarray) -> np.ndarray:
        at = self.where[terms]
        at = at[at >= 0]
        return _lists(self.block_ends[at] - self.list_blocks[at], self.list_blocks[at])

    def bounds(self, blocks: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """For each block the inner product of its summary with the query (dense over all terms)."""
        at = _lists(self.coord_starts[blocks], self.block_coords[blocks])
        return _sums(asked[self.coords[at]] * self.maxima[at], self.block_coords[blocks])

    def scores(self, docs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        at = _lists(self.starts[docs], self.sizes[docs])
        return _sums(asked[self.terms[at]] * self.impacts[at], self.sizes[docs])


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


class Best:
    """The k best documents of one query so far: score, id (null last), in order."""

    def __init__(self, k: int, floor: int):
        self.k, self.least = k, floor
        self.score, self.no_id, self.id = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)

    def add(self, score: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        fits = score >= self.least
        if fits.any():
            score, no_id, ids = (np.concatenate([old, new[fits]]) for old, new in ((self.score, score), (self.no_id, no_id), (self.id, ids)))
            order = np.lexsort((ids, no_id, -score))[: self.k]
            self.score, self.no_id, self.id = score[order], no_id[order], ids[order]
            if len(order) == self.k:
                self.least = max(self.least, int(self.score[-1]))


def ask(seg: Segment, asked: np.ndarray, terms: np.ndarray, best: Best, first: int | None) -> tuple[int, int]:
    """Read the blocks that may hold a document for ``best`` (the ``first`` ones only, if given); (read, all)."""
    blocks = seg.blocks_of(terms)
    bounds = seg.bounds(blocks, asked)
    order = np.argsort(-bounds, kind="stable")
    blocks, bounds = blocks[order], bounds[order]
    seen = np.zeros(len(seg.ids), dtype=bool)
    read, step = 0, FIRST
    limit = len(blocks) if first is None else min(first, len(blocks))
    while read < limit:
        # a bound equal to the k-th score may hide a tie with a smaller id
        now = blocks[read : min(read + step, limit)][bounds[read : min(read + step, limit)] >= best.least]
        if not len(now):
            break
        docs = np.unique(seg.members[_lists(seg.member_starts[now], seg.block_docs[now])])
        docs = docs[~seen[docs]]
        seen[docs] = True
        best.add(seg.scores(docs, asked), seg.no_id[docs], seg.ids[docs])
        read, step = read + len(now), 2 * step
    return read, len(blocks)


HITS = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _hits(index: DataFrame, q: Queries, known: int, k: int, floors: list[int], first: int | None) -> DataFrame:
    """The best documents that each task finds for each query."""
    sent = index.sparkSession.sparkContext.broadcast((q.terms, q.repeats, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, repeats, floors = sent.value
        found = [Best(k, f) for f in floors]
        asked = np.zeros(known, dtype=np.int64)
        for b in batches:
            for r in range(b.num_rows):
                seg = Segment(b.slice(r, 1), known)
                for t, n, best in zip(terms, repeats, found):
                    asked[t] = n
                    ask(seg, asked, t, best, first)
                    asked[t] = 0
        for i, best in enumerate(found):
            if len(best.id):
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(best.id), pa.int32()), pa.array(best.id, mask=best.no_id), pa.array(best.score)], schema=HITS)

    return index.mapInArrow(run, "query int, doc_id long, score long")


def _top(hits: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k)


def search(items: DataFrame, docs: DataFrame, k: int = K, item_col: str = "item_id", query_col: str = "text", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each query's k best documents with a score above 0, ties to smaller ids."""
    spark = docs.sparkSession
    ship(spark)
    kind = items.select(quoted(item_col)).dtypes[0][1]
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for q in query_blocks(items, item_col, query_col):
        known = len(q.number)
        rows = forward(docs, q.number, id_col, text_col)
        s = statistics(rows, known)
        index = build(rows, s, q.consulted(s.place))
        found = cut(_top(_hits(index, q, known, k, [1] * len(q.ids), FIRST), k), "lexical-first")
        # a query's k-th score so far: one number each
        floors = {r["query"]: r["score"] for r in found.filter(F.col("rank") == k).select("query", "score").collect()}
        best = _top(_hits(index, q, known, k, [floors.get(i, 1) for i in range(len(q.ids))], None), k)
        ids = spark.createDataFrame(list(enumerate(q.ids)), f"query int, item_id {kind}")
        out = out.union(cut(best.join(ids, "query").select("item_id", "rank", "doc_id", "score"), "lexical-hits"))
    return out


def op11(spark, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))
