"""Token-id files: documents compressed one by one under a shared zstandard dictionary.

``write`` encodes every text with a public byte-level vocabulary, appends the
end id, and stores the ids as unsigned 16-bit integers (32-bit if the
vocabulary needs it), little-endian, one zstandard frame per document, in
ascending order of doc_id (nulls last; rows of one id in no special order).  The
dictionary is trained on the whole id arrays of a sample drawn by a hash of the text: about
``SAMPLE_BYTES`` of ids, a hundred times the dictionary, however long the documents are.  For less text
the dictionary is an eighth of the ids; if they are too few to train on, it is
their last bytes.  It only shapes the compression, every text is stored whole.

Layout under ``path``, all Parquet, so that any store Spark writes to will do:

* ``dictionary``: one row, the dictionary, its hash, the id width, the end id;
* ``blocks``: one row per block of about ``BLOCK`` bytes: part and block number
  (their order is that of the documents), ``inside`` (ids of the part's blocks
  before it), first and last doc_id, number of documents and ids, and ``data``:
  magic, dictionary hash, number of documents, then the doc_ids with a null
  flag, the id counts, the offsets of the frames, and the frames;
* ``starts``: one row per part, the number of ids in all parts before it.

``read`` returns all documents, or opens only the blocks whose range of doc_ids
holds a wanted id (the range is pushed down to Parquet) and decompresses only the wanted frames by their offsets.  A block written with
another dictionary is refused.

Results for odd input: a null or empty text is the end id alone; repeated rows
are each stored; an empty table gives files without blocks; columns other than
the two named are not read.  No document is cut.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinio.llm.bpe import byte_letters
from opinio.llm.common import quoted, ship, texts_of, width
from opinio.session import scratch_dir

MAGIC = b"TOKZ0001"
BLOCK = 1 << 20
DICTIONARY_BYTES = 112 << 10
SAMPLE_BYTES = 100 * DICTIONARY_BYTES
LEVEL = 3
# Runs without white space from which a text goes to the tokenizers library.
LONG_RUN = 500
# Fixed value: how the vocabulary's file splits a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCKS = pa.schema([("part", pa.int32()), ("block", pa.int32()), *((x, pa.int64()) for x in ("inside", "first_id", "last_id", "n_docs", "n_ids")), ("data", pa.binary())])
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
_HEAD = struct.Struct("<8s16sI")


class Encoder:
    """A tokenizer file's ids of a text, unsigned 32-bit little-endian, as the tokenizers library gives them.

    The vocabulary is read from that file into tiktoken, which makes the same
    merges several times faster.  Texts with a special string, with code
    points that Python's Unicode tables lack (the two libraries differ in theirs),
    or with a run of more than ``LONG_RUN`` signs go to the tokenizers library, and
    so does everything if the file's merges are not in the order of their ids.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([*special, rf"\S{{{LONG_RUN}}}"]))
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
        self.fast = None
        if made == list(range(len(vocab) - len(made), len(vocab))):
            letters = {x: b for b, x in enumerate(byte_letters())}
            ranks = {bytes(letters[x] for x in t): i for t, i in vocab.items()}
            self.fast = tiktoken.Encoding(os.path.basename(path), pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        rare = not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(text))
        if rare or self.fast is None or self.whole.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast(text)
        return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def train_dictionary(docs: DataFrame, path: str, end: int, dtype: str) -> bytes:
    """A zstandard dictionary over the sample's serialized ids; empty only if there is no text."""
    known = docs.filter(F.length("text") > 0).select(F.xxhash64("text").alias("h"), "text")
    whole = known.select("h", F.octet_length("text").alias("n")).distinct().agg(F.sum("n")).first()[0]
    if not whole:
        return b""
    # twice as many bytes of text, since an id is shorter than its text; copies count once
    share = min(1.0, 2 * SAMPLE_BYTES / whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for b in batches:
            for h, text in zip(b.column(0), texts_of(b.column(1))):
                ids = np.append(np.frombuffer(encode(text), "<u4"), end).astype(dtype).tobytes()
                # one document can fill the sample
                yield pa.RecordBatch.from_arrays([pa.array([h.as_py()], pa.int64()), pa.array([ids[:SAMPLE_BYTES]], pa.binary())], names=["h", "ids"])

    found = None
    while found is None or not found.num_rows and share < 1:
        # few documents, each far above the sample: the draw may miss all of them
        share = share if found is None else min(1.0, 8 * share)
        pick = known.filter(F.pmod("h", F.lit(1 << 40)) < int(share * (1 << 40))).dropDuplicates(["h"])
        found = pick.mapInArrow(run, "h long, ids binary").toArrow()
    samples, held = [], 0
    for ids in found.sort_by("h")["ids"]:
        samples.append(ids.as_py())
        held += len(samples[-1])
        if held >= SAMPLE_BYTES:
            break
    size = min(DICTIONARY_BYTES, held // 8)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-max(size, 8) :]


def pack(ids: list[int | None], counts: list[int], frames: list[bytes], dictionary_hash: bytes) -> bytes:
    """The bytes of one block."""
    known = np.array([i is not None for i in ids], dtype="<u1")
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])])
    return b"".join([
        _HEAD.pack(MAGIC, dictionary_hash, len(ids)), np.array([i or 0 for i in ids], dtype="<i8").tobytes(), known.tobytes(),
        np.array(counts, dtype="<u4").tobytes(), offsets.astype("<u8").tobytes(), *frames,
    ])


def unpack(data: bytes, dictionary_hash: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, memoryview]:
    """``(ids, known, counts, offsets, frames)`` of a block; an error if it was written with another dictionary."""
    magic, wrote, n = _HEAD.unpack_from(data)
    if magic != MAGIC or wrote != dictionary_hash:
        raise ValueError("the block does not belong to this dictionary")
    at, out = _HEAD.size, []
    for kind, k in (("<i8", n), ("<u1", n), ("<u4", n), ("<u8", n + 1)):
        out.append(np.frombuffer(data, kind, k, at))
        at += out[-1].nbytes
    return (*out, memoryview(data)[at:])


def write(docs: DataFrame, out: str, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = 0) -> str:
    """Write the files of ``docs`` under ``out`` (a new folder); returns ``out``."""
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"))
    dtype = "<u2" if max(end, encoder(path).tokenizer.get_vocab_size() - 1) < 1 << 16 else "<u4"
    dictionary = train_dictionary(source, path, end, dtype)
    mark = hashlib.sha256(dictionary).digest()[:16]
    row = [(dictionary, mark, dtype, end, os.path.basename(path))]
    spark.createDataFrame(row, "dictionary binary, hash binary, dtype string, end_id long, vocabulary string").coalesce(1).write.parquet(f"{out}/dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if trained:
            trained.precompute_compress(level=LEVEL)
        zip_one = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=True).compress
        part, number, held, inside = TaskContext.get().partitionId(), 0, 0, 0
        ids: list[int | None] = []
        counts: list[int] = []
        frames: list[bytes] = []

        def block() -> pa.RecordBatch:
            row = [part, number, inside, ids[0], ids[-1], len(ids), sum(counts), pack(ids, counts, frames, mark)]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, BLOCKS)], schema=BLOCKS)

        encode = encoder(path).encode
        for b in batches:
            for i, text in zip(b.column(0), texts_of(b.column(1))):
                all_ids = np.append(np.frombuffer(encode(text), "<u4"), end).astype(dtype)
                ids.append(i.as_py())
                counts.append(len(all_ids))
                frames.append(zip_one(all_ids.tobytes()))
                held += len(frames[-1]) + 21
                if held >= BLOCK:
                    yield block()
                    number, held, inside = number + 1, 0, inside + sum(counts)
                    ids, counts, frames = [], [], []
        if ids:
            yield block()

    # the hash and the row's place deal rows of one id (a third of the table, say) over several ranges
    keys = [F.col("id").asc_nulls_last(), F.col("tie"), F.col("place")]
    tied = source.select("*", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place"))
    ordered = tied.repartitionByRange(width(spark), *keys).sortWithinPartitions(*keys).select("id", "text")
    fields = "part int, block int, inside long, first_id long, last_id long, n_docs long, n_ids long, data binary"
    ordered.mapInArrow(run, fields).write.option("compression", "none").parquet(f"{out}/blocks")

    parts = spark.read.parquet(f"{out}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part of the shuffle
    parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).write.parquet(f"{out}/starts")
    return out


def _dictionary(spark: SparkSession, out: str):
    d = spark.read.parquet(f"{out}/dictionary").first()
    return bytes(d.dictionary), bytes(d.hash), d.dtype


def read(spark: SparkSession, out: str, wanted: list[int] | None = None) -> DataFrame:
    """``(doc_id, start, ids)`` of the files' documents: the ids (unsigned 32-bit little-endian) and how many lie before them.

    ``wanted``: only these doc_ids, found through the blocks' ranges and offsets.
    """
    ship(spark)
    head = spark.read.parquet(f"{out}/dictionary").first()
    dictionary, mark, dtype = bytes(head.dictionary), bytes(head.hash), head.dtype
    blocks = spark.read.parquet(f"{out}/blocks")
    asked = None if wanted is None else frozenset(wanted)
    if asked is not None:
        hits = [(F.col("first_id") <= w) & ((F.col("last_id") >= w) | F.col("last_id").isNull()) for w in sorted(asked)]
        blocks = blocks.filter(reduce(or_, hits, F.lit(False)))
    # one row per part, at most as many as the shuffle had partitions when the files were written
    starts = F.broadcast(spark.read.parquet(f"{out}/starts"))
    source = blocks.join(starts, "part").select((F.col("base") + F.col("inside")).alias("start"), "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None).decompress
        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, known, counts, offsets, frames = unpack(data.as_py(), mark)
                ahead = start + np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                rows = [k for k in range(len(ids)) if asked is None or known[k] and int(ids[k]) in asked]
                raw = [np.frombuffer(unzip(frames[offsets[k] : offsets[k + 1]]), dtype).astype("<u4").tobytes() for k in rows]
                cols = [[int(ids[k]) if known[k] else None for k in rows], ahead[rows].tolist(), raw]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, DOCS)], schema=DOCS)

    return source.mapInArrow(run, "doc_id long, start long, ids binary")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids to the shared folder, read the files back: place, count and checksum of the ids."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = write(docs, scratch_dir(spark, "token-files"), public_tokenizers.path("byte_bpe_50k.json"))
    n = F.floor(F.octet_length("ids") / 4).cast("long")
    return read(spark, out).select("doc_id", "start", n.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
