"""Byte-pair encoding and decoding with a contiguous rank array per word.

The vocabulary file (parameter ``path``) is a public byte-level vocabulary whose
words end in ``</w>``.  A text goes through the file's steps: special strings
are cut out as they stand, the rest is brought to NFC, white space separates,
letters are lower-cased one by one, and a pattern splits off contractions, runs
of letters, single digits and runs of other signs.  No step looks across white
space, so a text is encoded run by run, and runs met before come from a bounded
table in the worker.

The merges of a word are done in two parallel lists: the parts between the
boundaries that are left, and the rank of the merge of every two neighbouring
parts.  The list of ranks is scanned for its minimum (the first one, if equal),
the boundary there is deleted, and the ranks on both sides of the new part are
looked up again.  That is quadratic, so a word of more than ``SHORT`` parts
takes its minima from a heap over linked parts instead, with the same result.

Results for odd input: a null or blank text has no ids and decodes to the empty
string; repeated rows are each returned; an empty table gives an empty result;
columns other than the two named are not read.  Texts are never cut.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import quoted, ship

# Unicode white space, the word pattern of the vocabulary, its word end.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
# Words of more parts than this are merged with a heap.
SHORT = 64
# Runs kept in a worker's table before it is emptied (it only saves time).
TABLE = 400_000
# Documents in an output batch.
ROWS = 256
_SEPARATORS = re.compile("[\x1c-\x1f]")
_RUNS = re.compile(f"[^{SPACE}]+")
_NONE = 1 << 60


def byte_letters() -> list[str]:
    """The printable stand-in of every byte: itself if printable in Latin-1, else the next letter from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


def merge_short(parts: list[int], rank: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge by the rank array; ``rank`` maps two neighbours to (rank, merged part)."""
    none = (_NONE, 0)
    ranks = [rank.get(p, none)[0] for p in zip(parts, parts[1:])]
    while ranks:
        least = min(ranks)
        if least == _NONE:
            break
        i = ranks.index(least)
        parts[i] = rank[parts[i], parts[i + 1]][1]
        del parts[i + 1], ranks[i]
        if i:
            ranks[i - 1] = rank.get((parts[i - 1], parts[i]), none)[0]
        if i < len(ranks):
            ranks[i] = rank.get((parts[i], parts[i + 1]), none)[0]
    return parts


def merge_long(parts: list[int], rank: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The same merges in n log n: a heap of (rank, place), entries of changed neighbours being skipped."""
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    end, alive = len(parts), [True] * len(parts)
    heap = [(rank[p][0], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in rank]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j == end or parts[i] != left or parts[j] != right:
            continue
        parts[i], alive[j] = rank[left, right][1], False
        after[i] = after[j]
        if after[i] != end:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] != end and (pair := (parts[k], parts[after[k]])) in rank:
                heapq.heappush(heap, (rank[pair][0], k, *pair))
    return [p for p, a in zip(parts, alive) if a]


class WordBpe(dict):
    """A vocabulary file; as a dict, the ids (unsigned 32-bit little-endian) of runs without white space."""

    def __init__(self, path: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(vocab[a], vocab[b]): (i, vocab[a + b]) for i, (a, b) in reversed(list(enumerate(pairs)))}
        letters = byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + WORD_END] for x in letters]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.cutter = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.words = regex.compile(WORDS)
        names = {i: t for t, i in (vocab | special).items()}
        self.path, self.splitter = path, None
        self.letter_bytes = {x: b for b, x in enumerate(letters)}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]

    def unassigned(self, piece: str) -> list[bytes]:
        """The words of a piece with code points that Python's Unicode tables do not have: split by the library's tables."""
        if self.splitter is None:
            from tokenizers import Tokenizer

            self.splitter = Tokenizer.from_file(self.path)
        found = self.splitter.pre_tokenizer.pre_tokenize_str(self.splitter.normalizer.normalize_str(piece))
        return [bytes(self.letter_bytes[x] for x in w) for w, _ in found]

    def word(self, word: bytes) -> list[int]:
        parts = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        return merge_short(parts, self.rank) if len(parts) <= SHORT else merge_long(parts, self.rank)

    def __missing__(self, run: str) -> bytes:
        out: list[int] = []
        for piece in self.cutter.split(run) if "<|" in run else (run,):
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                if not piece.isascii():
                    if any(unicodedata.category(c) == "Cn" for c in piece):
                        for w in self.unassigned(piece):
                            out += self.word(w)
                        continue
                    piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
                for w in self.words.findall(piece.lower()):
                    out += self.word(w.encode("utf-8"))
        got = self[run] = np.array(out, dtype="<u4").tobytes()
        return got

    def encode(self, text: str | None) -> bytes:
        """Ids of a text, unsigned 32-bit little-endian."""
        if not text:
            return b""
        # str.split also splits at U+001C..U+001F, which are no white space here
        runs = text.split() if not _SEPARATORS.search(text) else _RUNS.findall(text)
        if len(self) > TABLE:
            self.clear()
        return b"".join(map(self.__getitem__, runs))

    def decode(self, ids: bytes) -> bytes:
        """The text of ids in UTF-8: the names of the tokens with single spaces between."""
        return b" ".join(map(self.names.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, decoded)`` of every row: ids as unsigned 32-bit little-endian binary, decoded from those ids."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                ids = [bpe.encode(t.as_py()) for t in b.column(1)]
                decoded = [bpe.decode(i).decode("utf-8") for i in ids]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], names=["id", "ids", "decoded"])

    source = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of what :func:`encode_decode` returns."""
    n = F.floor(F.octet_length("ids") / 4).cast("long")
    return encoded.select(F.col("id").alias("doc_id"), n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


def op8(spark, sf_dir: str) -> DataFrame:
    """Token count and digests of every document's ids and decoded text."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")))
