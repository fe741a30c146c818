"""Text scoring by a subword lattice: all segmentations count, by log-space forward recursion.

Tokens are words (A-Z lower-cased, runs outside space and U+0009..U+000D) and
one end per text.  The model of a text is the product of its tokens'
probabilities; that of a word is the marginal of a lattice over its bytes:

a path starts with a word-initial piece of an existing vocabulary (pieces with
the word mark) and goes on with inner pieces or single bytes, then stops.  Initial
pieces sum to 1, and so do inner pieces, bytes and the stop.  Every path goes
through pieces of the vocabulary alone; a word that was seen has no edge of its own.

The vocabulary's scores are merge ranks, so a piece first weighs 1 / (rank +
``RANK_SHIFT``).  One round of expectation-maximisation over all training words,
each distinct word once with its count (forward and backward, expected uses of each
piece), adapts these weights to the corpus; a piece that is never used keeps a small
part of them.  Words and the end share the tokens as they do in training, so that the
probabilities of all texts add up to 1.

``word_score`` is beside it for comparison: there a word with count c > 0 has one more
path, an edge over the whole word of weight (c - D) / N, and the words' paths
through pieces share what the discount D leaves of the words' part.

At scale: words are counted in each task and summed by a shuffle.  Words whose
count passes a threshold taken from a histogram of the counts, at most
``HEAD_WORDS`` of them whatever the corpus, are broadcast with their scores; the
rest of a text's words (each once with its frequency) are joined to the counts
by word, scored there, and summed up by row.  Nothing is left out.

Results for odd input: a null or blank text is its end alone; a null id is
trained on; repeated rows are each counted and returned; an empty table gives an
empty result, and without training rows every word is unknown; other columns
are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import cut, quoted, ship, texts_of, words_of

# The word mark of the vocabulary, the base score's added count, the folds.
MARK = "▁"
ADDED = 0.5
FOLDS, HELD_OUT = 5, 1
# Parameters of the model.
RANK_SHIFT = 50.0
KEPT = 1e-3  # of the first weights, as a share of all uses
HEAD_WORDS = 300_000
# Distinct words that a task counts before it sends its counts on.
FLUSH = 300_000
# Texts in an output batch.
ROWS = 512
_LN10 = math.log(10)


class Pieces:
    """The vocabulary: initial and inner pieces and bytes, each with a number; ``first`` their first weights."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.initial: dict[bytes, int] = {}
        self.inner: dict[bytes, int] = {}
        first = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or MARK in piece[1:]:
                continue
            if piece.startswith(MARK):
                where, text = self.initial, piece[1:].encode()
            else:
                where, text = self.inner, piece.encode()
            if text not in where and len(text) != 1:  # single inner bytes come below
                where[text] = len(first)
                first.append(1 / (RANK_SHIFT - model.get_score(i)))
            elif text not in where and where is self.initial:
                where[text] = len(first)
                first.append(1 / (RANK_SHIFT - model.get_score(i)))
        self.initial.setdefault(b"", len(first))
        first += [1 / RANK_SHIFT] * (len(self.initial) + len(self.inner) - len(first))
        for b in range(256):
            self.inner[bytes([b])] = len(first)
            first.append(1 / (RANK_SHIFT + model.get_piece_size()))
        self.stop = len(first)
        first.append(sum(first) / 8)
        self.first = np.array(first)
        self.is_initial = np.zeros(len(first), dtype=bool)
        self.is_initial[list(self.initial.values())] = True
        # how long an inner piece can be, by its first two bytes
        self.longest: dict[bytes, int] = {}
        for p in self.inner:
            self.longest[p[:2]] = max(self.longest.get(p[:2], 1), len(p))
        self.longest_initial = max(map(len, self.initial))

    def weights(self, uses: np.ndarray | None = None) -> np.ndarray:
        """Probabilities of all pieces from expected uses (None: from the first weights): initial, and inner with the stop."""
        out = np.zeros(len(self.first))
        for group in (self.is_initial, ~self.is_initial):
            prior = self.first * group / (self.first * group).sum()
            total = 0.0 if uses is None else float((uses * group).sum())
            out += prior if not total else (uses * group + KEPT * total * prior) / (total * (1 + KEPT))
        return out

    def starts(self, word: bytes) -> list[tuple[int, int]]:
        """``(to, piece)`` from before the word."""
        return [(j, p) for j in range(min(len(word), self.longest_initial) + 1) if (p := self.initial.get(word[:j])) is not None]

    def onward(self, word: bytes, i: int) -> list[tuple[int, int]]:
        """``(to, piece)`` from place ``i`` of the word."""
        get, longest = self.inner.get, self.longest.get(word[i : i + 2], 1)
        return [(j, p) for j in range(i + 1, min(len(word), i + longest) + 1) if (p := get(word[i:j])) is not None]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum([math.exp(t - top) for t in terms])) if len(terms) > 1 and top > -math.inf else top


def forward(word: bytes, vocabulary: Pieces, logs: list[float]) -> float:
    """Natural log of the word's marginal over all segmentations; ``logs`` are the pieces' log weights.

    Of a long word only the places that a piece can still reach are held.
    """
    n = len(word)
    get, longest = vocabulary.inner.get, vocabulary.longest.get
    long = n > 1024
    reach = defaultdict(list) if long else [[] for _ in range(n + 1)]
    for j, p in vocabulary.starts(word):
        reach[j].append(logs[p])
    for i in range(n):
        if terms := reach[i]:
            at = terms[0] if len(terms) == 1 else _log_sum(terms)
            for j in range(i + 1, min(n, i + longest(word[i : i + 2], 1)) + 1):
                if (p := get(word[i:j])) is not None:
                    reach[j].append(at + logs[p])
        if long:
            del reach[i]
    return _log_sum(reach[n]) + logs[vocabulary.stop]


def expected(word: bytes, vocabulary: Pieces, probs: list[float], logs: list[float], uses: list[float], times: float = 1) -> None:
    """Add the expected uses of every piece in ``times`` occurrences of ``word`` (forward and backward sums).

    Long words, whose sums would underflow, go by logarithms and hold two numbers a byte.
    """
    start = vocabulary.starts(word)
    n = len(word)
    uses[vocabulary.stop] += times
    if n <= 48:
        get, longest = vocabulary.inner.get, vocabulary.longest.get
        inner = [[(j, p) for j in range(i + 1, min(n, i + longest(word[i : i + 2], 1)) + 1) if (p := get(word[i:j])) is not None] for i in range(n)]
        a, b = [0.0] * (n + 1), [0.0] * (n + 1)
        for j, p in start:
            a[j] += probs[p]
        for i, out in enumerate(inner):
            for j, p in out:
                a[j] += a[i] * probs[p]
        if a[n] > 1e-280:
            b[n] = times / a[n]
            for i in range(n - 1, -1, -1):
                for j, p in inner[i]:
                    back = b[j] * probs[p]
                    b[i] += back
                    uses[p] += a[i] * back
            for j, p in start:
                uses[p] += probs[p] * b[j]
            return
    reach: dict[int, list[float]] = {}
    for j, p in start:
        reach.setdefault(j, []).append(logs[p])
    fore = np.full(n + 1, -np.inf)
    for i in range(n + 1):
        if terms := reach.pop(i, None):
            fore[i] = at = _log_sum(terms)
            for j, p in vocabulary.onward(word, i):
                reach.setdefault(j, []).append(at + logs[p])
    back_logs = np.full(n + 1, -np.inf)
    back_logs[n] = math.log(times) - fore[n]
    for i in range(n - 1, -1, -1):
        out = vocabulary.onward(word, i)
        back_logs[i] = _log_sum([float(back_logs[j]) + logs[p] for j, p in out])
        for j, p in out:
            uses[p] += math.exp(min(math.log(times), float(fore[i]) + logs[p] + float(back_logs[j])))
    for j, p in start:
        uses[p] += math.exp(min(math.log(times), logs[p] + float(back_logs[j])))


class Model:
    """What scoring needs besides the counts: a few numbers and a weight for each piece of the vocabulary."""

    def __init__(self, path: str, probs: np.ndarray, words: int, ends: int, distinct: int, once: int, twice: int) -> None:
        self.path, self.ends, self.tokens = path, ends, words + ends
        self.logs = [math.log(x) if x else -math.inf for x in probs]
        # V of the base score counts the end as a distinct token, if there is one
        self.base = self.tokens + ADDED * (distinct + (ends > 0) + 1)
        self.discount = once / (once + 2 * twice) if once and twice else 0.5
        # the end and the words share all tokens, half a token more each
        self.shared = self.tokens + 2 * ADDED
        self.words_share = (words + ADDED) / self.shared
        self.unseen_share = (self.discount * distinct + ADDED) / self.shared

    def known(self, c: int) -> float:
        return math.log10((c + ADDED) / self.base)

    def word(self, word: bytes, c: int) -> tuple[float, float]:
        """log10 of the word's marginal over its segmentations, and of the one with a whole-word edge if the word was seen."""
        by_pieces = forward(word, pieces(self.path), self.logs)
        whole = by_pieces + math.log(self.unseen_share)
        if c:
            whole = _log_sum([whole, math.log((c - self.discount) / self.shared)])
        return (by_pieces + math.log(self.words_share)) / _LN10, whole / _LN10

    def end(self) -> float:
        return math.log10((self.ends + ADDED) / self.shared)


def held_out(id_col: str) -> Column:
    """Whether a row is kept out of training; a null id is not."""
    return F.coalesce(F.crc32(quoted(id_col).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def count_words(texts: DataFrame) -> DataFrame:
    """``(word, c)`` over all rows of ``texts`` (one string column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names=["word", "c"])
            seen.clear()
            return made

        for b in batches:
            for t in b.column(0):
                seen.update(words_of(t.as_py()))
                if len(seen) >= FLUSH:
                    yield out()
        yield out()

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def adapt(words: DataFrame, path: str) -> np.ndarray:
    """Piece weights after one round over ``words`` with their counts; the sums come back as one number a piece."""
    vocabulary = pieces(path)
    begin = vocabulary.weights()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path)
        probs, logs, uses = begin.tolist(), np.log(begin).tolist(), [0.0] * len(begin)
        for b in batches:
            for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                expected(w, own, probs, logs, uses, c)
        used = [i for i, x in enumerate(uses) if x]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([uses[i] for i in used], pa.float64())], names=["piece", "uses"])

    uses = np.zeros(len(begin))
    for r in words.select("word", "c").mapInArrow(run, "piece int, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
        uses[r.piece] = r.uses
    return vocabulary.weights(uses)


def head_count(counts: DataFrame, most: int = HEAD_WORDS) -> int:
    """The least count whose words, with those of greater counts, are at most ``most``."""
    step = F.floor(F.log2(F.col("c")) * 16).cast("int")
    histogram = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).collect()
    total, least = 0, 1 << 62
    for r in sorted(histogram, key=lambda r: -r.step):
        if total + r.n > most:
            break
        total, least = total + r.n, r.least
    return least


def fit(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[Model, DataFrame]:
    """The model of the training rows of ``docs``, and the counts ``(word, c)`` it belongs to."""
    ship(docs.sparkSession)
    training = docs.filter(~held_out(id_col)).select(quoted(text_col).cast("string").alias("text"))
    counts = cut(count_words(training), "lm-counts")
    s = counts.agg(F.sum("c"), F.count(F.lit(1)), F.count(F.when(F.col("c") == 1, 1)), F.count(F.when(F.col("c") == 2, 1))).first()
    probs = adapt(counts, path) if s[1] else pieces(path).weights()
    return Model(path, probs, s[0] or 0, training.count(), *s[1:]), counts


REST = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int32())]))
SUMS = pa.schema([("row", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("word_score", pa.float64())])


def score(docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text", head_words: int = HEAD_WORDS) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, base_score, score, word_score)`` of every row, in log10."""
    spark = docs.sparkSession
    ship(spark)
    least = head_count(counts, head_words)

    def score_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            lattice, whole = zip(*[model.word(w, c) for w, c in both]) if both else ((), ())
            cols = [b.column(0), *(pa.array(x, pa.float64()) for x in ([model.known(c) for _, c in both], lattice, whole))]
            yield pa.RecordBatch.from_arrays(cols, names=["word", "base", "score", "word_score"])

    # at most head_words rows, see head_count
    frequent = counts.filter(F.col("c") >= least).mapInArrow(score_head, "word binary, base double, score double, word_score double")
    head = spark.sparkContext.broadcast({bytes(r.word): (r.base, r.score, r.word_score) for r in frequent.collect()})

    def score_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = head.value, (model.known(model.ends), model.end())
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                b = batch.slice(at, ROWS)
                rows = []
                for t in texts_of(b.column(3)):
                    seen = Counter(words_of(t))
                    n, (base, total), whole, rest = 0, end, end[1], []
                    for w, k in seen.items():
                        if found := known.get(w):
                            n, base, total, whole = n + k, base + k * found[0], total + k * found[1], whole + k * found[2]
                        else:
                            rest.append({"word": w, "times": k})
                    rows.append((sum(seen.values()) + 1, n + (model.ends > 0), base, total, whole, rest))
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), REST))]
                yield pa.RecordBatch.from_arrays([*b.columns[:3], *cols], names=["id", "held_out", "row", "n_tokens", "n_known", "base", "score", "word_score", "rest"])

    def score_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[bytes, tuple[float, float, float]] = {}  # a sorted join brings a word's rows together
        for b in batches:
            rows = []
            for i, w, k, c in zip(*(x.to_pylist() for x in b.columns)):
                if w not in last:
                    if len(last) > 10_000:
                        last.clear()
                    last[w] = (model.known(c), *model.word(w, c))
                rows.append((i, k if c else 0, *(k * x for x in last[w])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SUMS)], schema=SUMS)

    # the row numbers are written with the rows, so they stay the same in whatever is run again
    source = docs.select(quoted(id_col).alias("id"), held_out(id_col).alias("held_out"), F.monotonically_increasing_id().alias("row"), quoted(text_col).cast("string").alias("text"))
    fields = f"id {source.schema['id'].dataType.simpleString()}, held_out boolean, row long, n_tokens long, n_known long, base double, score double, word_score double, rest array<struct<word: binary, times: int>>"
    texts = cut(source.mapInArrow(score_texts, fields), "lm-texts")
    rest = texts.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.times")
    joined = rest.join(counts, "word", "left").select("row", "word", "times", F.coalesce("c", F.lit(0)).alias("c"))
    sums = joined.mapInArrow(score_rest, "row long, n_known long, base double, score double, word_score double")
    sums = sums.groupBy("row").agg(*(F.sum(x).alias(f"more_{x}") for x in ("n_known", "base", "score", "word_score")))
    more = [(F.col(x) + F.coalesce(F.col(f"more_{x}"), F.lit(0))).alias(y) for x, y in (("n_known", "n_known"), ("base", "base_score"), ("score", "score"), ("word_score", "word_score"))]
    return texts.drop("rest").join(sums, "row", "left").select("id", "held_out", "n_tokens", *more)


def op5(spark, sf_dir: str) -> DataFrame:
    """Every document with its token counts, base score and lattice score."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model, counts = fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    scored = score(docs, model, counts)
    return scored.select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "word_score")
