import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_helpers import DOCS, clashing, rows
from pyspark.sql import functions as F

from opinio.llm import geometric

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in TERM.findall(text or "")]


def brute(items, docs, k=20):
    """The contract, read literally, for all pairs."""
    docs = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, words, df = len(docs), sum(sum(c.values()) for _, c in docs), Counter(t for _, c in docs for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c in docs:
            m = 100 - 25 + 25 * sum(c.values()) * n // words
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def pairs(df, a, b):
    return [(r[a], r[b]) for r in df.select(a, b).collect()]


def test_terms():
    text = "It's A-1 Straße ÉTÉ ǅ  \x1c_x`y{z} 日本語\tx\x7fy\x80z"
    assert [t.decode() for piece in geometric.terms_of(text) for t in piece] == terms(text)
    every = " ".join(chr(c) + "a" for c in range(0x3000) if not 0xD800 <= c < 0xE000)
    assert [t.decode() for piece in geometric.terms_of(every) for t in piece] == terms(every)
    long = "Word, " * 700_000 + "y" * 3_000_000 + " end"
    pieces = list(geometric.terms_of(long))
    assert len(pieces) > 3 and sum(map(len, pieces)) == 700_002 and pieces[-1][-1] == b"end"
    assert list(geometric.terms_of(None)) == list(geometric.terms_of("")) == []


def corpus(count, seed, words=300):
    rng = np.random.default_rng(seed)
    topics = [rng.zipf(1.3, 4000) * (t + 3) % words for t in range(5)]
    return [(i, " ".join(f"w{x}" for x in rng.choice(topics[i % 5], rng.integers(5, 60)))) for i in range(count)]


def test_against_brute_force(spark):
    docs = corpus(900, 1) + [(5000 + i, "w1 w2 w3") for i in range(60)]  # ties
    items = [(i, t) for i, (_, t) in enumerate(corpus(25, 2))] + [(99, "w1 w1 w2"), (100, "unheard of"), (101, None), (102, "W1, w2!")]
    got = geometric.search(spark.createDataFrame(items, ITEMS), spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert rows(got) == brute(items, docs)


def test_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(geometric, "TERMS", 40)
    docs, items = corpus(200, 3), [(i, t) for i, (_, t) in enumerate(corpus(12, 4))]
    frame = spark.createDataFrame(items, ITEMS)
    assert len(list(geometric.query_blocks(frame, "item_id", "text"))) > 2
    assert rows(geometric.search(frame, spark.createDataFrame(docs, "doc_id long, text string"))) == brute(items, docs)


def test_bounds_hold_and_blocks_are_skipped():
    docs = corpus(3000, 5)
    counts = [Counter(terms(t)) for _, t in docs]
    number = {t: i for i, t in enumerate(sorted({t for c in counts for t in c}))}
    s = geometric.Statistics(len(docs), sum(sum(c.values()) for c in counts), np.array([math.floor(1000 * math.log((2 * 3000 + 2) / (2 * sum(t in c for c in counts) + 1))) for t in number]))
    sizes = np.array([len(c) for c in counts])
    ids, tfs = np.array([number[t] for c in counts for t in c]), np.array([v for c in counts for v in c.values()])
    n = np.array([sum(c.values()) for c in counts])
    q = geometric.Queries(list(range(30)), [np.array([number[t] for t in counts[d]]) for d in range(0, 3000, 100)], [], number)
    near = [x if len(x) else np.array([t]) for t, x in enumerate(q.consulted(s.place))]
    made = geometric.segment(n, sizes, ids, tfs, s, near, geometric._signs(len(number)))
    arrays = [pa.array([list(range(3000))]), *(pa.array([made[k].astype(v).tobytes()]) for k, v in geometric.SEGMENT_ARRAYS.items())]
    seg = geometric.Segment(pa.RecordBatch.from_arrays(arrays, names=["ids", *geometric.SEGMENT_ARRAYS]), len(number))
    # every posting is in exactly one block of its list
    for t in range(len(number)):
        b = seg.blocks_of(np.array([t]))
        assert sorted(seg.members[geometric._lists(seg.member_starts[b], seg.block_docs[b])]) == [d for d in range(3000) if t in seg.terms[seg.starts[d] : seg.doc_ends[d]]]
    read = every = 0
    for d in range(0, 3000, 100):
        q = np.unique(seg.terms[seg.starts[d] : seg.doc_ends[d]])
        asked = np.zeros(len(number), dtype=np.int64)
        asked[q] = 1
        # a document's score is within the bound of its block in the list of its first query term
        for t in q:
            blocks = seg.blocks_of(np.array([t]))
            for b, bound in zip(blocks, seg.bounds(blocks, asked)):
                inside = seg.members[seg.member_starts[b] : seg.member_starts[b] + seg.block_docs[b]]
                here = [x for x in inside if min((y for y in seg.terms[seg.starts[x] : seg.doc_ends[x]] if asked[y]), key=s.place.__getitem__) == t]
                assert not here or seg.scores(np.array(here), asked).max() <= bound
        best = geometric.Best(20, 1)
        r, n = geometric.ask(seg, asked, q, best, None)
        read, every = read + r, every + n
        scores = seg.scores(np.arange(3000), asked)
        want = np.lexsort((np.arange(3000), -scores))[:20]
        assert best.id.tolist() == want.tolist() and best.score.tolist() == scores[want].tolist()
    assert read < 0.5 * every


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "One two"), (1, "One two"), (1, "word x"), (None, "two ÉTÉ"), (2, None), (3, ""), (4, "z " * 50)], ITEMS)
    want = brute(pairs(items, "item_id", "text"), pairs(odd_docs, "doc_id", "text"))
    assert rows(geometric.search(items, odd_docs)) == want and len(want) > 5
    assert rows(geometric.search(clashing(items), clashing(odd_docs))) == want
    assert rows(geometric.search(items, no_docs)) == [] and rows(geometric.search(items.limit(0), odd_docs)) == []
    assert geometric.search(items.limit(0), no_docs).columns == ["item_id", "rank", "doc_id", "score"]


def test_a_document_that_is_a_third_of_all(spark):
    docs = [(7, "same words here")] * 1500 + [(i, f"same w{i} words") for i in range(3000)]
    items = spark.createDataFrame([(1, "same words"), (2, "here w5 w6")], ITEMS)
    got = geometric.search(items, spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(got) == brute(pairs(items, "item_id", "text"), docs)


def test_columns_of_the_query(spark):
    got = geometric.op11(spark, "/root/testdata/sf0.001")
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert got.groupBy("item_id").agg(F.count("*").alias("n"), F.max("rank").alias("r")).filter("n <> r OR n > 20").count() == 0
    assert DOCS["doc_id"].dataType == got.schema["doc_id"].dataType
