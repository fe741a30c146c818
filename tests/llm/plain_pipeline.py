"""The pipeline's stages in plain Python, one document after the other.

Spark's hashes are taken as given numbers (the random draws); everything that is
done with them is written anew here.
"""

import math
import zlib
from collections import Counter

from pyspark.sql import functions as F
from test_mixing import count, shares
from test_simhash import classes, plain

from opinio.llm.common import row_hash

MIX, ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1


def numbered_rows(docs):
    """The rows with their hash."""
    return [(r, r["_tag"]) for r in docs.select("*", row_hash(docs, 0).alias("_tag")).collect()]


def hashes(text):
    return [zlib.crc32(w) + 1 for w in (text or "").encode().lower().split()]


def features(h):
    words = [(x * MIX & ALL) >> 48 for x in h]
    return words + [((x * MIX & ALL) ^ (y + MIX & ALL)) * MIX % (1 << 64) >> 48 for x, y in zip(h, h[1:])]


def toxic_words(h):
    return {(x * MIX & ALL) >> 46 & (1 << 18) - 1 for x in h}


def cut_between(good, bad):
    """The threshold with the best mean share, among those that lose at most 0.2 % of the good, half way to the next bad one."""
    if not good or not bad:
        return None
    good = sorted(good)
    best = max(good[: int(0.002 * len(good) + 1e-9) + 1], key=lambda c: (sum(g >= c for g in good) / len(good) + sum(b < c for b in bad) / len(bad), c))
    below = [b for b in bad if b < best]
    return (best + max(below)) / 2 if below else best


def keep_good(docs, labels):
    """Places of the rows that importance resampling keeps."""
    rows = numbered_rows(docs)
    draws = [r[0] for r in docs.select(-F.log(-F.log((F.shiftrightunsigned(F.xxhash64(row_hash(docs, 0)), 11) + 0.5) / 2.0**53))).collect()]
    marks = {}
    for r in labels.select("doc_id", "quality", "toxic", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half")).collect():
        if r.doc_id is not None and r.quality is not None:
            marks.setdefault(r.doc_id, []).append(r)
    good = {i for i, x in marks.items() if min(r.quality for r in x) == 1 and max(r.toxic or 0 for r in x) == 0}
    toxic = {i for i, x in marks.items() if max(r.toxic or 0 for r in x) == 1}
    fits = {i for i, x in marks.items() if x[0].half == 0}
    h = [hashes(r.text) for r, _ in rows]
    raw, target, held, seen = Counter(), Counter(), Counter(), Counter()
    for (r, _), x in zip(rows, h):
        raw.update(features(x))
        held.update(toxic_words(x))
        if r.doc_id in good & fits:
            target.update(features(x))
        if r.doc_id in toxic & fits:
            seen.update(toxic_words(x))
    n, m, share = sum(raw.values()), sum(target.values()), sum(r.doc_id in toxic & fits for r, _ in rows) / len(rows)
    added = 0.01 * m + 1

    def ratio(b):
        p = (raw[b] + 1 / 65536) / (n + 1)
        return math.log((target[b] + added * p) / (m + added)) - math.log(p)

    ratios = {b: ratio(b) for b in raw}
    evidence = {b: max(0.0, math.log((c + 5) / (held[b] * share + 5))) for b, c in seen.items()}
    weight = [1000 * math.fsum(ratios[b] for b in features(x)) / (len(features(x)) + 50) for x in h]
    clean = [-max((evidence.get(b, 0.0) for b in toxic_words(x)), default=0.0) for x in h]

    def on(values, ids):
        out = {}
        for (r, _), v in zip(rows, values):
            if r.doc_id in ids and r.doc_id not in fits:
                out[r.doc_id] = min(v, out.get(r.doc_id, math.inf))
        return list(out.values())

    tau = cut_between(on(weight, good), on(weight, set(marks) - good))
    if tau is None:
        return [r for r, _ in rows]
    limit = cut_between(on(clean, good), on(clean, toxic - good))
    if limit is not None:
        weight = [min(w, tau + 1000 * (c - limit)) if c < limit else w for w, c in zip(weight, clean)]
    keys = [w + d for w, d in zip(weight, draws)]
    k = sum(w >= tau for w in weight)
    least = sorted(keys, reverse=True)[k - 1] if k else -math.inf
    return [r for (r, _), key in zip(rows, keys) if key >= least]


def drop_copies(rows):
    """Of each group within two bits the row of smallest id."""
    keep = {c for _, _, c in classes([(r.doc_id, plain(r.text)) for r in rows])}
    return [r for r in rows if r.doc_id in keep]


def mix(docs):
    """Every row as often as the queue serves it before the budget is spent."""
    rows = [(tag, r.doc_id, r.source, count(r.text), r) for r, tag in numbered_rows(docs)]
    sizes = Counter()
    for _, _, s, size, _ in rows:
        sizes[s] += size
    target, line = shares(sizes), []
    for s in sizes:
        reached = 0
        for tag, i, _, size, r in sorted((x for x in rows if x[2] == s and x[3]), key=lambda x: x[:2]):
            reached += size
            line += [(((e - 1) * sizes[s] + reached) / target[s], tag, i, e, size, r) for e in (1, 2, 3)]
    out, total = [], 0
    for *_, size, r in sorted(line, key=lambda x: x[:4]):
        total += size
        if total > sum(sizes.values()):
            break
        out.append(r)
    return out
