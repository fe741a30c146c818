"""DuckDB oracle text: the fixtures and derived review tables as common table expressions.

The oracle is an independent statement of each operator's semantics in plain
SQL.  Engine differences that matter (all checked on the fixtures):

* RE2 ``\\s`` lacks the vertical tab, so the kept class lists whitespace
  explicitly and the flag ``'g'`` replaces every match;
* DuckDB's ``trim(x)`` trims more than spaces, Spark's ``trim`` only spaces;
* DuckDB rounds on a cast to INTEGER, Spark truncates: ``trunc`` first;
* DuckDB sorts nulls last by default, Spark first: ``NULLS FIRST``;
* ``row_number``/``dense_rank`` are BIGINT in DuckDB: cast to INTEGER;
* rounded ratios are computed in integers (half up on the exact value).
"""

from __future__ import annotations

from opinio.fixtures import duck_cte
from opinio.functions.sentiment import CONFIDENCE_BY_RATING, CONFIDENCE_OTHERWISE, NEGATIVE_WORDS, POSITIVE_WORDS

# The kept character class in RE2 syntax and the first-number pattern.
KEEP_RE2 = r"[^a-zA-Z0-9\t\n\x0B\f\r ]"
FIRST_NUMBER_RE2 = r"(\d+\.?\d*)"


def clean_first(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '{KEEP_RE2}', '', 'g'), ' ')"


def clean_last(x: str) -> str:
    return f"lower(trim(regexp_replace(CAST({x} AS VARCHAR), '{KEEP_RE2}', '', 'g'), ' '))"


def first_number(x: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract(CAST({x} AS VARCHAR), '{FIRST_NUMBER_RE2}', 1), '') AS FLOAT)"


def label(x: str) -> str:
    return f"CASE WHEN {x} >= 4 THEN 'Positive' WHEN {x} <= 2 THEN 'Negative' ELSE 'Neutral' END"


def flag(x: str, word: str) -> str:
    return f"(CASE WHEN contains({x}, '{word}') THEN 1 ELSE 0 END)"


def score(x: str, words) -> str:
    return "(" + " + ".join(flag(x, w) for w in words) + ")"


def confidence(x: str) -> str:
    whens = " ".join(f"WHEN {x} = {r} THEN {v}" for r, v in CONFIDENCE_BY_RATING.items())
    return f"CAST(CASE {whens} ELSE {CONFIDENCE_OTHERWISE} END AS DOUBLE)"


def percent(c: str, t: str) -> str:
    return f"CAST((20000 * {c} + {t}) // (2 * {t}) AS DOUBLE) / 100"


def round2_avg_int(x: str) -> str:
    """round(avg(x), 2) half up for integer x, exact."""
    return f"CAST((200 * sum({x}) + count({x})) // (2 * count({x})) AS DOUBLE) / 100"


def round2_avg_halves(x: str) -> str:
    """round(avg(x), 2) half up for x in multiples of 0.5 (integer arithmetic on 2x)."""
    s2 = f"CAST(sum({x} * 2) AS BIGINT)"
    return f"CAST((100 * {s2} + count({x})) // (2 * count({x})) AS DOUBLE) / 100"


def record_id(cols: list[str]) -> str:
    parts = " || ".join(
        f"CASE WHEN {c} IS NULL THEN 'N' ELSE length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END" for c in cols
    )
    return f"sha256({parts})"


UNIVERSAL_COLUMNS = ["user_id", "product_id", "Product_name", "rating_raw", "Rating", "review",
                     "review_clean", "Rating_Cleaned"]
UNIVERSAL_SENTIMENT_COLUMNS = UNIVERSAL_COLUMNS + ["sentiment"]

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "reviews_raw": (duck_cte("reviews_raw"), ()),
    "doc_reviews": (duck_cte("doc_reviews"), ()),
    "cell_log": (duck_cte("cell_log"), ()),
    "predictions": (duck_cte("predictions"), ()),
    "recs_flat": (duck_cte("recs_flat"), ()),
    # JOB-1 on reviews_raw
    "cleaned_reviews": (f"""
SELECT user_id, product_id, rating, review, review_clean FROM (
  SELECT user_id, product_id, TRY_CAST(trunc(rating) AS INTEGER) AS rating, review,
    {clean_first('review')} AS review_clean
  FROM (SELECT DISTINCT * FROM reviews_raw) d
  WHERE review IS NOT NULL AND rating IS NOT NULL AND NOT isnan(rating)) c
WHERE length(review_clean) >= 5 AND rating BETWEEN 1 AND 5 AND length(review_clean) <= 5000
""", ("reviews_raw",)),
    # reviews_raw without its id columns (surrogate ids are generated)
    "raw_no_ids": ("SELECT product_name, rating_raw, rating, review FROM reviews_raw", ("reviews_raw",)),
    # one row per distinct review row with the checks of each cleaning step
    "funnel_rows": (f"""
SELECT review IS NOT NULL AND rating IS NOT NULL AND NOT isnan(rating) AS present,
  length({clean_first('review')}) AS len, TRY_CAST(trunc(rating) AS INTEGER) AS r
FROM (SELECT DISTINCT * FROM reviews_raw) x
""", ("reviews_raw",)),
    # JOB-2
    "sentiment_results": (f"""
SELECT user_id, product_id, rating, review, review_clean,
  {label('rating')} AS sentiment,
  {score('review_clean', POSITIVE_WORDS)} AS positive_score,
  {score('review_clean', NEGATIVE_WORDS)} AS negative_score,
  {confidence('rating')} AS confidence
FROM cleaned_reviews
""", ("cleaned_reviews",)),
    # JOB-4 on reviews_raw: review = review, rating = rating, product = product_name
    "universal": (f"""
SELECT user_id, product_id, CAST(product_name AS VARCHAR) AS Product_name, rating_raw,
  coalesce({first_number('rating')}, CAST(3.0 AS FLOAT)) AS Rating,
  review, {clean_last('review')} AS review_clean,
  coalesce({first_number('rating')}, CAST(3.0 AS FLOAT)) AS Rating_Cleaned
FROM (SELECT DISTINCT * FROM reviews_raw) d
WHERE review IS NOT NULL
""", ("reviews_raw",)),
    "universal_sentiment": (f"""
SELECT *, {label('Rating_Cleaned')} AS sentiment FROM universal
""", ("universal",)),
    "sentiment_docs": (f"""
SELECT {record_id(UNIVERSAL_SENTIMENT_COLUMNS)} AS _id, * FROM universal_sentiment
""", ("universal_sentiment",)),
    "recs_json": ("""
SELECT CAST(user_id AS INTEGER) AS user_id,
  CAST(to_json(list({'product_id': CAST(product_id AS INTEGER), 'rating': CAST(predicted_rating AS FLOAT)}
                     ORDER BY rn)) AS VARCHAR) AS recommendations
FROM recs_flat GROUP BY user_id
""", ("recs_flat",)),
    # KV-5 state, stated with NOT EXISTS
    "kv_state": ("""
SELECT p.row_key, p.family, p.qualifier, p.value FROM cell_log p
WHERE p.op = 'put'
  AND NOT EXISTS (SELECT 1 FROM cell_log x WHERE x.row_key = p.row_key AND x.family = p.family
                  AND x.qualifier = p.qualifier AND x.op IN ('put', 'delete_column') AND x.seq > p.seq)
  AND NOT EXISTS (SELECT 1 FROM cell_log r WHERE r.row_key = p.row_key AND r.op = 'delete_row' AND r.seq > p.seq)
""", ("cell_log",)),
}


def with_ctes(body: str, *needs: str) -> str:
    """``WITH`` every needed table expression (dependencies first), then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body
    defs = ",\n".join(f"{n} AS (\n{CTES[n][0].strip()}\n)" for n in order)
    return f"WITH {defs}\n{body.strip()}"
