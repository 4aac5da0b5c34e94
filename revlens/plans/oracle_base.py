"""DuckDB SQL for the fixture views and exact-rounding helpers.

Plain SQL over the driver tables; ``rhu`` states the same rounding rule as
the Spark code, so it checks the counts, not the rule.  Fixture views are common table expressions so each oracle
string is self-contained.
"""

from __future__ import annotations

from revlens.functions.constants import DASHBOARD_STOP_WORDS, MLLIB_ENGLISH_STOP_WORDS


def rhu(num: str, den: str, mult: int = 1, dp: int = 0) -> str:
    """Half-away-from-zero rounding of num*mult/den from integers (DuckDB)."""
    scale = mult * 10**dp
    q = f"((abs(CAST({num} AS BIGINT)) * {2 * scale} + ({den})) // (2 * ({den})))"
    return f"(CASE WHEN ({den}) = 0 THEN NULL ELSE CAST(CASE WHEN ({num}) < 0 THEN -{q} ELSE {q} END AS DOUBLE) / {10**dp} END)"


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


MLLIB_STOP_SQL = sql_list(MLLIB_ENGLISH_STOP_WORDS)
DASH_STOP_SQL = sql_list(sorted(set(DASHBOARD_STOP_WORDS)))

CLEAN = (
    "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({x}), "
    "'<[^>]+>', ' ', 'g'), 'https?://\\S+|www\\.\\S+', ' ', 'g'), '[^a-z\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
)


def clean(x: str) -> str:
    return CLEAN.format(x=x)


def full_text(summary: str = "Summary", text: str = "Text") -> str:
    return f"concat_ws(' ', coalesce({summary}, ''), coalesce({text}, ''))"


def label_of(score: str = "Score") -> str:
    return f"(CASE WHEN {score} BETWEEN 1 AND 2 THEN 0 WHEN {score} = 3 THEN 1 WHEN {score} BETWEEN 4 AND 5 THEN 2 END)"


def name_of(label: str) -> str:
    return f"(CASE {label} WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive' END)"


def index_of(sent: str = "predicted_sentiment") -> str:
    return f"(CASE {sent} WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END)"


def correct(sent: str = "predicted_sentiment", score: str = "Score") -> str:
    return (
        f"coalesce(({sent} = 'positive' AND {score} >= 4) OR ({sent} = 'negative' AND {score} <= 2) "
        f"OR ({sent} = 'neutral' AND {score} = 3), false)"
    )


def status(pos: str, neg: str, n: str) -> str:
    return f"(CASE WHEN 2 * ({pos} - {neg}) > {n} THEN 'OK' WHEN 5 * ({pos} - {neg}) > {n} THEN 'WATCH' ELSE 'ALERT' END)"


def month_of(t: str = "Time") -> str:
    return f"strftime(make_timestamp(CAST({t} AS BIGINT) * 1000000), '%Y-%m')"


def bucket_of(key: str, salt: str = "") -> str:
    k = f"CAST({key} AS VARCHAR)" if not salt else f"'{salt}' || CAST({key} AS VARCHAR)"
    return f"(CAST('0x' || substr(md5({k}), 1, 7) AS BIGINT) % 1000)"


def split_of(key: str = "Id") -> str:
    b = bucket_of(key)
    return f"(CASE WHEN {b} < 800 THEN 'train' WHEN {b} < 900 THEN 'val' ELSE 'test' END)"


# DuckDB 2.0.0 aborts ("dict-surviving cache ... changed identity") when an
# aggregate consumes dictionary vectors emitted by a hash join's build side.
# A LIMIT of the largest BIGINT removes no row but makes the view's output
# flat, which avoids that defect.
NO_CAP = "LIMIT 9223372036854775807"

REVIEWS = """
_l AS (
  SELECT l_orderkey, min(l_partkey) AS pk, count(*) AS n,
         sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS h
  FROM lineitem GROUP BY l_orderkey),
_nd AS (SELECT count(*) AS nd FROM documents),
_d AS (SELECT d.doc_id, d.text, _nd.nd FROM documents d, _nd),
_b AS (
  SELECT o.o_orderkey AS ok, o.o_custkey AS ck, o.o_orderdate, _l.pk, _l.n, _l.h, c.c_name, d.text,
         (o.o_orderkey * 7919 + o.o_custkey) % 100 AS s,
         (o.o_orderkey * 31 + o.o_custkey) % 10 AS m
  FROM orders o
  JOIN _l ON o.o_orderkey = _l.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN _d d ON d.doc_id = o.o_orderkey % d.nd),
_r AS (
  SELECT *, CASE WHEN s < 9 THEN 1 WHEN s < 14 THEN 2 WHEN s < 22 THEN 3 WHEN s < 36 THEN 4 ELSE 5 END AS score
  FROM _b),
reviews AS (
  SELECT CAST(ok AS INTEGER) AS Id,
         'P' || lpad(CAST(pk % 200 AS VARCHAR), 4, '0') AS ProductId,
         'U' || CAST(ck AS VARCHAR) AS UserId,
         CASE WHEN ck % 97 = 0 THEN NULL ELSE c_name END AS ProfileName,
         CAST(h AS INTEGER) AS HelpfulnessNumerator,
         CAST(n AS INTEGER) AS HelpfulnessDenominator,
         CAST(score AS INTEGER) AS Score,
         CAST(epoch(o_orderdate) AS BIGINT) AS Time,
         CASE WHEN ok % 13 = 0 THEN NULL ELSE substr(text, 1, 40) END AS Summary,
         text AS Text,
         CASE ((CASE WHEN score <= 2 THEN 0 WHEN score = 3 THEN 1 ELSE 2 END)
               + CASE m WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END) % 3
              WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS predicted_sentiment,
         CAST((ok * 1717 + ck * 31) % 6000 + 4000 AS DOUBLE) / 10000 AS confidence,
         o_orderdate AS processed_at
  FROM _r
  """ + NO_CAP + ")"

REVIEW_TEXT = """
review_text AS (
  SELECT CAST(d.doc_id AS INTEGER) AS Id, d.source AS ProductId, CAST(NULL AS VARCHAR) AS Summary,
         d.text AS Text,
         CAST(CASE WHEN l.toxic = 1 THEN 0 WHEN l.quality = 0 THEN 1 ELSE 2 END AS INTEGER) AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  """ + NO_CAP + ")"

DOCUMENT_TEXT = """
document_text AS (
  SELECT CAST(d.doc_id AS INTEGER) AS Id, d.source AS ProductId, CAST(NULL AS VARCHAR) AS Summary, d.text AS Text,
         CAST(CASE WHEN l.toxic = 1 THEN 0 WHEN l.quality = 0 THEN 1 WHEN l.doc_id IS NOT NULL THEN 2 END AS INTEGER) AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  """ + NO_CAP + ")"

DIRTY_TEXT = """
dirty_text AS (
  SELECT CAST(page_id AS INTEGER) AS Id, url AS Summary, html AS Text FROM pages)"""

def with_fixtures(body: str, *views: str) -> str:
    """Prefix ``body`` with the CTEs it needs (``views`` in dependency order)."""
    parts = {"reviews": REVIEWS, "review_text": REVIEW_TEXT, "document_text": DOCUMENT_TEXT, "dirty_text": DIRTY_TEXT}
    ctes = [parts[v].strip() for v in views]
    extra = ""
    if ctes:
        extra = "WITH " + ",\n".join(ctes)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return extra + ",\n" + body[5:] if extra else body
    return extra + "\n" + body
