"""Queries of the training-data operators over the sample tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm import (
    collocations,
    decontaminate,
    divergence,
    html,
    jaccard,
    licenses,
    linededup,
    lmscore,
    mil,
    mixing,
    pii,
    quality,
    secrets,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_decontamination(spark, sf_dir):
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WHITE_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

ORACLE["op1_decontamination"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, i, bw.n FROM dw JOIN bw ON dw.s = bw.s AND dw.n = bw.n),
p AS (SELECT doc_id, count(DISTINCT k) n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) k FROM h) GROUP BY 1),
m AS (SELECT doc_id, count(*) n_items, string_agg(x, ',' ORDER BY x) ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) x FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, CAST(coalesce(n_hit, 0) AS BIGINT) n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) n_items, sha256(coalesce(ids, '')) items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id)
"""


@_query
def op2_mixing(spark, sf_dir):
    rows = mixing.repetition(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


# Sources in order of the rate at which they reach their cap: the capped ones are a prefix of it.
_TARGETS = """
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) source_size FROM sized GROUP BY 1),
ranked AS (SELECT *, 2 * source_size cap,
  CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END w FROM sizes),
ordered AS (SELECT *, sum(cap) OVER o caps, sum(w) OVER () - sum(w) OVER o rest, sum(source_size) OVER () total
  FROM ranked WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
cut AS (SELECT coalesce(max(caps) FILTER (WHERE capped), 0) caps,
  coalesce(min(rest) FILTER (WHERE capped), max(all_w)) rest, max(total) total
  FROM (SELECT *, sum(w) OVER () all_w,
    cap * 2 * (rest + w) <= w * (3 * total - 2 * (caps - cap)) capped FROM ordered)),
targets AS (SELECT source, source_size, CASE WHEN rest = 0 THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE),
  w * CAST(3 * c.total - 2 * c.caps AS DOUBLE) / CAST(2 * rest AS DOUBLE)) END target FROM ranked, cut c)
"""

ORACLE["op2_mixing"] = f"""
WITH sized AS (SELECT doc_id, source, CAST(len({_WHITE_WORDS}) AS BIGINT) size,
  CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 8) AS BIGINT)
    / 4294967296.0::DOUBLE draw FROM documents), {_TARGETS}
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) taken
FROM (SELECT s.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
"""


def _span_digest(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """Counts of the base kinds, a hash of their spans, and all spans as text."""

    def text(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda x: x["kind"].isin(*kinds))

    own = of(*base)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(text(own), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


@_query
def op6_pii(spark, sf_dir):
    return _span_digest(pii.find_pii(_table(spark, sf_dir, "documents")), ("email", "ip", "card", "phone"))


@_query
def op9_secrets(spark, sf_dir):
    return _span_digest(secrets.find_secrets(_table(spark, sf_dir, "documents")), ("assign", "access", "hex"))


@_query
def op5_quality(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return quality.judge(documents, quality.train(documents, _table(spark, sf_dir, "labels")))


@_query
def op8_html(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return html.extract(pages, html.page_weights(pages))


@_query
def op3_line_dedup(spark, sf_dir):
    found = linededup.dedup_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_lines", "n_removed")


ORACLE["op3_line_dedup"] = """
WITH l AS (SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 k
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) i
    FROM documents) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
w AS (SELECT a.doc_id, a.k, row(a.line, b.line, c.line) w FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.k = a.k + 1
  JOIN l c ON a.doc_id = c.doc_id AND c.k = a.k + 2),
later AS (SELECT doc_id, k FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, k) n FROM w) WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(k, k + 3)) k FROM later),
every AS (SELECT doc_id, i, line, greatest(sum(CASE WHEN regexp_matches(line, '[^\\x20\\x09-\\x0D]') THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY i) - 1, 0) k
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) i
    FROM documents)),
n AS (SELECT doc_id, count(*) n FROM l GROUP BY 1), r AS (SELECT doc_id, count(*) n FROM covered GROUP BY 1),
t AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c IS NULL) text
  FROM (SELECT e.*, c.k c FROM every e LEFT JOIN covered c ON e.doc_id = c.doc_id AND e.k = c.k) GROUP BY 1)
SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END text,
  CAST(coalesce(n.n, 0) AS BIGINT) n_lines, CAST(coalesce(r.n, 0) AS BIGINT) n_removed
FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id)
"""


@_query
def op7_licenses(spark, sf_dir):
    found = licenses.find_licenses(_table(spark, sf_dir, "documents"))

    def text(x):
        return F.concat_ws(":", x["license"], F.round(x["coverage"], 4), x["start"], x["end"])

    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.transform("matches", text), ",").alias("spans"),
    )


@_query
def op4_jaccard(spark, sf_dir):
    return jaccard.similar(_table(spark, sf_dir, "documents"))


ORACLE["op4_jaccard"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY 1),
l AS (SELECT x.doc_id a, y.doc_id b FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 90 * (nx.n + ny.n - count(*))),
c AS (SELECT doc_id, doc_id r FROM d UNION SELECT c.doc_id, l.b FROM c JOIN l ON c.r = l.a)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) n_shingles, min(c.r) component_id
FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id) GROUP BY ALL
"""


@_query
def op10_lm_score(spark, sf_dir):
    return lmscore.score(_table(spark, sf_dir, "documents"))


@_query
def op11_quality_mil(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return mil.classify(documents, mil.train(documents, _table(spark, sf_dir, "labels")))


@_query
def op12_divergence(spark, sf_dir):
    return divergence.audit(_table(spark, sf_dir, "documents"))


def _f_sql(p: str, q: str) -> str:
    return f"({p} - {q}) * ({p} - {q}) // {q}"


ORACLE["op12_divergence"] = f"""
WITH d AS (SELECT row_number() OVER () i, coalesce(lang, '') lang, coalesce(source, '') source,
  regexp_extract_all({_LOWER}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') w FROM documents),
o AS (SELECT lang, source, i, t, count(*) n FROM (SELECT lang, source, i, unnest(w) t FROM d) GROUP BY ALL),
k AS (SELECT lang, t, CAST(sum(n) AS HUGEINT) all_n FROM o GROUP BY 1, 2 HAVING count(*) >= 3),
c AS (SELECT lang, source, t, CAST(sum(n) AS HUGEINT) n FROM o JOIN k USING (lang, t) GROUP BY 1, 2, 3),
v AS (SELECT lang, count(*) v, sum(all_n) all_total FROM k GROUP BY 1),
g AS (SELECT lang, source, CAST(coalesce(total, 0) AS HUGEINT) total FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) total FROM c GROUP BY 1, 2) USING (lang, source)),
p AS (SELECT g.lang, g.source, k.t, coalesce(n, 0) n, 1 + 1000000000 * (coalesce(n, 0) + 1) // (total + v) p,
    1 + 1000000000 * (all_n + 1) // (all_total + v) q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t),
s AS (SELECT x.lang, x.source, y.source item, sum({_f_sql("x.p", "y.p")}) f
  FROM p x JOIN p y ON x.lang = y.lang AND x.t = y.t AND x.source <> y.source GROUP BY 1, 2, 3),
r AS (SELECT a.lang, a.source, 'pair' part, b.source item, CAST(coalesce(f, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', t, CAST({_f_sql("p", "q")} AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) rank FROM r)
WHERE part = 'pair' OR rank <= 200
"""


@_query
def op13_collocations(spark, sf_dir):
    return collocations.collocations(_table(spark, sf_dir, "documents"))


ORACLE["op13_collocations"] = f"""
WITH p AS (SELECT lang, i, regexp_extract_all(piece, '[^\\x20\\x09]+') w FROM (SELECT coalesce(lang, 'und') lang,
    row_number() OVER () i, unnest(regexp_extract_all({_LOWER}, '[^.,;:!?\\x0A-\\x0D]+')) piece FROM documents)),
t AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) n FROM p GROUP BY 1),
g AS (SELECT lang, phrase, m, CAST(count(*) AS HUGEINT) a FROM (SELECT lang, m, array_to_string(w[j : j + m - 1], ' ') phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) j FROM p, (SELECT unnest(range(1, 6)) m) WHERE len(w) >= m))
  GROUP BY 1, 2, 3 HAVING count(*) >= 100),
s AS (SELECT lang, phrase, m, a, string_split(phrase, ' ') w FROM g WHERE m > 1),
inner_parts AS (SELECT lang, a, array_to_string(w[j : j + k - 1], ' ') phrase FROM (SELECT lang, w, a, k,
  unnest(range(1, m - k + 2)) j FROM s, (SELECT unnest(range(2, 5)) k) WHERE k < m)),
kept AS (SELECT s.* FROM s LEFT JOIN (SELECT lang, phrase, max(a) b FROM inner_parts GROUP BY 1, 2) x USING (lang, phrase)
  WHERE b IS NULL OR 100 * b < 100 * s.a),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') x, array_to_string(w[k + 1 : m], ' ') y
  FROM (SELECT *, unnest(range(1, m)) k FROM kept)),
scored AS (SELECT c.lang, c.phrase, c.a, k, x.a l, y.a r, n, 1000 * c.a * n // (x.a * y.a) score FROM cuts c
  JOIN g x ON x.lang = c.lang AND x.phrase = c.x JOIN g y ON y.lang = c.lang AND y.phrase = c.y JOIN t ON t.lang = c.lang),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) o FROM scored) WHERE o = 1)
SELECT lang, CAST(rank AS BIGINT) rank, phrase, CAST(a AS BIGINT) a, CAST(l AS BIGINT) l, CAST(r AS BIGINT) r,
  CAST(n AS BIGINT) n, CAST(score AS BIGINT) score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) rank FROM best) WHERE rank <= 2000
"""
