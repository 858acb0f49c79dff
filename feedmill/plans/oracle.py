"""The same queries in ANSI SQL, from the source columns of the sample tables."""

from __future__ import annotations

# --- shared table expressions ---------------------------------------------

_EVENTS = """
events_read AS (
  SELECT event_id AS e, event_type, ts, user_id,
         CASE WHEN event_id % 101 = 0 THEN 100000000000 ELSE 1000000 END + user_id AS uid_number,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         CAST(floor(value * 100) AS BIGINT) AS watched
  FROM events
)"""

_BEHAVIOUR = (
    _EVENTS
    + """,
behaviour AS (
  SELECT CAST(uid_number AS VARCHAR) AS uid,
         CASE event_type WHEN 'view' THEN 'play' WHEN 'click' THEN 'attitude'
                         WHEN 'purchase' THEN 'repost' WHEN 'signup' THEN 'comment'
                         ELSE event_type END AS action,
         CAST(2000000 + k AS VARCHAR) AS mid,
         watched,
         CASE WHEN k = 7 THEN 0 ELSE 10000 + 100 * k END AS full_length,
         CASE WHEN e % 11 = 0 THEN NULL ELSE e % 3 END AS idx,
         e % 83 = 0 AS spoilt
  FROM events_read
),
members AS (SELECT * FROM behaviour WHERE length(uid) <= 11),
counts AS (
  SELECT mid,
         count(*) FILTER (WHERE action = 'repost') AS repost,
         count(*) FILTER (WHERE action = 'comment') AS comment,
         count(*) FILTER (WHERE action = 'attitude') AS attitude,
         count(*) FILTER (WHERE action = 'play') AS play
  FROM members GROUP BY mid
)"""
)


def _good(skip: int, pool_end: int, top: int) -> str:
    return f"""
pool AS (
  SELECT mid, round((log2(comment + 1) + log2(repost + 1) + log2(attitude + 1)) * log2(play + 1), 9) AS score
  FROM (SELECT *, row_number() OVER (ORDER BY play DESC, mid) - 1 AS place FROM counts) AS ranked
  WHERE place >= {skip} AND place < {pool_end}
),
good AS (SELECT mid, score FROM pool ORDER BY score DESC, mid LIMIT {top})"""


_SCORES = (
    _BEHAVIOUR
    + ","
    + _good(5, 100, 95)
    + """,
signals AS (
  SELECT uid, mid,
         CASE WHEN action = 'play' AND spoilt THEN 'rejected'
              WHEN action = 'play' AND watched >= 3000 AND idx = 0 THEN 'diversion'
              WHEN action = 'play' AND watched >= 3000 THEN 'play'
              WHEN action IN ('repost', 'comment', 'attitude') THEN action
              ELSE 'touch' END AS signal,
         CASE WHEN full_length = 0 THEN CAST('infinity' AS DOUBLE)
              ELSE CAST(watched AS DOUBLE) / full_length END AS rate
  FROM members WHERE mid IN (SELECT mid FROM good)
),
vectors AS (
  SELECT uid, mid,
         count(DISTINCT CASE WHEN signal = 'diversion' THEN rate END) AS nd,
         least(coalesce(max(CASE WHEN signal = 'diversion' THEN rate END), 0.0), 1.0) AS md,
         count(DISTINCT CASE WHEN signal = 'play' THEN rate END) AS np,
         least(coalesce(max(CASE WHEN signal = 'play' THEN rate END), 0.0), 1.0) AS mp,
         max(CASE WHEN signal = 'comment' THEN 1 ELSE 0 END) AS c,
         max(CASE WHEN signal = 'attitude' THEN 1 ELSE 0 END) AS a,
         max(CASE WHEN signal = 'repost' THEN 1 ELSE 0 END) AS r
  FROM signals WHERE signal <> 'rejected' GROUP BY uid, mid
),
all_scores AS (
  SELECT uid, mid, count(*) OVER (PARTITION BY uid) AS items,
         nd * md * 2.0
         + CASE WHEN md > 0.8 AND nd = 2 THEN 5.0 WHEN md > 0.8 AND nd > 2 THEN 16.0 ELSE 0.0 END
         + np * mp
         + CASE WHEN mp > 0.8 AND np = 2 THEN 5.0 WHEN mp > 0.8 AND np > 2 THEN 16.0 ELSE 0.0 END
         + c * 4.0 + a * 16.0 + r * 20.0 AS score
  FROM vectors
),
scores AS (SELECT uid, mid, CAST(score AS DOUBLE) AS score FROM all_scores
           WHERE items BETWEEN 45 AND 2000 AND score <> 0)"""
)


def _ids(pairs: str) -> str:
    """``real_ids`` and ``ids`` over a (uid, mid) table expression."""
    return f"""
real_ids AS (
  SELECT 'uid' AS kind, uid AS real_id FROM {pairs} UNION SELECT 'mid', mid FROM {pairs}
),
bucketed AS (
  SELECT kind, real_id,
         CASE WHEN right(real_id, 4) LIKE '0%' THEN '1' || right(real_id, 3)
              ELSE right(real_id, 4) END AS bucket
  FROM real_ids
),
ids AS (
  SELECT real_id, kind,
         CAST(bucket || CAST(row_number() OVER (PARTITION BY kind, bucket ORDER BY real_id) - 1 AS VARCHAR)
              AS BIGINT) AS num_id
  FROM bucketed
)"""


_PURCHASES = """
purchases AS (
  SELECT CAST(1000000 + o_custkey * 7919 AS VARCHAR) AS uid,
         CAST(20000000 + l_partkey * 104729 AS VARCHAR) AS mid
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_RATINGS = (
    _SCORES
    + ","
    + _ids("scores")
    + """,
ratings AS (
  SELECT CAST(u.num_id AS INTEGER) AS "user", CAST(m.num_id AS INTEGER) AS item,
         round(s.score, 2) AS rating
  FROM scores s JOIN ids u ON u.kind = 'uid' AND u.real_id = s.uid
                JOIN ids m ON m.kind = 'mid' AND m.real_id = s.mid
)"""
)

_VECTORS = """
vectors AS (
  SELECT vec_id AS id, CAST(label AS BIGINT) AS cluster, CAST(embedding AS DOUBLE[]) AS features
  FROM embeddings
)"""

_SHARDS = """
shards AS (
  SELECT vec_id AS id,
         CAST(CAST('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 AS INTEGER) AS shard
  FROM embeddings
)"""

_TOP_K = (
    _VECTORS
    + """,
top_k AS (
  SELECT "user", pos, item, score FROM (
    SELECT "user", item, score,
           row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) - 1 AS pos
    FROM (SELECT u.id AS "user", i.id AS item, list_dot_product(u.features, i.features) AS score
          FROM vectors u CROSS JOIN vectors i) AS scored
  ) AS ranked WHERE pos < 10
)"""
)

_ROUTES = (
    _VECTORS
    + """,
long_form AS (
  SELECT cluster, unnest(range(1, len(features) + 1)) AS dim, unnest(features) AS value FROM vectors
),
means AS (SELECT cluster, dim, avg(value) AS value FROM long_form GROUP BY cluster, dim),
big AS (SELECT cluster FROM vectors GROUP BY cluster HAVING count(*) > 2),
products AS (
  SELECT u.cluster AS user_cluster, i.cluster AS item_cluster,
         CAST(trunc(sum(u.value * i.value)) AS BIGINT) AS product
  FROM means u JOIN means i ON u.dim = i.dim
  WHERE i.cluster IN (SELECT cluster FROM big)
  GROUP BY u.cluster, i.cluster
),
routes AS (
  SELECT user_cluster, item_cluster, pos FROM (
    SELECT *, row_number() OVER (PARTITION BY user_cluster ORDER BY product DESC, item_cluster) - 1 AS pos
    FROM products
  ) AS ranked WHERE pos < 3
)"""
)

_HISTORY = """
history AS (
  SELECT CAST(o_custkey AS VARCHAR) AS uid, CAST(l_partkey AS VARCHAR) AS mid,
         CAST(o_orderdate AS DATE) AS dt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_CANDIDATES = """
candidates AS (
  SELECT CAST(c_custkey AS VARCHAR) AS uid, p AS pos,
         CAST((c_custkey * 31 + (p % 45) * 37) % (SELECT count(*) FROM part) AS VARCHAR) AS mid
  FROM customer CROSS JOIN range(50) AS positions(p)
)"""

_ENRICHED = (
    _CANDIDATES
    + """,
enriched AS (
  SELECT owner, pos, uid, id, oid FROM (
    SELECT c.uid AS owner, row_number() OVER (PARTITION BY c.uid ORDER BY c.pos) - 1 AS pos,
           CAST(p_partkey % 100 AS VARCHAR) AS uid, c.mid AS id, '1034:' || c.mid AS oid
    FROM candidates c JOIN part ON c.mid = CAST(p_partkey AS VARCHAR)
    WHERE p_size > 5
  ) AS ranked WHERE pos < 30
)"""
)

_STATE = """
base AS (
  SELECT CAST(c_custkey AS VARCHAR) AS uid,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'base-' || c_custkey END AS list,
         CAST(1 + c_custkey % 30 AS INTEGER) AS ttl
  FROM customer
),
fresh AS (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS uid,
         CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE 'new-' || o_custkey END AS list
  FROM orders WHERE o_custkey % 4 <> 0
),
merged AS (
  SELECT coalesce(f.uid, b.uid) AS uid, f.list AS new_list, b.list AS base_list, b.ttl - 1 AS left_days
  FROM fresh f FULL JOIN base b ON f.uid = b.uid
)"""

_KEYED = """
keyed AS (
  SELECT c_custkey AS key FROM customer WHERE c_custkey % 41 <> 0 AND c_custkey % 37 <> 0
)"""

_LOG = (
    _EVENTS
    + """,
log AS (
  SELECT e, ts, CAST(uid_number AS VARCHAR) AS uid, watched,
         event_type <> 'error' AS is_play,
         e % 3 AS uicode_digit,
         (e // 3) % 3 AS client_digit,
         (e // 9) % 13 AS idx,
         (e // 117) % 4 AS page,
         e % 89 = 0 AS two_pages,
         (e // 9) % 4 < 3 AND (e // 36) % 2 = 0 AS from_find,
         e % 13 = 0 AS scene,
         CASE WHEN e % 17 <> 0 THEN CAST(4001 + k % 3 AS VARCHAR) END AS code,
         CAST(k % 10 AS VARCHAR) AS authorid,
         CASE WHEN e % 97 <> 0 THEN CAST(2000000 + k AS VARCHAR) END AS mid
  FROM events_read
),
plays AS (SELECT * FROM log WHERE is_play),
member_plays AS (SELECT * FROM plays WHERE length(uid) <= 11)"""
)

_DIVERSIONS = (
    _LOG
    + """,
diversions AS (
  SELECT uid, mid FROM member_plays
  WHERE uicode_digit IN (0, 1) AND watched > 3000 AND NOT scene AND idx = 0 AND mid IS NOT NULL
)"""
)

_DEPTH = (
    _LOG
    + """,
depths AS (
  SELECT uid, substr(uid, length(uid) - 2, 2) AS tail, watched, client_digit,
         CASE client_digit WHEN 0 THEN page * 10 + idx WHEN 1 THEN (page - 1) * 10 + idx ELSE 0 END AS depth
  FROM member_plays WHERE uicode_digit = 2 AND NOT two_pages
)"""
)


def _depth_report(where: str) -> str:
    return f"""WITH {_DEPTH}
SELECT tail, least(depth, 11) AS depth,
       count(*) FILTER (WHERE watched > 3000) AS pv,
       count(DISTINCT CASE WHEN watched > 3000 THEN uid END) AS uv,
       CAST(coalesce(sum(watched) FILTER (WHERE watched > 3000), 0) AS BIGINT) AS duration,
       'largereal' AS class
FROM depths WHERE depth <> 0 AND {where} GROUP BY tail, least(depth, 11)
UNION ALL
SELECT tail, least(depth, 11), count(*), count(DISTINCT uid), CAST(sum(watched) AS BIGINT), 'lessall'
FROM depths WHERE depth <> 0 AND {where} GROUP BY tail, least(depth, 11)"""


def _tab_consumers(where: str) -> str:
    return f"""WITH {_LOG}
SELECT uid FROM member_plays
WHERE uicode_digit = 2 AND NOT two_pages AND watched >= 3000 AND {where}"""


def _export_plan(parts: int) -> str:
    return f"""WITH {_KEYED}
SELECT CAST(key % {parts} AS INTEGER) AS part, key,
       row_number() OVER (PARTITION BY key % {parts} ORDER BY key) - 1 AS position
FROM keyed"""


_SOURCES = (
    _LOG
    + """,
sources AS (
  SELECT substr(uid, length(uid) - 2, 2) AS tail,
         (page - 1) * 10 + idx AS idx,
         CASE WHEN (page - 1) * 10 + idx = 0 THEN '4000' ELSE code END AS code,
         CASE WHEN from_find AND (page - 1) * 10 + idx <> 0 THEN 'find' ELSE 'vvs' END AS source,
         watched > 3000 AS long
  FROM member_plays WHERE uicode_digit = 1 AND NOT two_pages
),
source_counts AS (
  SELECT tail, code, idx,
         count(*) FILTER (WHERE source = 'vvs' AND NOT long) AS vvs_less3,
         count(*) FILTER (WHERE source = 'vvs' AND long) AS vvs_large3,
         count(*) FILTER (WHERE source = 'find' AND NOT long) AS find_less3,
         count(*) FILTER (WHERE source = 'find' AND long) AS find_large3
  FROM sources WHERE code IS NOT NULL GROUP BY tail, code, idx
)"""
)

# --- why records are left out ----------------------------------------------


def _by_cause(*cases: str) -> str:
    """(cause, n) over the log, by the first case that holds; each is ``condition name``."""
    whens = " ".join(f"WHEN {condition} THEN '{name}'" for condition, name in (c.rsplit(" ", 1) for c in cases))
    return f"WITH {_LOG} SELECT cause, count(*) AS n FROM (SELECT CASE {whens} ELSE 'kept' END AS cause FROM log) AS c GROUP BY cause"


_GUESTS = ("length(uid) > 11 guest", "NOT is_play other_action")
_PLACE = "(page - 1) * 10 + idx"

_CAUSES = {
    "find_users": _by_cause(
        *_GUESTS, "uicode_digit <> 1 other_page", "(e // 9) % 4 = 3 other_previous", "(e // 36) % 2 = 1 other_root",
        "two_pages two_pages", "watched < 3000 short",
    ),
    "depth_report": _by_cause(
        *_GUESTS, "uicode_digit <> 2 other_page", "two_pages two_pages",
        f"client_digit = 2 OR CASE client_digit WHEN 0 THEN page * 10 + idx ELSE {_PLACE} END = 0 zero_depth",
    ),
    "source_report": _by_cause(
        *_GUESTS, "uicode_digit <> 1 other_page", "two_pages two_pages", f"{_PLACE} <> 0 AND code IS NULL no_code"
    ),
    "daily_consume": _by_cause(*_GUESTS, "uicode_digit <> 1 other_page", "mid IS NULL no_mid", "scene scene"),
    "tab_consumers": _by_cause(*_GUESTS, "uicode_digit <> 2 other_page", "two_pages two_pages", "watched < 3000 short"),
    "diversion_records": _by_cause(
        "NOT is_play other_action", "uicode_digit = 2 other_page", "length(uid) > 11 guest",
        "watched <= 3000 short_or_bad_duration", "scene scene", "idx >= 1 recommended", "mid IS NULL no_mid",
    ),
    "author_exposure": """
SELECT cause, count(*) AS n FROM (
  SELECT unnest(CASE WHEN left(o_orderpriority, 1) NOT IN ('1', '2') THEN ['other_type']
                     WHEN l_linenumber = 1 THEN ['kept', 'no_author'] ELSE ['kept', 'kept'] END) AS cause
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
) AS c GROUP BY cause""",
}

# --- one query per key -----------------------------------------------------

ORACLE: dict[str, str] = {
    "item_action_counts": f"WITH {_BEHAVIOUR} SELECT mid, repost, comment, attitude, play FROM counts",
    "behaviour_text_counts": f"WITH {_BEHAVIOUR} SELECT mid, repost, comment, attitude, play FROM counts",
    "require_rows": f"WITH {_BEHAVIOUR} SELECT mid, repost, comment, attitude, play FROM counts",
    "good_items": f"WITH {_BEHAVIOUR}, {_good(5, 80, 30)} SELECT mid, round(score, 6) + 0.0 AS score FROM good",
    "user_item_score": f"WITH {_SCORES} SELECT uid, mid, score FROM scores",
    "score_counters": f"""WITH {_SCORES}
SELECT count(*) AS lines,
       count(*) FILTER (WHERE signal = 'rejected') AS rejected_plays,
       count(*) FILTER (WHERE signal IN ('play', 'diversion')) AS scored_plays,
       count(*) FILTER (WHERE signal = 'touch') AS touches,
       count(*) FILTER (WHERE signal = 'repost') AS repost,
       count(*) FILTER (WHERE signal = 'comment') AS comment,
       count(*) FILTER (WHERE signal = 'attitude') AS attitude
FROM signals""",
    "assign_ids": f"WITH {_PURCHASES}, {_ids('purchases')} SELECT real_id, num_id, kind FROM ids",
    "assign_dense_ids": f"""WITH {_PURCHASES}, {_ids('purchases')}
SELECT real_id, row_number() OVER (PARTITION BY kind ORDER BY real_id) - 1 AS num_id, kind FROM real_ids""",
    "encode_ratings": f'WITH {_RATINGS} SELECT "user", item, rating FROM ratings',
    "lookup": f"WITH {_PURCHASES}, {_ids('purchases')} SELECT num_id, real_id FROM ids WHERE kind = 'mid'",
    "lookup_large": f"""WITH {_PURCHASES}, {_ids('purchases')}
SELECT num_id, real_id FROM purchases p JOIN ids i ON i.kind = 'mid' AND i.real_id = p.mid""",
    "top_k_exact": f"""WITH {_TOP_K}
SELECT "user", CAST(pos AS INTEGER) AS pos, item, round(score, 4) + 0.0 AS score FROM top_k""",
    "top_k_probed": f"""WITH {_ROUTES}
SELECT "user", CAST(pos AS INTEGER) AS pos, item, round(score, 4) + 0.0 AS score FROM (
  SELECT "user", item, score,
         row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) - 1 AS pos
  FROM (SELECT u.id AS "user", i.id AS item, list_dot_product(u.features, i.features) AS score
        FROM vectors u JOIN routes r ON r.user_cluster = u.cluster
                       JOIN vectors i ON i.cluster = r.item_cluster) AS scored
) AS ranked WHERE pos < 10""",
    "score_pairs": f"""WITH {_VECTORS}
SELECT u.id AS "user", i.id AS item, round(list_dot_product(u.features, i.features), 4) + 0.0 AS score
FROM vectors u JOIN vectors i ON i.id = (u.id * 7 + 3) % (SELECT count(*) FROM vectors)""",
    "squared_error": f"""WITH {_VECTORS}
SELECT count(*) AS pairs, round(avg((u.cluster - p.score) * (u.cluster - p.score)), 6) + 0.0 AS mse
FROM vectors u JOIN (
  SELECT u.id, list_dot_product(u.features, i.features) AS score
  FROM vectors u JOIN vectors i ON i.id = (u.id * 7 + 3) % (SELECT count(*) FROM vectors)
) AS p ON p.id = u.id""",
    "shard_factors": f"WITH {_SHARDS} SELECT id, shard FROM shards",
    "shard_files": f"WITH {_SHARDS} SELECT id, shard FROM shards",
    "cluster_routes": f"WITH {_ROUTES} SELECT user_cluster, item_cluster, CAST(pos AS INTEGER) AS pos FROM routes",
    "cluster_sizes": "SELECT label AS cluster, count(*) AS n FROM embeddings GROUP BY label HAVING count(*) > 2",
    "scored_list_lines": f"""WITH {_TOP_K}
SELECT CAST("user" AS VARCHAR) AS owner, CAST(pos AS INTEGER) AS pos, CAST(item AS VARCHAR) AS mid FROM top_k""",
    "decode_recommendations": f"""WITH {_TOP_K}
SELECT 'u' || "user" AS uid, CAST(pos AS INTEGER) AS pos, 'm' || item AS mid FROM top_k""",
    "decode_triples": f"""WITH {_TOP_K}
SELECT 'u' || "user" AS uid, 'm' || item AS mid, round(score, 4) + 0.0 AS score FROM top_k""",
    "list_rows": f"WITH {_CANDIDATES} SELECT uid, CAST(pos AS INTEGER) AS pos, mid FROM candidates",
    "candidate_lines": f"WITH {_CANDIDATES} SELECT uid, CAST(pos AS INTEGER) AS pos, mid FROM candidates",
    "last_days_window": f"""WITH {_HISTORY}
SELECT uid, mid, CAST(dt AS VARCHAR) AS dt FROM history WHERE dt BETWEEN DATE '2001-07-02' AND DATE '2001-07-31'""",
    "remove_seen": f"""WITH {_CANDIDATES}, {_HISTORY}
SELECT uid, CAST(row_number() OVER (PARTITION BY uid ORDER BY pos) - 1 AS INTEGER) AS pos, mid FROM (
  SELECT uid, mid, min(pos) AS pos FROM candidates c
  WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.uid = c.uid AND h.mid = c.mid)
  GROUP BY uid, mid
) AS kept""",
    "seen_counters": f"""WITH {_CANDIDATES}, {_HISTORY},
offered AS (SELECT DISTINCT uid, mid FROM candidates),
flagged AS (
  SELECT o.uid, h.uid IS NOT NULL AS seen
  FROM offered o LEFT JOIN (SELECT DISTINCT uid, mid FROM history) h ON h.uid = o.uid AND h.mid = o.mid
)
SELECT count(DISTINCT uid) AS users,
       count(*) FILTER (WHERE NOT seen) AS kept,
       count(*) FILTER (WHERE seen) AS removed,
       count(DISTINCT CASE WHEN NOT seen THEN uid END) AS users_left
FROM flagged""",
    "item_meta_day": """
SELECT CAST(p_partkey AS VARCHAR) AS mid, CAST(p_partkey % 100 AS VARCHAR) AS uid,
       '1034:' || p_partkey AS object_id
FROM part WHERE p_size > 5""",
    "enrich": f"""WITH {_ENRICHED}
SELECT owner, CAST(pos AS INTEGER) AS pos, uid, 'mid' AS type, id, oid FROM enriched""",
    "candidate_json": f"""WITH {_ENRICHED}
SELECT owner AS uid,
       '[' || string_agg('{{"uid":"' || uid || '","type":"mid","id":"' || id || '","oid":"' || oid || '"}}',
                         ',' ORDER BY pos) || ']' AS list
FROM enriched GROUP BY owner""",
    "merge_state": f"""WITH {_STATE}
SELECT uid, coalesce(new_list, base_list) AS list,
       CAST(CASE WHEN new_list IS NOT NULL THEN 30 ELSE left_days END AS INTEGER) AS ttl
FROM merged WHERE new_list IS NOT NULL OR (base_list IS NOT NULL AND left_days > 0)""",
    "merge_state_counters": f"""WITH {_STATE}
SELECT count(*) AS uid_num,
       count(*) FILTER (WHERE new_list IS NOT NULL AND base_list IS NULL) AS new_num,
       count(*) FILTER (WHERE new_list IS NOT NULL AND base_list IS NOT NULL) AS update_num,
       count(*) FILTER (WHERE new_list IS NULL AND base_list IS NOT NULL) AS decrease_num,
       count(*) FILTER (WHERE new_list IS NULL AND base_list IS NOT NULL AND left_days <= 0) AS remove_num,
       count(*) FILTER (WHERE new_list IS NULL AND base_list IS NOT NULL AND left_days IS NULL) AS bad_ttl_num
FROM merged""",
    "merge_state_rejects": f"""WITH {_STATE}
SELECT uid, base_list AS list FROM merged
WHERE new_list IS NULL AND base_list IS NOT NULL AND CAST(uid AS BIGINT) % 11 = 0""",
    "merge_state_spoilt_counters": f"""WITH {_STATE}, spoilt AS (
  SELECT new_list, base_list, CASE WHEN CAST(uid AS BIGINT) % 11 <> 0 THEN left_days END AS left_days FROM merged
)
SELECT count(*) AS uid_num,
       count(*) FILTER (WHERE new_list IS NOT NULL AND base_list IS NULL) AS new_num,
       count(*) FILTER (WHERE new_list IS NOT NULL AND base_list IS NOT NULL) AS update_num,
       count(*) FILTER (WHERE new_list IS NULL AND base_list IS NOT NULL) AS decrease_num,
       count(*) FILTER (WHERE new_list IS NULL AND base_list IS NOT NULL AND left_days <= 0) AS remove_num,
       count(*) FILTER (WHERE new_list IS NULL AND base_list IS NOT NULL AND left_days IS NULL) AS bad_ttl_num
FROM spoilt""",
    "id_rejects": """SELECT DISTINCT 'uid' AS kind, 'user' || o_custkey || 'x' AS real_id, 'not a number' AS cause
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 9 = 0
UNION ALL
SELECT DISTINCT 'mid', CAST(l_partkey AS VARCHAR), 'short' FROM lineitem WHERE l_partkey < 1000""",
    "export_kv_plan": _export_plan(8),
    "export_kv_files": f"""WITH {_KEYED}
SELECT CAST(key % 8 AS INTEGER) AS part, key, 'list-' || key AS payload FROM keyed""",
    "export_kv_plan_video": _export_plan(4),
    "diversion_records": f"WITH {_DIVERSIONS} SELECT uid, mid FROM diversions",
    "diversion_counts": f"WITH {_DIVERSIONS} SELECT mid, count(*) AS n FROM diversions GROUP BY mid",
    "diversion_events": f"""WITH {_LOG}
SELECT epoch_ms(date_trunc('second', ts)) AS time_ms, uid, authorid, mid FROM plays
WHERE uicode_digit IN (0, 1) AND watched > 3000 AND idx = 0 AND mid IS NOT NULL""",
    "daily_consume": f"""WITH {_LOG}
SELECT uid, count(*) AS n FROM member_plays
WHERE uicode_digit = 1 AND NOT scene AND mid IS NOT NULL GROUP BY uid""",
    "author_exposure": """
SELECT CAST(author AS VARCHAR) AS author, count(DISTINCT mid) AS n FROM (
  SELECT l_suppkey AS author, unnest(CASE WHEN l_linenumber = 1 THEN [l_partkey]
                                          ELSE [l_partkey, l_partkey + 1] END) AS mid
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%'
) AS shown GROUP BY author""",
    "tab_consumers": _tab_consumers("true"),
    "tab_consumers_ios": _tab_consumers("client_digit <> 0"),
    "tab_consumer_causes": f"""WITH {_LOG}
SELECT cause, count(*) AS n FROM (
  SELECT CASE WHEN length(uid) > 11 THEN 'guest'
              WHEN NOT is_play THEN 'other_action'
              WHEN uicode_digit <> 2 THEN 'other_page'
              WHEN two_pages THEN 'two_pages'
              WHEN watched < 3000 THEN 'short'
              ELSE 'kept' END AS cause
  FROM log
) AS causes GROUP BY cause""",
    "diversion_causes": f"""WITH {_LOG}
SELECT cause, count(*) AS n FROM (
  SELECT CASE WHEN NOT is_play THEN 'other_action'
              WHEN uicode_digit = 2 THEN 'other_page'
              WHEN length(uid) > 11 THEN 'guest'
              WHEN watched <= 3000 THEN 'short_or_bad_duration'
              WHEN scene THEN 'scene'
              WHEN idx >= 1 THEN 'recommended'
              WHEN mid IS NULL THEN 'no_mid'
              ELSE 'kept' END AS cause
  FROM log
) AS causes GROUP BY cause""",
    "depth_report": _depth_report("true"),
    "depth_report_ios": _depth_report("client_digit <> 0"),
    "find_users": f"""WITH {_LOG}
SELECT uid, CAST(watched AS INTEGER) AS duration FROM member_plays
WHERE uicode_digit = 1 AND from_find AND NOT two_pages AND watched >= 3000""",
    "source_report": f"""WITH {_SOURCES}
SELECT tail, code, idx AS "index", 'vvs' AS source, vvs_less3 AS less3, vvs_large3 AS large3 FROM source_counts
UNION ALL
SELECT tail, code, idx, 'find', find_less3, find_large3 FROM source_counts""",
    "id_difference": f"""WITH {_STATE}
SELECT uid AS id FROM base WHERE uid NOT IN (SELECT uid FROM fresh)""",
    "id_coverage": f"""WITH {_STATE}
SELECT (SELECT count(*) FROM base) AS n_a, (SELECT count(*) FROM fresh) AS n_b, n_both,
       CAST(n_both AS DOUBLE) / (SELECT count(*) FROM fresh) AS rate
FROM (SELECT count(*) AS n_both FROM base JOIN fresh ON base.uid = fresh.uid) AS pairs""",
}
ORACLE |= {
    "lookup_hot": f"""WITH {_PURCHASES}, {_ids('purchases')}
SELECT num_id, real_id FROM lineitem JOIN ids i ON i.kind = 'mid' AND i.real_id = CAST(20000000 + 104729 *
  CASE WHEN l_orderkey % 10 = 0 THEN l_partkey ELSE (SELECT min(l_partkey) FROM lineitem) END AS VARCHAR)""",
    "nameless_rows": f"""WITH {_STATE}
SELECT 'base' AS side, coalesce(list, '') AS list FROM base WHERE CAST(uid AS BIGINT) % 13 = 0""",
    "merge_state_nameless": f"""WITH {_STATE}, named AS (
  SELECT uid, new_list, CASE WHEN CAST(uid AS BIGINT) % 13 <> 0 THEN base_list END AS base_list, left_days FROM merged)
SELECT uid, coalesce(new_list, base_list) AS list,
       CAST(CASE WHEN new_list IS NOT NULL THEN 30 ELSE left_days END AS INTEGER) AS ttl
FROM named WHERE new_list IS NOT NULL OR (base_list IS NOT NULL AND left_days > 0)""",
    "find_users_causes": _CAUSES["find_users"],
    "depth_causes": _CAUSES["depth_report"],
    "source_causes": _CAUSES["source_report"],
    "daily_consume_causes": _CAUSES["daily_consume"],
    "exposure_causes": _CAUSES["author_exposure"],
    "report_run_counters": " UNION ALL ".join(
        f"SELECT '{name}' AS report, cause, n FROM ({sql}) AS x" for name, sql in _CAUSES.items()
    ),
}
ORACLE["top_k_blocks"] = ORACLE["top_k_exact"]
ORACLE["top_k_probed_blocks"] = ORACLE["top_k_probed"]
ORACLE["top_k_pruned"] = ORACLE["top_k_pruned_blocks"] = f"""WITH {_VECTORS}
SELECT "user", CAST(pos AS INTEGER) AS pos, item, round(score, 4) + 0.0 AS score FROM (
  SELECT "user", item, score,
         row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) - 1 AS pos
  FROM (SELECT u.id AS "user", i.id AS item, list_dot_product(u.features, i.features) AS score
        FROM vectors u CROSS JOIN (SELECT id, [x * (1.0::DOUBLE / (1 + id % 97)) for x in features] AS features
                                   FROM vectors) i) AS scored
) AS ranked WHERE pos < 10"""
ORACLE["probe_recall"] = f"""WITH {_ROUTES}, exact AS (
  SELECT "user", item FROM (
    SELECT u.id AS "user", i.id AS item,
           row_number() OVER (PARTITION BY u.id ORDER BY list_dot_product(u.features, i.features) DESC, i.id) AS pos
    FROM vectors u CROSS JOIN vectors i) AS ranked WHERE pos <= 10
),
probed AS (
  SELECT "user", item FROM (
    SELECT u.id AS "user", i.id AS item,
           row_number() OVER (PARTITION BY u.id ORDER BY list_dot_product(u.features, i.features) DESC, i.id) AS pos
    FROM vectors u JOIN routes r ON r.user_cluster = u.cluster JOIN vectors i ON i.cluster = r.item_cluster
  ) AS ranked WHERE pos <= 10
)
SELECT count(DISTINCT e."user") AS users, count(*) AS entries, count(p.item) AS hits,
       CAST(count(p.item) AS DOUBLE) / count(*) AS recall
FROM exact e LEFT JOIN probed p ON p."user" = e."user" AND p.item = e.item"""


# --- written and read back -------------------------------------------------

_HELD_OUT = f"""{_RATINGS},
drawn AS (SELECT *, CAST('0x' || substr(md5("user" || ':' || item || ':10'), 1, 8) AS BIGINT) % 1000000 < 800000 AS fitted FROM ratings),
held AS (
  SELECT count(*) AS pairs FROM drawn WHERE NOT fitted AND "user" IN (SELECT "user" FROM drawn WHERE fitted)
                                           AND item IN (SELECT item FROM drawn WHERE fitted)
)"""

ORACLE |= {
    "client_log_by_position": ORACLE["diversion_records"],
    "exposure_by_position": ORACLE["author_exposure"],
    "behaviour_of_two_paths": ORACLE["item_action_counts"],
    "id_text": f"WITH {_PURCHASES}, {_ids('purchases')} SELECT real_id, num_id, kind FROM ids",
    "state_text": """SELECT CAST(c_custkey AS VARCHAR) AS uid, CASE WHEN c_custkey % 7 <> 0 THEN 'base-' || c_custkey END AS list,
       CAST(CASE WHEN c_custkey % 11 = 0 THEN -1 ELSE 1 + c_custkey % 30 END AS INTEGER) AS ttl FROM customer""",
    "scored_list_text": f"""WITH {_TOP_K} SELECT "user", CAST(pos AS INTEGER) AS pos, item FROM top_k""",
    "factor_files": """
SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS width, CAST(embedding[1] AS DOUBLE) AS "first" FROM embeddings""",
    "replaced_day": f"""WITH {_STATE}
SELECT dt, uid, coalesce(list, '') AS list, ttl FROM base, (VALUES ('20240101'), ('20240103')) AS days(dt)
UNION ALL SELECT '20240102', uid, 'again', ttl FROM base WHERE ttl > 20""",
    "day_table": f"""WITH {_STATE}
SELECT CASE WHEN ttl <= 15 THEN '20240101' ELSE '20240102' END AS dt, uid, ttl FROM base
UNION ALL SELECT '20240103', uid, ttl FROM base""",
    "months_by_glob": f"""WITH {_HISTORY}
SELECT uid, mid, CAST(dt AS VARCHAR) AS dt FROM history WHERE dt BETWEEN DATE '2001-05-01' AND DATE '2001-07-31'""",
    "model_files": f"""WITH {_RATINGS}
SELECT 'userFactors' AS kind, count(DISTINCT "user") AS vectors, true AS equal FROM ratings
UNION ALL SELECT 'itemFactors', count(DISTINCT item), true FROM ratings""",
    "export_kv_order": f"""WITH {_KEYED}
SELECT CAST(key % 8 AS INTEGER) AS part, count(*) AS keys, min(key) AS smallest, max(key) AS largest,
       true AS ascending, true AS apart FROM keyed GROUP BY key % 8""",
    "candidate_json_rows": f"""WITH {_ENRICHED}
SELECT owner, CAST(pos AS INTEGER) AS pos, uid, 'mid' AS type, id, oid FROM enriched WHERE CAST(owner AS BIGINT) % 13 <> 0""",
    "candidate_json_rejects": f"""WITH {_ENRICHED}
SELECT DISTINCT owner AS uid, CAST(20 AS INTEGER) AS characters FROM enriched WHERE CAST(owner AS BIGINT) % 13 = 0""",
    "evaluate_pairs": f"""WITH {_HELD_OUT}
SELECT CAST(8 AS INTEGER) AS rank, CAST(0.04 AS DOUBLE) AS reg, CAST(3 AS INTEGER) AS iterations, pairs FROM held""",
    "grid_pairs": f"""WITH {_HELD_OUT}
SELECT CAST(r AS INTEGER) AS rank, CAST(0.04 AS DOUBLE) AS reg, CAST(i AS INTEGER) AS iterations, pairs
FROM held, (VALUES (4), (8)) AS ranks(r), (VALUES (2), (3)) AS steps(i)""",
    "shard_kmeans_checks": """
SELECT count(*) AS vectors, count(DISTINCT vec_id) AS ids, CAST(10 AS BIGINT) AS leaves, true AS falling FROM embeddings""",
}

ORACLE |= {
    "train_checks": f"""WITH {_RATINGS}
SELECT 'user' AS kind, count(DISTINCT "user") AS vectors, CAST(8 AS INTEGER) AS shortest, CAST(8 AS INTEGER) AS longest,
       true AS not_negative FROM ratings
UNION ALL SELECT 'item', count(DISTINCT item), 8, 8, true FROM ratings""",
    "recommend_checks": f"""WITH {_RATINGS}
SELECT DISTINCT CAST("user" AS BIGINT) AS "user", least(10, (SELECT count(DISTINCT item) FROM ratings)) AS items,
       true AS falling, true AS as_sparks FROM ratings""",
    # The lists hold every item that anybody has a score for, less what the user has touched in any way.
    "daily_state_sets": f"""WITH {_SCORES.replace("BETWEEN 45 AND", "BETWEEN 10 AND")},
touched AS (SELECT DISTINCT uid, mid FROM behaviour),
lists AS (
  SELECT u.uid, count(*) AS entries FROM (SELECT DISTINCT uid FROM scores) u CROSS JOIN (SELECT DISTINCT mid FROM scores) i
  WHERE NOT EXISTS (SELECT 1 FROM touched t WHERE t.uid = u.uid AND t.mid = i.mid) GROUP BY u.uid
),
base AS (SELECT DISTINCT CAST(1000000 + user_id AS VARCHAR) AS uid, CAST(user_id % 3 AS INTEGER) AS left_days FROM events WHERE user_id % 2 = 0)
SELECT coalesce(l.uid, b.uid) AS uid, CAST(CASE WHEN l.uid IS NULL THEN left_days ELSE 30 END AS INTEGER) AS ttl,
       l.uid IS NOT NULL AS fresh, CAST(coalesce(entries, 0) AS INTEGER) AS entries
FROM lists l FULL JOIN base b ON l.uid = b.uid WHERE l.uid IS NOT NULL OR left_days > 0""",
}
