"""SQL for DuckDB that defines what each registered query must return.

Written from the definitions, not from the Spark plans: rounds of the iterative
jobs are unrolled into common table expressions.
"""

from __future__ import annotations

TARGET = "8"
BLOCK_USERS = 20
INDEX_USERS = 100_000
KMEANS_ROUNDS = 20
MANY_CENTERS = 50
WALK_ROUNDS = 20
STOP_TOL = 0.01

EVENTS_LOG = """
log AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         json_extract_string(props, '$.k') AS item_id,
         CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS VARCHAR) AS category_id,
         CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'fav'
                         WHEN 'signup' THEN 'cart' WHEN 'purchase' THEN 'buy' END AS behavior,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts
  FROM events
  WHERE event_type IN ('view', 'click', 'signup', 'purchase')
)"""

PURCHASE_LOG = """
log AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(l_partkey AS VARCHAR) AS item_id,
         CAST(l_suppkey AS VARCHAR) AS category_id,
         CASE WHEN l_returnflag = 'R' THEN 'pv' WHEN l_returnflag = 'A' THEN 'fav'
              WHEN l_linenumber = 1 THEN 'cart' ELSE 'buy' END AS behavior,
         CAST(floor(epoch(o_orderdate)) AS BIGINT) AS ts
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
)"""

KEYLESS_LOG = EVENTS_LOG.replace(
    "FROM events", "FROM (SELECT * REPLACE (if(event_id % 7 = 0, '{}', props) AS props) FROM events)"
)
MIXED_LOG = f"""{EVENTS_LOG.replace("log AS", "plain_log AS")},
log AS (
  SELECT * REPLACE (CASE CAST(item_id AS BIGINT) % 3 WHEN 0 THEN 'x' || item_id
                         WHEN 1 THEN '0' || item_id ELSE item_id END AS item_id)
  FROM plain_log
)"""
PARTED_LOG = f"""{EVENTS_LOG.replace("log AS", "plain_log AS")},
log AS (
  SELECT * REPLACE (CAST(2 * CAST(item_id AS BIGINT) + CAST(user_id AS BIGINT) % 2 AS VARCHAR)
                    AS item_id)
  FROM plain_log
)"""
CATALOGUE_PAIRS = """
pairs AS (
  SELECT 'all' AS user_id, CAST(p_partkey AS VARCHAR) AS item_id FROM part
  UNION
  SELECT 'c' || c_custkey, CAST(c_custkey AS VARCHAR) FROM customer
)"""
CROWDED_PAIRS = f"""{CATALOGUE_PAIRS.replace("pairs AS", "catalogue_pairs AS")},
pairs AS (
  SELECT * FROM catalogue_pairs
  UNION
  SELECT 'large' || u, CAST(p_partkey AS VARCHAR) FROM part, range(24) AS users(u)
  WHERE u < 12 OR p_partkey % (u - 10) <> 0
)"""

EVENT_LINES = r"""
fields AS (
  SELECT event_id % 20 AS damage,
         CAST(user_id AS VARCHAR) AS u,
         json_extract_string(props, '$.k') AS i,
         CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS VARCHAR) AS c,
         CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'fav'
                         WHEN 'signup' THEN 'cart' WHEN 'purchase' THEN 'buy'
                         ELSE event_type END AS b,
         CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS t
  FROM events
),
lines AS (
  SELECT CASE damage
    WHEN 1 THEN ' ' || concat_ws(' ,' || chr(9), u, i, c, b, t) || chr(9) || ' '
    WHEN 2 THEN ''
    WHEN 3 THEN ' ' || chr(9) || ' '
    WHEN 4 THEN 'user_id,item_id,category_id,behavior_type,timestamp'
    WHEN 5 THEN 'USER_ID,' || concat_ws(',', u, i, c, b, t)
    WHEN 6 THEN 'user_id' || concat_ws(',', u, i, c, b, t)
    WHEN 7 THEN concat_ws(',', u, i, c, b)
    WHEN 8 THEN concat_ws(',', u, i, c, b, t, 'extra')
    WHEN 9 THEN concat_ws(',', u, i, c, b, t) || ','
    WHEN 10 THEN concat_ws(',', u, ' ', c, b, t)
    WHEN 11 THEN concat_ws(',', u, i, c, upper(b), t)
    WHEN 12 THEN concat_ws(',', u, i, c, 'click', t)
    WHEN 13 THEN concat_ws(',', u, i, c, b, 'abc')
    WHEN 14 THEN concat_ws(',', u, i, c, b, '5.7')
    WHEN 15 THEN concat_ws(',', u, i, c, b, '1e3')
    WHEN 16 THEN concat_ws(',', u, i, c, b, '99999999999999999999')
    WHEN 17 THEN concat_ws(',', u, i, c, b, '+' || t)
    WHEN 18 THEN concat_ws(',', u, i, c, b, '-' || t)
    ELSE concat_ws(',', u, i, c, b, t) END AS value
  FROM fields
)"""


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def _judged(fold_case: bool = False) -> str:
    behavior = f"lower({_strip('p[4]')})" if fold_case else _strip("p[4]")
    return rf"""{EVENT_LINES},
parts AS (
  SELECT {_strip("value")} AS line, string_split({_strip("value")}, ',') AS p FROM lines
),
judged AS (
  SELECT line, {_strip("p[1]")} AS user_id, {_strip("p[2]")} AS item_id,
         {_strip("p[3]")} AS category_id, {behavior} AS behavior,
         CASE WHEN regexp_full_match({_strip("p[5]")}, '[+-]?[0-9]+')
              THEN TRY_CAST({_strip("p[5]")} AS BIGINT) END AS ts,
         CASE WHEN line = '' THEN 'empty line'
              WHEN starts_with(lower(line), 'user_id') THEN 'header'
              WHEN len(p) < 5 THEN 'too few fields'
              WHEN {" OR ".join(f"{_strip(f'p[{i}]')} = ''" for i in range(1, 6))} THEN 'blank field'
              WHEN {behavior} NOT IN ('pv', 'cart', 'fav', 'buy') THEN 'unknown behavior'
              WHEN NOT regexp_full_match({_strip("p[5]")}, '[+-]?[0-9]+')
                   OR TRY_CAST({_strip("p[5]")} AS BIGINT) IS NULL THEN 'bad timestamp'
              ELSE 'kept' END AS verdict
  FROM parts
)"""


PAIRS = """
pairs AS (
  SELECT DISTINCT user_id, item_id FROM log WHERE behavior IN ('cart', 'fav', 'buy')
)"""

STATS = """
stats AS (
  SELECT user_id, max(ts) AS last_ts, count(*) AS event_count,
         CAST(sum(CASE behavior WHEN 'buy' THEN 4 WHEN 'cart' THEN 3
                                WHEN 'fav' THEN 2 ELSE 1 END) AS BIGINT) AS score
  FROM log GROUP BY user_id
)"""

RAW = """
raw AS (
  SELECT user_id, ((SELECT max(ts) FROM log) - last_ts) / 86400.0::DOUBLE AS f1,
         CAST(event_count AS DOUBLE) AS f2, CAST(score AS DOUBLE) AS f3
  FROM stats
)"""

EXTREMA = """
extrema AS (
  SELECT min(f1) AS min_f1, max(f1) AS max_f1, min(f2) AS min_f2,
         max(f2) AS max_f2, min(f3) AS min_f3, max(f3) AS max_f3
  FROM raw
)"""


def _scaled(c: str) -> str:
    return (
        f"round(CASE WHEN max_{c} > min_{c} THEN ({c} - min_{c}) / (max_{c} - min_{c}) "
        f"ELSE 0.0 END, 4)::DOUBLE AS {c}"
    )


FEATURES = f"""
features AS MATERIALIZED (
  SELECT user_id, {_scaled("f1")}, {_scaled("f2")}, {_scaled("f3")} FROM raw, extrema
)"""

COARSE = """
features AS MATERIALIZED (
  SELECT user_id, round(f1) AS f1, round(f2) AS f2, round(f3) AS f3 FROM fine_features
)"""

GRAPH = """
nodes AS MATERIALIZED (
  SELECT 'user' AS kind, user_id AS id, count(*) AS degree FROM pairs GROUP BY user_id
  UNION ALL
  SELECT 'item', item_id, count(*) FROM pairs GROUP BY item_id
),
edges AS MATERIALIZED (
  SELECT 'user' AS src_kind, user_id AS src, 'item' AS dst_kind, item_id AS dst,
         1.0::DOUBLE / degree AS p
  FROM pairs JOIN nodes ON kind = 'user' AND id = user_id
  UNION ALL
  SELECT 'item', item_id, 'user', user_id, 1.0::DOUBLE / degree
  FROM pairs JOIN nodes ON kind = 'item' AND id = item_id
)"""


def _id_order(c: str) -> str:
    n = f"TRY_CAST({c} AS BIGINT)"
    return f"({n} IS NULL), coalesce({n}, 0), {c}"


def _before(a: str, b: str) -> str:
    def key(c: str) -> str:
        n = f"TRY_CAST({c} AS BIGINT)"
        return f"row(({n} IS NULL), coalesce({n}, 0), {c})"

    return f"{key(a)} < {key(b)}"


CO_OCCURRENCE = f"""
counted AS (
  SELECT a.item_id AS item_a, b.item_id AS item_b, count(*) AS cnt
  FROM pairs a JOIN pairs b ON a.user_id = b.user_id AND {_before("a.item_id", "b.item_id")}
  GROUP BY 1, 2
),
ranked AS (
  SELECT * FROM counted
  ORDER BY cnt DESC, {_id_order("item_a")}, {_id_order("item_b")} LIMIT 1000
)"""

def _index(block_users: int) -> str:
    return f"""
ranked_users AS (
  SELECT item_id, user_id,
         (row_number() OVER (PARTITION BY item_id ORDER BY {_id_order("user_id")}) - 1)
           // {block_users} AS block
  FROM pairs
),
index AS (
  SELECT item_id, CAST(block AS BIGINT) AS block,
         string_agg(user_id, ',' ORDER BY {_id_order("user_id")}) AS users
  FROM ranked_users GROUP BY ALL
)"""


def _kmeans(k: int = 3, rounds: int = KMEANS_ROUNDS) -> str:
    parts = [
        f"""
drawn AS (
  SELECT * FROM features ORDER BY md5('2026:' || user_id), user_id LIMIT {k}
),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY md5('2026:' || user_id), user_id) - 1 AS INTEGER)
           AS cluster, f1 AS c1, f2 AS c2, f3 AS c3
  FROM drawn
)"""
    ]
    for i in range(rounds):
        parts.append(f"""
{_labels(f"l{i}", f"c{i}")},
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.c1, c.c1) AS c1, coalesce(m.c2, c.c2) AS c2,
         coalesce(m.c3, c.c3) AS c3
  FROM c{i} c LEFT JOIN (
    SELECT cluster, avg(f1) AS c1, avg(f2) AS c2, avg(f3) AS c3 FROM l{i} GROUP BY cluster
  ) m ON m.cluster = c.cluster
)""")
    parts.append(_labels("labels", f"c{rounds}"))
    return ",".join(parts)


def _labels(name: str, centers: str) -> str:
    distance = "sqrt((f1 - c1) * (f1 - c1) + (f2 - c2) * (f2 - c2) + (f3 - c3) * (f3 - c3))"
    return f"""{name} AS (
  SELECT user_id, f1, f2, f3, cluster FROM (
    SELECT f.*, c.cluster,
           row_number() OVER (PARTITION BY user_id ORDER BY {distance}, c.cluster) AS nearest
    FROM features f, {centers} c
  ) WHERE nearest = 1
)"""


def _walk() -> str:
    parts = [
        f"""
r0 AS (SELECT 'user' AS kind, '{TARGET}' AS id, 1.0::DOUBLE AS score)"""
    ]
    for i in range(WALK_ROUNDS):
        parts.append(f"""
r{i + 1} AS MATERIALIZED (
  SELECT kind, id, sum(score) AS score FROM (
    SELECT dst_kind AS kind, dst AS id, 0.85::DOUBLE * score * p AS score
    FROM r{i} JOIN edges ON src_kind = kind AND src = id
    UNION ALL
    SELECT 'user', '{TARGET}', 1.0::DOUBLE - 0.85::DOUBLE
  ) GROUP BY kind, id
)""")
    parts.append(f"""
ranks AS (SELECT * FROM r{WALK_ROUNDS}),
best AS (
  SELECT CAST(row_number() OVER (ORDER BY round(score, 12) DESC, {_id_order("id")}) AS INTEGER)
           AS rank, id AS item_id, score
  FROM ranks
  WHERE kind = 'item'
    AND NOT EXISTS (SELECT 1 FROM pairs WHERE user_id = '{TARGET}' AND item_id = id)
  QUALIFY rank <= 10
)""")
    return ",".join(parts)


def _stopped(tol: float) -> str:
    """The ranks of the first round in which none moved by more than ``tol``."""
    shifts = "\nUNION ALL\n".join(
        f"""SELECT {i + 1} AS round, max(abs(coalesce(n.score, 0) - coalesce(o.score, 0))) AS shift
FROM r{i + 1} n FULL JOIN r{i} o ON n.kind = o.kind AND n.id = o.id"""
        for i in range(WALK_ROUNDS)
    )
    every = "\nUNION ALL\n".join(
        f"SELECT {i + 1} AS round, * FROM r{i + 1}" for i in range(WALK_ROUNDS)
    )
    return f"""
shifts AS ({shifts}),
last_round AS (
  SELECT coalesce(min(round) FILTER (shift <= {tol}), {WALK_ROUNDS}) AS last FROM shifts
),
stopped AS (SELECT kind, id, score FROM ({every}) JOIN last_round ON round = last)"""


def _on_log(log: str) -> dict[str, str]:
    def ask(select: str, *parts: str) -> str:
        return f"WITH {','.join([log, *parts])}\n{select}"

    kmeans = (STATS, RAW, EXTREMA, FEATURES, _kmeans())
    walk = (PAIRS, GRAPH, _walk())
    return {
        "global_max_ts": ask("SELECT max(ts) AS max_ts FROM log"),
        "user_stats": ask("SELECT * FROM stats", STATS),
        "user_features_raw": ask("SELECT * FROM raw", STATS, RAW),
        "feature_extrema": ask("SELECT * FROM extrema", STATS, RAW, EXTREMA),
        "user_features": ask("SELECT * FROM features", STATS, RAW, EXTREMA, FEATURES),
        "log_row_counts": ask(
            """SELECT 'records' AS metric, count(*) AS row_count FROM log
UNION ALL SELECT 'users', count(DISTINCT user_id) FROM log
UNION ALL SELECT 'pairs', count(*) FROM pairs
UNION ALL SELECT 'edges', count(*) FROM edges
UNION ALL SELECT 'nodes', count(*) FROM nodes""",
            PAIRS,
            GRAPH,
        ),
        "deep_pairs": ask("SELECT * FROM pairs", PAIRS),
        "item_user_index": ask("SELECT * FROM index", PAIRS, _index(INDEX_USERS)),
        "item_user_index_blocks": ask("SELECT * FROM index", PAIRS, _index(BLOCK_USERS)),
        "item_co_occurrence_top1000": ask("SELECT * FROM ranked", PAIRS, CO_OCCURRENCE),
        "item_co_occurrence_large_users": ask("SELECT * FROM ranked", PAIRS, CO_OCCURRENCE),
        "graph_nodes": ask("SELECT * FROM nodes", PAIRS, GRAPH),
        "graph_edges": ask("SELECT * FROM edges", PAIRS, GRAPH),
        "kmeans_init": ask("SELECT * FROM drawn", *kmeans),
        "kmeans_labels": ask("SELECT user_id, cluster FROM labels", *kmeans),
        "kmeans_centers": ask(
            "SELECT cluster, round(c1, 4) AS c1, round(c2, 4) AS c2, round(c3, 4) AS c3 "
            f"FROM c{KMEANS_ROUNDS}",
            *kmeans,
        ),
        "personal_rank_scores": ask(
            "SELECT kind, id, round(score, 9) AS score FROM ranks", *walk
        ),
        "personal_rank_bucketed": ask(
            "SELECT kind, id, round(score, 9) AS score FROM ranks", *walk
        ),
        "personal_rank_dense": ask(
            "SELECT nodes.kind, nodes.id, round(coalesce(score, 0.0), 9) AS score "
            "FROM nodes LEFT JOIN ranks ON ranks.kind = nodes.kind AND ranks.id = nodes.id",
            *walk,
        ),
        "personal_rank_top10": ask(
            "SELECT rank, item_id, round(score, 9) AS score FROM best", *walk
        ),
    }


def _special() -> dict[str, str]:
    """Logs and limits that make rare cases happen."""

    def ask(select: str, *parts: str) -> str:
        return f"WITH {','.join(parts)}\n{select}"

    mixed, parted = _on_log(MIXED_LOG), _on_log(PARTED_LOG)
    fine = (STATS, RAW, EXTREMA, FEATURES.replace("features AS", "fine_features AS"))
    verdict = """SELECT CASE WHEN user_id IS NULL THEN 'no user_id' WHEN item_id IS NULL
THEN 'no item_id' WHEN category_id IS NULL THEN 'no category_id' ELSE 'kept' END AS verdict,
count(*) AS line_count FROM log GROUP BY 1"""
    with_ids = """
known AS (SELECT * FROM log WHERE user_id IS NOT NULL AND item_id IS NOT NULL)"""
    return {
        "mixed_item_user_index_blocks": mixed["item_user_index_blocks"],
        "mixed_item_co_occurrence_top1000": mixed["item_co_occurrence_top1000"],
        "item_user_index_of_parts": mixed["item_user_index"],
        "item_user_index_blocks_of_parts": mixed["item_user_index_blocks"],
        "mixed_personal_rank_top10": mixed["personal_rank_top10"],
        "parted_personal_rank_dense": parted["personal_rank_dense"],
        "stopped_personal_rank_scores": ask(
            "SELECT kind, id, round(score, 9) AS score FROM stopped",
            EVENTS_LOG, PAIRS, GRAPH, _walk(), _stopped(STOP_TOL),
        ),
        "coarse_kmeans_labels": ask(
            "SELECT user_id, cluster FROM labels", EVENTS_LOG, *fine, COARSE, _kmeans()
        ),
        "coarse_kmeans_centers": ask(
            "SELECT cluster, round(c1, 4) AS c1, round(c2, 4) AS c2, round(c3, 4) AS c3 "
            f"FROM c{KMEANS_ROUNDS}", EVENTS_LOG, *fine, COARSE, _kmeans()
        ),
        "catalogue_item_co_occurrence": ask("SELECT * FROM ranked", CATALOGUE_PAIRS, CO_OCCURRENCE),
        "crowded_item_co_occurrence": ask("SELECT * FROM ranked", CROWDED_PAIRS, CO_OCCURRENCE),
        "keyless_record_verdicts": ask(verdict, KEYLESS_LOG),
        "keyless_deep_pairs": ask(
            "SELECT DISTINCT user_id, item_id FROM known WHERE behavior IN ('cart', 'fav', 'buy')",
            KEYLESS_LOG, with_ids,
        ),
    }


def oracle_sql() -> dict[str, str]:
    kept = (
        "SELECT user_id, item_id, category_id, behavior, ts FROM judged WHERE verdict = 'kept'"
    )
    events = EVENTS_LOG
    features = f"{events},{STATS},{RAW},{EXTREMA},{FEATURES}"
    damaged = r"""
whole AS (
  SELECT CAST(user_id AS BIGINT) % 9 AS damage, user_id AS u, printf('%.4f', f1) AS a,
         printf('%.4f', f2) AS b, printf('%.4f', f3) AS c
  FROM features
),
text AS (
  SELECT CASE damage
    WHEN 1 THEN ' ' || concat_ws(' ,' || chr(9), u, a, b, c)
    WHEN 2 THEN 'user_id,' || concat_ws(',', u, a, b, c)
    WHEN 3 THEN concat_ws(',', u, a, b)
    WHEN 4 THEN concat_ws(',', u, a, 'abc', c)
    WHEN 5 THEN concat_ws(',', ' ', a, b, c)
    WHEN 6 THEN concat_ws(',', u, a, b, 'NaN')
    WHEN 7 THEN concat_ws(',', u, a, b, c, 'extra')
    ELSE concat_ws(',', u, a, b, c) END AS value
  FROM whole
)"""
    feature_parts = f"""
parts AS (
  SELECT {_strip("value")} AS line, string_split({_strip("value")}, ',') AS p FROM text
),
parsed AS (
  SELECT {_strip("p[1]")} AS user_id, TRY_CAST({_strip("p[2]")} AS DOUBLE) AS f1,
         TRY_CAST({_strip("p[3]")} AS DOUBLE) AS f2, TRY_CAST({_strip("p[4]")} AS DOUBLE) AS f3
  FROM parts WHERE line <> '' AND NOT starts_with(line, 'user_id,') AND len(p) >= 4
)"""
    purchases = {f"purchase_{name}": sql for name, sql in _on_log(PURCHASE_LOG).items()}
    return {
        "clean_behavior_log": f"WITH {_judged()}\n{kept}",
        "text_round_trip": f"WITH {_judged()}\n{kept}",
        "clean_behavior_log_fold_case": f"WITH {_judged(fold_case=True)}\n{kept}",
        "clean_verdicts": (
            f"WITH {_judged()}\nSELECT verdict, count(*) AS line_count FROM judged GROUP BY verdict"
        ),
        **_on_log(events),
        "feature_file": (
            f"WITH {features},{damaged},{feature_parts}\nSELECT * FROM parsed "
            "WHERE user_id <> '' AND isfinite(f1) AND isfinite(f2) AND isfinite(f3)"
        ),
        "export_log": (
            f"WITH {events}\nSELECT concat_ws(',', user_id, item_id, category_id, behavior, ts) "
            "AS value FROM log"
        ),
        "export_features": (
            f"WITH {features}\nSELECT printf('%s,%.4f,%.4f,%.4f', user_id, f1, f2, f3) AS value "
            "FROM features"
        ),
        "export_index": (
            f"WITH {events},{PAIRS},{_index(INDEX_USERS)}\n"
            "SELECT item_id || chr(9) || block || chr(9) || users AS value FROM index"
        ),
        "export_co_occurrence": (
            f"WITH {events},{PAIRS},{CO_OCCURRENCE}\n"
            "SELECT item_a || ',' || item_b || chr(9) || cnt AS value FROM ranked"
        ),
        "export_labels": (
            f"WITH {features},{_kmeans()}\nSELECT user_id || ',' || cluster AS value FROM labels"
        ),
        "export_centers": (
            f"WITH {features},{_kmeans()}\n"
            "SELECT cluster || chr(9) || printf('%.4f,%.4f,%.4f', c1, c2, c3) AS value "
            f"FROM c{KMEANS_ROUNDS}"
        ),
        "export_recommendation": (
            f"WITH {events},{PAIRS},{GRAPH},{_walk()}\n"
            f"SELECT '{TARGET}' || chr(9) || "
            "coalesce(string_agg(item_id || ':' || printf('%.3f', score), ',' ORDER BY rank), '') "
            "AS value FROM best"
        ),
        "feature_verdicts": f"""WITH {features},{damaged},
parts AS (
  SELECT {_strip("value")} AS line, string_split({_strip("value")}, ',') AS p FROM text
)
SELECT CASE WHEN line = '' THEN 'empty line' WHEN starts_with(line, 'user_id,') THEN 'header'
            WHEN len(p) < 4 THEN 'too few fields' WHEN {_strip("p[1]")} = '' THEN 'blank user'
            WHEN coalesce(isfinite(TRY_CAST({_strip("p[2]")} AS DOUBLE)), false)
             AND coalesce(isfinite(TRY_CAST({_strip("p[3]")} AS DOUBLE)), false)
             AND coalesce(isfinite(TRY_CAST({_strip("p[4]")} AS DOUBLE)), false) THEN 'kept'
            ELSE 'not a finite number' END AS verdict, count(*) AS line_count
FROM parts GROUP BY 1""",
        "feature_row_verdicts": (
            f"WITH {features}\nSELECT CASE WHEN f1 + f2 + f3 > 2 THEN 'not a finite number' "
            "ELSE 'kept' END AS verdict, count(*) AS line_count FROM features GROUP BY 1"
        ),
        **_special(),
        **{f"{name}_of_parts": _on_log(events)[name] for name in ("personal_rank_scores", "personal_rank_top10")},
        "clean_rejects": (
            f"WITH {_judged()}\nSELECT line, verdict AS reason FROM judged WHERE verdict <> 'kept'"
        ),
        "clean_kept_beside_rejects": f"WITH {_judged()}\n{kept}",
        "user_features_of_parts": f"WITH {features}\nSELECT * FROM features",
        "many_kmeans_labels": (
            f"WITH {PURCHASE_LOG},{STATS},{RAW},{EXTREMA},{FEATURES},{_kmeans(MANY_CENTERS, 5)}\nSELECT user_id, cluster FROM labels"
        ),
        "ordered_index_export": (
            f"WITH {MIXED_LOG},{PAIRS},{_index(BLOCK_USERS)}\n"
            "SELECT row_number() OVER (ORDER BY item_id, block) - 1 AS position, "
            "item_id || chr(9) || block || chr(9) || users AS value FROM index"
        ),
        "ordered_label_export": (
            f"WITH {features},{_kmeans()}\n"
            "SELECT row_number() OVER (ORDER BY user_id) - 1 AS position, "
            "user_id || ',' || cluster AS value FROM labels"
        ),
        **purchases,
    }
