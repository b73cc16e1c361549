"""DuckDB oracles for the registered queries (views: the driver tables).

``ev`` is the readings stand-in (batch key = hour of ts, source = event
type); ``obs`` is the first reading per (batch, source) by (ts, event_id).
Doubles are rounded where Spark and DuckDB may differ in the last bit, and
-0.0 is normalised by adding 0.0.
"""

from __future__ import annotations

from obslake.plans.standins import EVENT_SOURCES

EV = """ev AS (
  SELECT event_id, ts, user_id, event_type AS city, value, props,
         strftime(ts, '%Y-%m-%d_%H00') AS date
  FROM events
)"""
OBS = """obs AS (
  SELECT event_id, ts, user_id, city, value, props, date FROM (
    SELECT *, row_number() OVER (PARTITION BY date, city ORDER BY ts, event_id) AS rn FROM ev
  ) WHERE rn = 1
)"""
CLEAN = """clean AS (
  SELECT * FROM obs WHERE date IN (SELECT date FROM obs GROUP BY date HAVING count(*) = 5)
)"""
LI_IDX = """li_idx AS (
  SELECT l_returnflag,
         CAST(row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS DOUBLE) AS label_index
  FROM lineitem GROUP BY l_returnflag
)"""
LI_SCORED = """li_scored AS (
  SELECT l.*, i.label_index,
         CASE WHEN l_quantity <= 17 THEN 0.0 WHEN l_quantity <= 34 THEN 1.0 ELSE 2.0 END::DOUBLE
           AS prediction
  FROM lineitem l JOIN li_idx i USING (l_returnflag)
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


OBS_COLS = "date, city, event_id, value"
# SET-1: one read per source, all sources, unioned.
_PER_SOURCE_UNION = " UNION ALL ".join(
    f"SELECT {OBS_COLS} FROM obs WHERE city = '{c}'" for c in EVENT_SOURCES)
HASH_BUCKET = ("(('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 8))"
               "::BIGINT % 100)")
LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "interval"]


def _feature_stats(digits: int = 6) -> str:
    parts = []
    for f in LI_FEATURES:
        expr = "3600.0" if f == "interval" else f
        parts.append(f"SELECT '{f}' AS feature, round(avg({expr}), {digits}) + 0.0 AS mean, "
                     f"round(stddev_samp({expr}), {digits}) + 0.0 AS std FROM lineitem")
    return "\nUNION ALL\n".join(parts)


def _gini(*counts: str) -> str:
    total = " + ".join(counts)
    return f"(({total}) - ({' + '.join(f'({c}) * ({c})' for c in counts)}) / ({total}))"


def _best_split(rows: str, group: str) -> str:
    """Per ``group``: the (feature, threshold) of least weighted Gini impurity
    among the midpoints of neighbouring values in the whole table."""
    unpivot = " UNION ALL ".join(
        f"SELECT {group}, '{f}' AS feature, {i} AS fi, {f} AS x, label_index FROM {rows}"
        for i, f in enumerate(TREE_FEATURES))
    kinds = range(3)
    left = [f"sum(CASE WHEN x <= t AND label_index = {k} THEN n ELSE 0 END)::DOUBLE AS l{k}" for k in kinds]
    right = [f"sum(CASE WHEN x > t AND label_index = {k} THEN n ELSE 0 END)::DOUBLE AS r{k}" for k in kinds]
    return f"""SELECT {group}, arg_min({{'feature': feature, 't': t}}, {_gini('l0', 'l1', 'l2')} + {_gini('r0', 'r1', 'r2')}) AS s
  FROM (SELECT {group}, feature, fi, t, {', '.join(left + right)}
        FROM (SELECT {group}, feature, fi, x, label_index, count(*) AS n FROM ({unpivot}) GROUP BY ALL)
        JOIN cuts USING (feature) GROUP BY {group}, feature, fi, t)
  WHERE l0 + l1 + l2 > 0 AND r0 + r1 + r2 > 0 GROUP BY {group}"""


TREE_FEATURES = ["l_quantity", "l_discount", "l_tax"]
_SIDE = "CASE s.feature " + " ".join(f"WHEN '{f}' THEN {f}" for f in TREE_FEATURES) + " END <= s.t"
# A decision tree of two levels, grown in SQL.
TREE = f"""WITH banded AS (
  SELECT l_quantity, l_discount, l_tax, 0 AS node,
         CASE WHEN l_quantity * (1 - 4 * l_discount) < 12 THEN 'low'
              WHEN l_quantity * (1 - 4 * l_discount) < 24 THEN 'mid' ELSE 'high' END AS band FROM lineitem
),
idx AS (SELECT band, CAST(row_number() OVER (ORDER BY count(*) DESC, band) - 1 AS DOUBLE) AS label_index
        FROM banded GROUP BY band),
root AS (SELECT * FROM banded JOIN idx USING (band)),
cuts AS ({" UNION ALL ".join(
    f"SELECT '{f}' AS feature, (x + lead(x) OVER (ORDER BY x)) / 2 AS t FROM (SELECT DISTINCT {f} AS x FROM lineitem) "
    "QUALIFY t IS NOT NULL" for f in TREE_FEATURES)}),
first AS ({_best_split('root', 'node')}),
halves AS (SELECT root.* EXCLUDE (node), CASE WHEN {_SIDE} THEN 1 ELSE 2 END AS node FROM root JOIN first USING (node)),
second AS ({_best_split('halves', 'node')}),
leaves AS (SELECT halves.* EXCLUDE (node), 2 * node + CASE WHEN {_SIDE} THEN 0 ELSE 1 END AS node
           FROM halves JOIN second USING (node)),
said AS (SELECT node, arg_max(label_index, n) AS prediction
         FROM (SELECT node, label_index, count(*) AS n FROM leaves GROUP BY ALL) GROUP BY node)
SELECT l_quantity, l_discount, l_tax, band, label_index, prediction, count(*) AS n, 0::BIGINT AS n_other
FROM leaves JOIN said USING (node) GROUP BY ALL"""


def _scaled() -> str:
    cols = []
    for f in LI_FEATURES:
        if f == "interval":
            cols.append("0.0::DOUBLE AS z_interval")
            continue
        cols.append(
            f"round(({f} - avg({f}) OVER ()) / stddev_samp({f}) OVER (), 6) + 0.0 AS z_{f}")
    return "SELECT l_orderkey, l_linenumber, " + ", ".join(cols) + " FROM lineitem"


REPORT_RULE = """scored AS (
  SELECT o.*, i.city_index,
         CAST(least(floor(o.value / 100), 4) AS DOUBLE) AS prediction
  FROM obs o JOIN (
    SELECT city, CAST(row_number() OVER (ORDER BY count(*) DESC, city) - 1 AS DOUBLE) AS city_index
    FROM obs GROUP BY city) i USING (city)
)"""

ORACLE_SQL: dict[str, str] = {
    "lake_scan": _with(EV) + "SELECT event_id, date, city, value FROM ev",
    "batch_scan": _with(EV) + "SELECT event_id, date, city, value FROM ev "
                              "WHERE date = (SELECT max(date) FROM ev)",
    "provenance_city": _with(EV) + "SELECT city, count(*) AS n FROM ev GROUP BY city",
    "decode_payload": (
        "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, "
        "CASE WHEN json_extract_string(props, '$.k') IS NULL THEN 1 ELSE 0 END AS rejected "
        "FROM events"),
    "flatten": _with(EV) + (
        "SELECT strftime(ts, '%Y-%m-%dT%H:%M') AS time, event_id, user_id, value, props, "
        "date, city FROM ev"),
    "select_attr_preview": (
        "SELECT event_id, value, event_type FROM events ORDER BY event_id LIMIT 60"),
    "batch_counts": _with(EV, OBS) + "SELECT date, count(*) AS n FROM obs GROUP BY date",
    "city_counts": _with(EV) + "SELECT city, count(*) AS n FROM ev GROUP BY city",
    "total_rows": "SELECT count(*) AS n_rows FROM events",
    "complete_batches": _with(EV, OBS) + "SELECT date FROM obs GROUP BY date HAVING count(*) = 5",
    "complete_batches_strict": _with(EV) + (
        "SELECT date FROM ev GROUP BY date HAVING count(DISTINCT city) = 5"),
    "complete_batches_incremental": _with(EV) + (
        "SELECT date FROM ev GROUP BY date HAVING count(DISTINCT city) = 5"),
    "incomplete_batches": _with(EV, OBS) + (
        "SELECT date, count(*) AS n FROM obs GROUP BY date HAVING count(*) < 5"),
    "clean_rows": _with(EV, OBS, CLEAN) + f"SELECT {OBS_COLS} FROM clean",
    "clean_rows_inner": _with(EV, OBS, CLEAN) + f"SELECT {OBS_COLS} FROM clean",
    "clean_city_counts": _with(EV, OBS, CLEAN) + "SELECT city, count(*) AS n FROM clean GROUP BY city",
    "drop_null_rows": _with(EV, OBS) + """SELECT * FROM (
  SELECT date,
    max(CASE WHEN city = 'click' THEN value END) AS click,
    max(CASE WHEN city = 'error' THEN value END) AS error,
    max(CASE WHEN city = 'purchase' THEN value END) AS purchase,
    max(CASE WHEN city = 'signup' THEN value END) AS signup,
    max(CASE WHEN city = 'view' THEN value END) AS "view"
  FROM obs GROUP BY date)
WHERE click IS NOT NULL AND error IS NOT NULL AND purchase IS NOT NULL
  AND signup IS NOT NULL AND "view" IS NOT NULL""",
    "exclude_batches": _with(EV, OBS) + (
        f"SELECT {OBS_COLS} FROM obs WHERE date NOT IN ('2024-01-01_0000', '2024-01-15_1200')"),
    "eq_filter": _with(EV, OBS) + "SELECT date, event_id, value FROM obs WHERE city = 'view'",
    "insert_new": _with(EV, OBS, """prior AS (
  SELECT date, city, event_id, value FROM (
    SELECT *, row_number() OVER (PARTITION BY date, city ORDER BY ts DESC, event_id DESC) AS rn
    FROM ev WHERE date < '2024-01-16_0000') WHERE rn = 1
)""") + f"""SELECT {OBS_COLS} FROM prior
UNION ALL
SELECT {OBS_COLS} FROM obs o
WHERE NOT EXISTS (SELECT 1 FROM prior p WHERE p.date = o.date AND p.city = o.city)""",
    "lake_load": _with(EV, OBS) + f"SELECT {OBS_COLS} FROM obs",
    "compacted_table": _with(EV, OBS) + (
        f"SELECT {OBS_COLS}, CASE WHEN date < '2024-01-25' THEN true END AS few_files FROM obs"),
    "approximate_users": ("SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT user_id) AS n_users "
                          "FROM events GROUP BY 1"),
    "payload_rescue": """SELECT event_id,
  CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(props->>'k' AS BIGINT) END AS k,
  CASE event_type WHEN 'error' THEN '{"k":"' || (props->>'k') || '"}'
    WHEN 'purchase' THEN '{"buyer":{"id":' || user_id || ',"tags":["new",1]}}' END AS rescued
FROM events""",
    "payload_fields": """SELECT pair[1] AS path, pair[2] AS kind, count(*) AS n FROM (
  SELECT unnest(CASE event_type
    WHEN 'error' THEN [['$', 'OBJECT'], ['$.k', 'STRING']]
    WHEN 'signup' THEN [['$', 'OBJECT'], ['$.k', 'VOID']]
    WHEN 'purchase' THEN [['$', 'OBJECT'], ['$.k', 'BIGINT'], ['$.buyer', 'OBJECT'], ['$.buyer.id', 'BIGINT'],
      ['$.buyer.tags', 'ARRAY'], ['$.buyer.tags[*]', 'STRING'], ['$.buyer.tags[*]', 'BIGINT']]
    ELSE [['$', 'OBJECT'], ['$.k', 'BIGINT']] END) AS pair FROM events
) GROUP BY 1, 2""",
    "hash_split": (
        f"SELECT CASE WHEN {HASH_BUCKET} < 80 THEN 'train' ELSE 'test' END AS split, "
        "count(*) AS n FROM lineitem GROUP BY 1"),
    "random_split": "SELECT count(*) AS n_total FROM lineitem",
    "exact_split": f"""SELECT l_orderkey, l_linenumber,
  CASE WHEN row_number() OVER (ORDER BY ('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 15))::BIGINT)
       <= floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split FROM lineitem""",
    "union_cities": _with(EV, OBS) + _PER_SOURCE_UNION,
    "pct_text": _with(EV, OBS, CLEAN) + """SELECT b.city,
  printf('%.2f%%', CAST(coalesce(a.n_clean, 0) AS DOUBLE) / b.n_obs * 100) AS share
FROM (SELECT city, count(*) AS n_obs FROM obs GROUP BY city) b
LEFT JOIN (SELECT city, count(*) AS n_clean FROM clean GROUP BY city) a USING (city)""",
    "batch_key": ("SELECT event_id, strftime(ts, '%Y-%m-%d_%H00') AS batch, "
                  "strftime(ts, '%Y-%m-%d') AS day FROM events"),
    "object_key": _with(EV, OBS) + (
        "SELECT date, city, 'data/weather/date=' || date || '/' || city || '/' || city || '_' "
        "|| date || '.json' AS object_key FROM obs"),
    "json_doc": ("SELECT event_id, '{\"event_id\":' || event_id || ',\"city\":\"' || event_type "
                 "|| '\"}' AS doc FROM events"),
    "city_map": _with(EV, OBS) + (
        "SELECT date, string_agg(city || '=' || printf('%.2f', value), ',' ORDER BY city) "
        "AS city_values FROM obs GROUP BY date"),
    "point_lookup": _with(EV) + "SELECT city, arg_min(value, event_id) AS value FROM ev GROUP BY city",
    "label_index": _with(LI_IDX) + "SELECT l_returnflag, label_index FROM li_idx",
    "label_ranks": ("SELECT l_partkey::VARCHAR AS part, CAST(row_number() OVER ("
                    "ORDER BY count(*) DESC, l_partkey::VARCHAR) - 1 AS DOUBLE) AS label_index "
                    "FROM lineitem GROUP BY l_partkey"),
    "feature_stats": _feature_stats(),
    "feature_stats_incremental": _feature_stats(8),
    "tree_predictions": TREE,
    "scaled_features": _scaled(),
    "confusion": _with(LI_IDX, LI_SCORED) + (
        "SELECT label_index, prediction, count(*) AS n FROM li_scored GROUP BY 1, 2"),
    "accuracy_by_batch": _with(LI_IDX, LI_SCORED) + (
        "SELECT CAST(year(l_shipdate) AS INTEGER) AS year, "
        "round(avg(CASE WHEN label_index = prediction THEN 1.0 ELSE 0.0 END::DOUBLE), 6) + 0.0 "
        "AS accuracy FROM li_scored GROUP BY 1"),
    "precision_by_label": _with(LI_IDX, LI_SCORED) + """SELECT l.label_index,
  round(coalesce(CAST(p.tp AS DOUBLE) / p.predicted, 0.0), 6) + 0.0 AS precision
FROM (SELECT label_index FROM li_scored UNION SELECT prediction FROM li_scored) l
LEFT JOIN (
  SELECT prediction AS label_index, count(*) AS predicted,
         sum(CASE WHEN label_index = prediction THEN 1 ELSE 0 END) AS tp
  FROM li_scored GROUP BY prediction) p USING (label_index)""",
    "batch_report": _with(EV, OBS, REPORT_RULE) + """SELECT date AS datetime,
  'PipelineModel' AS model_type, 'rule:value-band' AS model_location,
  printf('%.2f%%', avg(CASE WHEN prediction = city_index THEN 1.0 ELSE 0.0 END::DOUBLE) * 100)
    AS accuracy,
  printf('%.2f%%', CASE WHEN sum(CASE WHEN prediction = 0 THEN 1 ELSE 0 END) = 0 THEN 0.0
    ELSE CAST(sum(CASE WHEN prediction = 0 AND city_index = 0 THEN 1 ELSE 0 END) AS DOUBLE)
         / sum(CASE WHEN prediction = 0 THEN 1 ELSE 0 END) END * 100) AS precision,
  string_agg(city || '=' || printf('%.1f', city_index), ',' ORDER BY city) AS city_indexes,
  string_agg(city || '=' || printf('%.1f', prediction), ',' ORDER BY city) AS city_guesses,
  any_value(pl.precision_by_label) AS precision_by_label
FROM scored JOIN (
  SELECT date, string_agg(k || '=' || printf('%.4f', prec), ',' ORDER BY k) AS precision_by_label
  FROM (
    SELECT date, CAST(CAST(v AS INTEGER) AS VARCHAR) AS k,
           CASE WHEN sum(p) = 0 THEN 0.0 ELSE sum(t)::DOUBLE / sum(p) END AS prec
    FROM (SELECT date, city_index AS v, 0 AS p, 0 AS t FROM scored
          UNION ALL
          SELECT date, prediction AS v, 1 AS p, CASE WHEN prediction = city_index THEN 1 ELSE 0 END
          FROM scored)
    GROUP BY date, v)
  GROUP BY date) pl USING (date)
GROUP BY date""",
    "model_roundtrip": "SELECT CAST(0 AS BIGINT) AS n_diff",
    "model_metadata": _with(EV, OBS, CLEAN) + (
        "SELECT 'value,k,user_id,interval' AS input_columns, 'None' AS training_split_used, "
        "count(*) AS training_entries_count, CAST(NULL AS VARCHAR) AS paramGridBuilderValues "
        "FROM clean"),
    "train_job": _with(EV, OBS, CLEAN) + (
        "SELECT 'value,k,user_id,interval' AS input_columns, 'None' AS training_split_used, "
        "count(*) AS training_entries_count, CAST(NULL AS VARCHAR) AS paramGridBuilderValues "
        "FROM clean"),
    "score_job": _with(EV, OBS, CLEAN, """idx AS (
  SELECT city, CAST(row_number() OVER (ORDER BY count(*) DESC, city) - 1 AS DOUBLE) AS city_index
  FROM clean GROUP BY city
)""") + """SELECT date AS datetime, 'PipelineModel' AS model_type,
  string_agg(city || '=' || printf('%.1f', city_index), ',' ORDER BY city) AS city_indexes
FROM (SELECT DISTINCT date, city FROM ev) e JOIN idx USING (city) GROUP BY date""",
    # Labels of a model: the readings before its day, most frequent first.
    "score_as_of": _with(EV, OBS, """models(model_day) AS (VALUES ('2024-01-10'), ('2024-01-20'))""",
                         """idx AS (
  SELECT model_day, city, row_number() OVER (PARTITION BY model_day ORDER BY count(*) DESC, city) - 1 AS i
  FROM obs JOIN models ON date < model_day GROUP BY model_day, city
)""", """dated AS (
  SELECT obs.*, (SELECT max(model_day) FROM models WHERE model_day <= left(date, 10)) AS model_day FROM obs
)""") + """SELECT date, dated.model_day, count(*) AS n,
  count(dated.model_day) AS n_scored,
  string_agg(city || coalesce('=' || printf('%.1f', i::DOUBLE), ''), ',' ORDER BY city) AS indexes
FROM dated LEFT JOIN idx USING (model_day, city) GROUP BY date, dated.model_day""",
    "stream_reports": _with(EV, OBS, CLEAN, """idx AS (
  SELECT city, CAST(row_number() OVER (ORDER BY count(*) DESC, city) - 1 AS DOUBLE) AS city_index
  FROM clean GROUP BY city
)""") + """SELECT date AS datetime, 'PipelineModel' AS model_type,
  string_agg(city || '=' || printf('%.1f', city_index), ',' ORDER BY city) AS city_indexes
FROM clean JOIN idx USING (city) GROUP BY date""",
    "union_positional": _with(EV, OBS) + _PER_SOURCE_UNION,
    "stream_ingest": _with(EV, OBS) + f"SELECT {OBS_COLS} FROM obs",
    "stream_dedupe": _with(EV) + "SELECT DISTINCT date, city FROM ev",
    # Emitted keys: hours whose end is at or before the final watermark
    # (latest event time, in milliseconds, minus the 2-hour delay).
    "stream_first_wins": _with(EV, OBS) + (
        f"SELECT {OBS_COLS} FROM obs "
        "WHERE strptime(date, '%Y-%m-%d_%H%M') + INTERVAL 1 HOUR <= "
        "(SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 2 HOUR"),
    "stream_first_seen": _with(EV, OBS) + f"SELECT {OBS_COLS} FROM obs",
    "stream_score": "SELECT count(*) AS n_scored FROM events",
    "stream_completeness": _with(EV) + (
        "SELECT date AS batch, count(DISTINCT city) AS n_sources FROM ev GROUP BY date"),
}
