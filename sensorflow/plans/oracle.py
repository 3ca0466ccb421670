"""DuckDB spellings of every deterministic query (independent oracle).

Written directly against the base tables; the derived views are repeated
as CTEs so each string runs on its own.
"""

from __future__ import annotations

from sensorflow.plans import params as P

SENSOR = ("sensor AS (SELECT event_id AS seq, 's' || CAST(user_id AS VARCHAR) AS id, "
          "event_type AS kind, CAST(floor(epoch(ts)) AS BIGINT) AS ts, "
          "CAST(floor(value) AS INTEGER) AS vc FROM events)")
ARRIVALS = "arrivals AS (SELECT *, ts + ((seq * 7919) % 1800) AS arrival FROM sensor)"
LINES = ("doc_lines AS (SELECT doc_id, CAST(unnest(range(len(ls))) AS INTEGER) AS line_no, "
         "unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))")
JSPLIT = ("CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[] "
          "ELSE string_split(rtrim(line, ' '), ' ') END")
WORDS = f"doc_words AS (SELECT doc_id, line_no, unnest({JSPLIT}) AS word FROM doc_lines)"


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


S = with_(SENSOR)
SA = with_(SENSOR, ARRIVALS)
W_RUN = "PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
W_PREV = "PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _java_hash(x: str) -> str:
    # UTF-16 units: a code point beyond the basic plane is a surrogate pair
    units = (f"flatten(list_transform(string_split({x}, ''), lambda c: CASE WHEN ord(c) >= 65536 THEN "
             f"[55296 + (ord(c) - 65536) // 1024, 56320 + (ord(c) - 65536) % 1024] ELSE [ord(c)] END))")
    h = (f"list_reduce(list_transform({units}, lambda u: u::BIGINT), "
         f"lambda acc, v: (acc * 31 + v) % 4294967296, 0::BIGINT)")
    return f"CAST(CASE WHEN {h} >= 2147483648 THEN {h} - 4294967296 ELSE {h} END AS INTEGER)"


def _fmt_ms(sec: str) -> str:
    return f"strftime(make_timestamp(({sec}) * 1000000), '%Y-%m-%d %H:%M:%S.%g')"


def _label(key: str, cnt: str) -> str:
    return (f"{key} || ' in [' || {_fmt_ms('win_start')} || ' .. ' || {_fmt_ms('win_end')} "
            f"|| '): ' || CAST({cnt} AS VARCHAR) || ' rows'")


def _tumble(col: str, size: int) -> str:
    return f"{col} - {col} % {size}"


def _win_lateness_cte() -> str:
    d, l, w = P.DELAY_S, P.LATENESS_S, P.WINDOW_S
    return (SA + ", tr AS (SELECT *, max(ts) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING "
            "AND 1 PRECEDING) AS max_before FROM arrivals), "
            f"cl AS (SELECT *, {_tumble('ts', w)} AS win_start, {_tumble('ts', w)} + {w} AS win_end, "
            f"CASE WHEN max_before IS NULL THEN 'on_time' "
            f"WHEN max_before * 1000 - {d * 1000 + 1} >= ({_tumble('ts', w)} + {w}) * 1000 - 1 + {l * 1000} THEN 'late' "
            f"WHEN max_before * 1000 - {d * 1000 + 1} >= ({_tumble('ts', w)} + {w}) * 1000 - 1 THEN 'refire' "
            f"ELSE 'on_time' END AS status FROM tr) ")


def _two_input_late_cte() -> str:
    d = P.DELAY_S
    return (SA + ", lr AS (SELECT seq, id, ts, vc, arrival, CASE WHEN kind IN ('view','click','signup') THEN 'L' ELSE 'R' END AS side "
            "FROM arrivals), "
            "m AS (SELECT *, max(CASE WHEN side='L' THEN ts END) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lmax, "
            "max(CASE WHEN side='R' THEN ts END) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rmax FROM lr), "
            f"late AS (SELECT * FROM m WHERE lmax IS NOT NULL AND rmax IS NOT NULL AND ts * 1000 < least(lmax, rmax) * 1000 - {d * 1000 + 1}), "
            f"ok AS (SELECT * FROM m WHERE NOT (lmax IS NOT NULL AND rmax IS NOT NULL AND ts * 1000 < least(lmax, rmax) * 1000 - {d * 1000 + 1})) ")


ORACLE: dict[str, str] = {
    # ---- keyed aggregation ----
    "filter_group_sum_sql": S + f"SELECT id, CAST(sum(vc) AS BIGINT) AS sum_vc FROM sensor WHERE vc > {P.FILTER_VC} GROUP BY id",
    "filter_group_sum": S + f"SELECT id, CAST(sum(vc) AS BIGINT) AS sum_vc FROM sensor WHERE vc > {P.FILTER_VC} GROUP BY id",
    "sql_group_sum": S + "SELECT id, CAST(sum(vc) AS BIGINT) AS sum_vc FROM sensor GROUP BY id",
    "word_count": with_(LINES, WORDS) + "SELECT word, count(*) AS cnt FROM doc_words GROUP BY word",
    "running_reduce": S + f"SELECT seq, id, ts, CAST(sum(vc) OVER ({W_RUN}) AS BIGINT) AS vc FROM sensor",
    "running_sum": S + f"SELECT seq, id, first_value(ts) OVER ({W_RUN}) AS ts, CAST(sum(vc) OVER ({W_RUN}) AS BIGINT) AS vc FROM sensor",
    "running_max": S + f"SELECT seq, id, first_value(ts) OVER ({W_RUN}) AS ts, max(vc) OVER ({W_RUN}) AS vc FROM sensor",
    "running_min": S + f"SELECT seq, id, first_value(ts) OVER ({W_RUN}) AS ts, min(vc) OVER ({W_RUN}) AS vc FROM sensor",
    "running_max_by": S + f"SELECT seq, id, arg_max(ts, (vc, -seq)) OVER ({W_RUN}) AS ts, arg_max(vc, (vc, -seq)) OVER ({W_RUN}) AS vc FROM sensor",
    "running_min_by": S + f"SELECT seq, id, arg_min(ts, (vc, seq)) OVER ({W_RUN}) AS ts, arg_min(vc, (vc, seq)) OVER ({W_RUN}) AS vc FROM sensor",
    "running_avg": S + f"SELECT seq, id, vc, round(avg(vc) OVER ({W_RUN}), 6) AS avg_vc FROM sensor",
    # ---- projections / filters ----
    "map_project": S + "SELECT seq, id FROM sensor",
    "filter_eq": S + "SELECT seq, id, ts, vc FROM sensor WHERE id = 's1'",
    "flatmap_conditional": S + ("SELECT seq, 0 AS pos, CAST(vc AS VARCHAR) AS value FROM sensor WHERE id = 's1' "
                                "UNION ALL SELECT seq, 0, CAST(ts AS VARCHAR) FROM sensor WHERE id = 's2' "
                                "UNION ALL SELECT seq, 1, CAST(vc AS VARCHAR) FROM sensor WHERE id = 's2'"),
    "map_lifecycle": S + "SELECT seq, CAST(vc AS BIGINT) + 1 AS result FROM sensor",
    "sql_filter": S + f"SELECT seq, id, ts, vc FROM sensor WHERE ts > {P.TS_CUT}",
    "select_rename": S + "SELECT id AS sensor_id, ts AS event_ts, vc AS water_level FROM sensor",
    "sql_nested_view": S + f"SELECT id, ts, vc FROM (SELECT * FROM sensor WHERE vc > {P.FILTER_VC}) tmp WHERE ts > {P.TS_CUT}",
    "scalar_functions": S + (
        ", l AS (SELECT seq, id, ts, vc, concat_ws(',', id, ts, vc) AS line FROM sensor) "
        "SELECT seq, split_part(line, ',', 1) AS id_part, CAST(split_part(line, ',', 2) AS BIGINT) AS ts_num, "
        "CAST(split_part(line, ',', 3) AS INTEGER) AS vc_num, id || '#' || CAST(vc AS VARCHAR) AS tag, "
        f"CAST(length(id) AS INTEGER) AS id_len, {_java_hash('id')} AS id_hash, abs(vc - 50) AS vc_dev, "
        "greatest(vc, 10) AS vc_floor10, vc % 7 AS vc_mod7, vc + 1 AS vc_plus1, round(vc / 4, 6) AS vc_div4, "
        f"{_fmt_ms('ts')} AS ts_text, CAST(octet_length(encode(id)) AS INTEGER) AS id_bytes, "
        "coalesce(nullif(vc, 0), -1) AS vc_nz, vc > 10 AS high FROM l"),
    # ---- splitting ----
    "split_even_odd": S + ("SELECT 'even' AS stream, seq, vc FROM sensor WHERE vc % 2 = 0 "
                           "UNION ALL SELECT 'odd', seq, vc FROM sensor WHERE vc % 2 = 1"),
    "split_routes": S + ("SELECT CASE WHEN id = 's1' THEN 's1' WHEN id = 's2' THEN 's2' ELSE 'main' END AS route, "
                         "seq, id, ts, vc FROM sensor"),
    "alert_threshold": S + (f"SELECT 'main' AS stream, seq, id, ts, vc, NULL::VARCHAR AS message FROM sensor "
                            f"UNION ALL SELECT 'warn', seq, id, ts, vc, 'level ' || CAST(vc AS VARCHAR) || ' is above {P.ALERT_VC}' "
                            f"FROM sensor WHERE vc > {P.ALERT_VC}"),
    "union_all": S + ("SELECT seq, vc AS value FROM sensor WHERE kind = 'view' UNION ALL "
                      "SELECT seq, vc FROM sensor WHERE kind = 'click' UNION ALL "
                      "SELECT seq, CAST(CAST(vc AS VARCHAR) AS INTEGER) FROM sensor WHERE kind IS NULL OR kind NOT IN ('view','click')"),
    "connect_map": S + ("SELECT 'left' AS side, CAST(vc AS VARCHAR) AS value FROM sensor WHERE kind IN ('view','click','signup') "
                        "UNION ALL SELECT 'right', id FROM sensor WHERE kind IS NULL OR kind NOT IN ('view','click','signup')"),
    # ---- distribution ----
    "part_by_key": S + "SELECT DISTINCT id, CAST(1 AS BIGINT) AS n_partitions FROM sensor",
    "part_round_robin": S + "SELECT count(*) AS n_rows, true AS balanced FROM sensor",
    "part_replicate": S + (f"SELECT CAST(r.range AS INTEGER) AS replica, c.cnt, CAST(0 AS BIGINT) AS misplaced "
                           f"FROM range({P.N_PARTS}) r, (SELECT count(*) AS cnt FROM sensor) c"),
    "part_custom": S + "SELECT DISTINCT id, true AS as_asked FROM sensor",
    "part_random": S + "SELECT count(*) AS n_rows, true AS all_used, true AS balanced FROM sensor",
    "part_rescale": S + "SELECT count(*) AS n_rows, true AS whole, true AS merged FROM sensor",
    # ---- windows ----
    "win_elements": S + (f"SELECT seq, id, ts, vc, {_tumble('ts', P.WINDOW_S)} AS win_start, {_tumble('ts', P.WINDOW_S)} + {P.WINDOW_S} AS win_end, "
                         f"count(*) OVER (PARTITION BY id, {_tumble('ts', P.WINDOW_S)}) AS cnt FROM sensor"),
    "win_tumbling": S + (f"SELECT {_tumble('ts', P.WINDOW_S)} AS win_start, {_tumble('ts', P.WINDOW_S)} + {P.WINDOW_S} AS win_end, "
                         "id, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS vc_sum FROM sensor GROUP BY ALL"),
    "win_tumbling_arrival": SA + (f"SELECT {_tumble('arrival', P.WINDOW_S)} AS win_start, {_tumble('arrival', P.WINDOW_S)} + {P.WINDOW_S} AS win_end, "
                                  "id, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS vc_sum FROM arrivals GROUP BY ALL"),
    "win_sliding": S + (f", x AS (SELECT *, unnest([{_tumble('ts', P.SLIDE_S)}, {_tumble('ts', P.SLIDE_S)} - {P.SLIDE_S}]) AS ws FROM sensor) "
                        f"SELECT ws AS win_start, ws + {P.WINDOW_S} AS win_end, id, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS vc_sum "
                        "FROM x GROUP BY ALL"),
    "win_sliding_arrival": SA + (f", x AS (SELECT *, unnest([{_tumble('arrival', P.SLIDE_S)}, {_tumble('arrival', P.SLIDE_S)} - {P.SLIDE_S}]) AS ws FROM arrivals) "
                                 f"SELECT ws AS win_start, ws + {P.WINDOW_S} AS win_end, id, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS vc_sum "
                                 "FROM x GROUP BY ALL"),
    "win_session": S + (", p AS (SELECT *, lag(ts) OVER (PARTITION BY id ORDER BY ts, seq) AS prev_ts FROM sensor), "
                        f"f AS (SELECT *, sum(CASE WHEN prev_ts IS NULL OR ts - prev_ts > {P.SESSION_GAP_S} THEN 1 ELSE 0 END) "
                        "OVER (PARTITION BY id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sno FROM p) "
                        f"SELECT id, min(ts) AS win_start, max(ts) + {P.SESSION_GAP_S} AS win_end, count(*) AS cnt, "
                        "CAST(sum(vc) AS BIGINT) AS vc_sum FROM f GROUP BY id, sno"),
    "win_session_dynamic": S + (f", p AS (SELECT *, ts + vc * {P.DYN_GAP_PER_VC_S} AS e, max(ts + vc * {P.DYN_GAP_PER_VC_S}) OVER "
                                "(PARTITION BY id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM sensor), "
                                "f AS (SELECT *, sum(CASE WHEN prev_end IS NULL OR ts > prev_end THEN 1 ELSE 0 END) "
                                "OVER (PARTITION BY id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sno FROM p) "
                                "SELECT id, min(ts) AS win_start, max(e) AS win_end, count(*) AS cnt, "
                                "CAST(sum(vc) AS BIGINT) AS vc_sum FROM f GROUP BY id, sno"),
    "win_count_tumbling": S + (f", r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM sensor) "
                               f"SELECT id, CAST((rn - 1) // {P.COUNT_SIZE} AS BIGINT) AS window_no, count(*) AS cnt, "
                               "CAST(sum(vc) AS BIGINT) AS vc_sum, min(seq) AS first_seq, max(seq) AS last_seq "
                               f"FROM r GROUP BY id, (rn - 1) // {P.COUNT_SIZE} HAVING count(*) = {P.COUNT_SIZE}"),
    "win_count_sliding": S + (", r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM sensor), "
                              f"f AS (SELECT id, rn AS fire_no FROM r WHERE rn % {P.COUNT_SLIDE} = 0) "
                              "SELECT f.id, CAST(f.fire_no AS BIGINT) AS fire_no, count(*) AS cnt, CAST(sum(r.vc) AS BIGINT) AS vc_sum, "
                              "min(r.seq) AS first_seq, max(r.seq) AS last_seq FROM f JOIN r ON r.id = f.id "
                              f"AND r.rn BETWEEN f.fire_no - {P.COUNT_SIZE - 1} AND f.fire_no GROUP BY f.id, f.fire_no"),
    "win_global": S + "SELECT id, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS vc_sum FROM sensor GROUP BY id",
    "win_global_trigger": S + (
        f", r AS (SELECT seq, id, vc, row_number() OVER ({W_RUN}) AS rn, sum(CASE WHEN vc > {P.TRIGGER_VC} THEN 1 ELSE 0 END) OVER ({W_RUN}) AS hits, "
        f"sum(vc) OVER ({W_RUN}) AS s FROM sensor), "
        f"f AS (SELECT 'count' AS kind, id, seq, rn // {P.TRIGGER_EVERY} AS firing, rn, s FROM r WHERE rn % {P.TRIGGER_EVERY} = 0 "
        f"UNION ALL SELECT 'condition', id, seq, hits, rn, s FROM r WHERE vc > {P.TRIGGER_VC}), "
        "p AS (SELECT *, coalesce(lag(rn) OVER (PARTITION BY kind, id ORDER BY seq), 0) AS prn, "
        "coalesce(lag(s) OVER (PARTITION BY kind, id ORDER BY seq), 0) AS ps FROM f) "
        "SELECT kind || ' keep' AS trigger, id, seq, CAST(firing AS BIGINT) AS firing, CAST(rn AS BIGINT) AS cnt, CAST(s AS BIGINT) AS vc_sum FROM p "
        "UNION ALL SELECT kind || ' purge', id, seq, CAST(firing AS BIGINT), CAST(rn - prn AS BIGINT), CAST(s - ps AS BIGINT) FROM p"),
    "win_all": S + (f"SELECT {_tumble('ts', P.WINDOW_S)} AS win_start, {_tumble('ts', P.WINDOW_S)} + {P.WINDOW_S} AS win_end, "
                    "count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS vc_sum FROM sensor GROUP BY ALL"),
    "win_reduce": S + (f"SELECT {_tumble('ts', P.WINDOW_S)} AS win_start, {_tumble('ts', P.WINDOW_S)} + {P.WINDOW_S} AS win_end, "
                       "id, arg_max(ts, seq) AS ts, CAST(sum(vc) AS BIGINT) AS vc FROM sensor GROUP BY ALL"),
    "win_aggregate": S + (f"SELECT {_tumble('ts', P.WINDOW_S)} AS win_start, {_tumble('ts', P.WINDOW_S)} + {P.WINDOW_S} AS win_end, "
                          "id, CAST(CAST(sum(vc) AS BIGINT) AS VARCHAR) AS result FROM sensor GROUP BY ALL"),
    "win_process": S + (f", g AS (SELECT {_tumble('ts', P.WINDOW_S)} AS win_start, {_tumble('ts', P.WINDOW_S)} + {P.WINDOW_S} AS win_end, "
                        "id, count(*) AS cnt, min(vc) AS vc_min, max(vc) AS vc_max FROM sensor GROUP BY ALL) "
                        f"SELECT *, {_label('id', 'cnt')} AS label FROM g"),
    "win_agg_with_bounds": S + (f", g AS (SELECT {_tumble('ts', P.WINDOW_S)} AS win_start, {_tumble('ts', P.WINDOW_S)} + {P.WINDOW_S} AS win_end, "
                                "id, CAST(CAST(sum(vc) AS BIGINT) AS VARCHAR) AS result FROM sensor GROUP BY ALL) "
                                f"SELECT *, {_label('id', '1')} AS label FROM g"),
    "win_parity_groups": S + (f"SELECT {_tumble('ts', P.WINDOW_S)} AS win_start, {_tumble('ts', P.WINDOW_S)} + {P.WINDOW_S} AS win_end, "
                              "vc % 2 AS parity, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS vc_sum FROM sensor GROUP BY ALL"),
    # ---- top-n ----
    "topn_window": S + (f", x AS (SELECT *, unnest([{_tumble('ts', P.SLIDE_S)}, {_tumble('ts', P.SLIDE_S)} - {P.SLIDE_S}]) AS ws FROM sensor), "
                        f"c AS (SELECT ws AS win_start, ws + {P.WINDOW_S} AS win_end, vc, count(*) AS cnt FROM x GROUP BY ALL), "
                        "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY win_start, win_end ORDER BY cnt DESC, vc ASC) AS INTEGER) AS rank FROM c) "
                        f"SELECT * FROM r WHERE rank <= {P.TOPN}"),
    "running_top3": S + (f", r AS (SELECT seq, id, vc, list_sort(list(vc) OVER ({W_RUN}), 'DESC') AS l FROM sensor) "
                         "SELECT seq, id, vc, l[1] AS top1, l[2] AS top2, l[3] AS top3 FROM r"),
    "top2_table_agg": S + (", r AS (SELECT id, vc AS value, CAST(row_number() OVER (PARTITION BY id ORDER BY vc DESC) AS INTEGER) AS rank "
                           f"FROM sensor WHERE vc > 0) SELECT * FROM r WHERE rank <= {P.TOPN}"),
    "top2_table_agg_udf": S + (", r AS (SELECT id, vc AS value, CAST(row_number() OVER (PARTITION BY id ORDER BY vc DESC) AS INTEGER) AS rank "
                               f"FROM sensor WHERE vc > 0) SELECT * FROM r WHERE rank <= {P.TOPN}"),
    "top2_changelog": S + (
        f", l AS (SELECT seq, id, vc, coalesce(list_sort(list(vc) FILTER (vc > 0) OVER ({W_PREV}), 'DESC'), []) AS b, "
        f"coalesce(list_sort(list(vc) FILTER (vc > 0) OVER ({W_RUN}), 'DESC'), []) AS a FROM sensor), "
        "c AS (SELECT seq, id, r.range AS i, l.b[r.range] AS o, l.a[r.range] AS n FROM l, range(1, 3) r) "
        "SELECT seq, id, CAST(2 * i - 1 AS INTEGER) AS pos, '+I' AS op, n AS value, CAST(i AS INTEGER) AS rank FROM c WHERE o IS NULL AND n IS NOT NULL "
        "UNION ALL SELECT seq, id, CAST(2 * i - 2 AS INTEGER), '-U', o, CAST(i AS INTEGER) FROM c WHERE o <> n "
        "UNION ALL SELECT seq, id, CAST(2 * i - 1 AS INTEGER), '+U', n, CAST(i AS INTEGER) FROM c WHERE o <> n"),
    # ---- keyed state (batch twins) ----
    "delta_alert": S + (f", p AS (SELECT seq, id, vc, coalesce(lag(vc) OVER (PARTITION BY id ORDER BY seq), 0) AS prev_vc FROM sensor) "
                        "SELECT seq, id, vc, prev_vc, id || ' went from ' || CAST(prev_vc AS VARCHAR) || ' to ' "
                        f"|| CAST(vc AS VARCHAR) || ', by more than {P.ALERT_VC}' AS message FROM p WHERE abs(vc - prev_vc) > {P.ALERT_VC}"),
    "vc_count_map": S + "SELECT id, vc, count(*) AS n FROM sensor GROUP BY id, vc",
    "vc_count_running": S + ("SELECT seq, id, vc, count(*) OVER (PARTITION BY id, vc ORDER BY seq ROWS BETWEEN "
                             "UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM sensor"),
    "ttl_event_time": S + (", p AS (SELECT *, lag(ts) OVER (PARTITION BY id ORDER BY seq) AS prev_t FROM sensor), "
                           f"q AS (SELECT *, CASE WHEN prev_t IS NOT NULL AND ts - prev_t >= {P.TTL_S} THEN seq END AS brk, "
                           f"CASE WHEN vc > {P.ALERT_VC} THEN seq END AS w, CASE WHEN vc > {P.ALERT_VC} THEN vc END AS wv FROM p), "
                           f"r AS (SELECT *, last_value(w IGNORE NULLS) OVER ({W_PREV}) AS lw, last_value(wv IGNORE NULLS) OVER ({W_PREV}) AS lwv, "
                           f"last_value(brk IGNORE NULLS) OVER ({W_RUN}) AS lb FROM q) "
                           "SELECT seq, id, ts, vc, CASE WHEN lw IS NOT NULL AND (lb IS NULL OR lb <= lw) THEN lwv END AS state FROM r"),
    "changelog_sum": S + (f", r AS (SELECT seq, id, CAST(sum(vc) OVER ({W_RUN}) AS BIGINT) AS new_sum, "
                          f"CAST(sum(vc) OVER ({W_PREV}) AS BIGINT) AS old_sum FROM sensor) "
                          "SELECT seq, id, 0 AS pos, '+I' AS op, new_sum AS sum_vc FROM r WHERE old_sum IS NULL "
                          "UNION ALL SELECT seq, id, 0, '-U', old_sum FROM r WHERE old_sum IS NOT NULL "
                          "UNION ALL SELECT seq, id, 1, '+U', new_sum FROM r WHERE old_sum IS NOT NULL"),
    # ---- UDF families ----
    "udf_java_hash": S + ("SELECT seq, id, " + _java_hash("id") + " AS id_hash, vc AS vc_hash, "
                          "CAST(CASE WHEN xor(seq, seq >> 32) % 4294967296 >= 2147483648 "
                          "THEN xor(seq, seq >> 32) % 4294967296 - 4294967296 ELSE xor(seq, seq >> 32) % 4294967296 END AS INTEGER) "
                          "AS seq_hash FROM sensor"),
    "udaf_weighted_avg": ("SELECT l_returnflag AS name, round(sum(CAST(trunc(l_extendedprice) AS BIGINT) * CAST(trunc(l_quantity) AS BIGINT)) "
                          "/ sum(CAST(trunc(l_quantity) AS BIGINT)), 6) AS wavg FROM lineitem GROUP BY l_returnflag"),
    "lateral_cross": with_(LINES) + (f", t AS (SELECT doc_id, line_no, unnest({JSPLIT}) AS word FROM doc_lines) "
                                     "SELECT doc_id, line_no, word, CAST(length(word) AS INTEGER) AS length FROM t"),
    "lateral_left": with_(LINES) + (f", a AS (SELECT doc_id, line_no, {JSPLIT} AS ws FROM doc_lines), "
                                    "t AS (SELECT doc_id, line_no, unnest(CASE WHEN len(ws) = 0 THEN [NULL]::VARCHAR[] ELSE ws END) AS word FROM a) "
                                    "SELECT doc_id, line_no, word, CAST(length(word) AS INTEGER) AS length FROM t"),
    # ---- joins ----
    "join_window": S + (", l AS (SELECT * FROM sensor WHERE kind IN ('view','click','signup')), r AS (SELECT * FROM sensor WHERE kind IS NULL OR kind NOT IN ('view','click','signup')) "
                        f"SELECT l.id, {_tumble('l.ts', P.WINDOW_S)} AS win_start, {_tumble('l.ts', P.WINDOW_S)} + {P.WINDOW_S} AS win_end, "
                        "l.seq AS l_seq, l.ts AS l_ts, l.vc AS l_vc, r.seq AS r_seq, r.ts AS r_ts, r.vc AS r_vc "
                        f"FROM l JOIN r ON l.id = r.id AND {_tumble('l.ts', P.WINDOW_S)} = {_tumble('r.ts', P.WINDOW_S)}"),
    "join_interval": S + (", l AS (SELECT * FROM sensor WHERE kind IN ('view','click','signup')), r AS (SELECT * FROM sensor WHERE kind IS NULL OR kind NOT IN ('view','click','signup')) "
                          "SELECT l.id, l.seq AS l_seq, l.ts AS l_ts, l.vc AS l_vc, r.seq AS r_seq, r.ts AS r_ts, r.vc AS r_vc "
                          f"FROM l JOIN r ON l.id = r.id AND r.ts BETWEEN l.ts + ({P.JOIN_LOWER_S}) AND l.ts + {P.JOIN_UPPER_S}"),
    "join_interval_late": _two_input_late_cte() + (
        ", l AS (SELECT * FROM ok WHERE side = 'L'), r AS (SELECT * FROM ok WHERE side = 'R') "
        "SELECT l.id, l.seq AS l_seq, l.ts AS l_ts, l.vc AS l_vc, r.seq AS r_seq, r.ts AS r_ts, r.vc AS r_vc "
        f"FROM l JOIN r ON l.id = r.id AND r.ts BETWEEN l.ts + ({P.JOIN_LOWER_S}) AND l.ts + {P.JOIN_UPPER_S}"),
    "join_late_sides": _two_input_late_cte() + "SELECT side, seq, id, ts, vc FROM late",
    "join_connected": ("SELECT o.o_orderkey AS id, o.o_orderstatus AS x, l.l_returnflag AS y, l.l_linenumber AS n "
                       "FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey"),
    "broadcast_static": S + (", cfg AS (SELECT coalesce(arg_max(vc, seq), 0) AS threshold FROM sensor WHERE kind = 'error') "
                             "SELECT s.seq, s.id, s.vc, cfg.threshold FROM sensor s, cfg WHERE s.kind IS DISTINCT FROM 'error' AND s.vc > cfg.threshold"),
    "broadcast_asof": S + (", m AS (SELECT seq, id, vc, kind IS NOT DISTINCT FROM 'error' AS is_cfg, CASE WHEN kind = 'error' THEN vc END AS cfg FROM sensor), "
                           "t AS (SELECT *, coalesce(last_value(cfg IGNORE NULLS) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS threshold FROM m) "
                           "SELECT seq, id, vc, threshold FROM t WHERE NOT is_cfg AND vc > threshold"),
    # ---- event time ----
    "watermark_trace": SA + ("SELECT seq, arrival, ts, coalesce(max(ts) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) * 1000 "
                             f"- {P.DELAY_S * 1000 + 1}, -9223372036854775808) AS wm_before_ms, "
                             f"max(ts) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 1000 - {P.DELAY_S * 1000 + 1} AS wm_after_ms FROM arrivals"),
    "watermark_periodic": SA + (
        f", t AS (SELECT seq, arrival, ts, max(ts) OVER (ORDER BY arrival // {P.EMIT_S} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM arrivals), "
        f"w AS (SELECT seq, arrival, ts, coalesce(top * 1000 - {P.DELAY_S * 1000 + 1}, -9223372036854775808) AS wm_before_ms FROM t) "
        f"SELECT *, wm_before_ms >= ({_tumble('ts', P.WINDOW_S)} + {P.WINDOW_S}) * 1000 - 1 AS late FROM w"),
    "watermark_idle": SA + (
        f", i AS (SELECT seq, arrival, ts, CASE WHEN ts > {P.TS_CUT} THEN 0 ELSE vc % 2 END AS input FROM arrivals), "
        + "o AS (SELECT *, min(arrival) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b, "
        + ", ".join(f"max(CASE WHEN input = {k} THEN ts END) OVER p AS t{k}, max(CASE WHEN input = {k} THEN arrival END) OVER p AS a{k}" for k in (0, 1))
        + " FROM i WINDOW p AS (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), "
        + f"w AS (SELECT *, arrival - coalesce(a0, b) <= {P.IDLE_S} AS on0, arrival - coalesce(a1, b) <= {P.IDLE_S} AS on1 FROM o), "
        "m AS (SELECT *, CASE WHEN (on0 AND t0 IS NULL) OR (on1 AND t1 IS NULL) THEN NULL "
        "WHEN on0 AND on1 THEN least(t0, t1) WHEN on0 THEN t0 WHEN on1 THEN t1 END AS raw FROM w) "
        "SELECT seq, arrival, ts, input, coalesce(max(raw) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 1000 "
        f"- {P.DELAY_S * 1000 + 1}, -9223372036854775808) AS wm_before_ms FROM m"),
    "late_side_output": _win_lateness_cte() + "SELECT seq, id, ts, vc, arrival, win_start FROM cl WHERE status = 'late'",
    "late_allowed": _win_lateness_cte() + ("SELECT id, win_start, win_end, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS vc_sum, "
                                           "CAST(max(CASE WHEN status = 'on_time' THEN 1 ELSE 0 END) + sum(CASE WHEN status = 'refire' THEN 1 ELSE 0 END) AS BIGINT) AS firings "
                                           "FROM cl WHERE status <> 'late' GROUP BY id, win_start, win_end"),
    # ---- sources / sinks ----
    "src_parse_lines": S + "SELECT seq, id, ts, vc FROM sensor",
    "sink_bucketed_files": S + ("SELECT strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H') AS bucket, count(*) AS cnt FROM sensor GROUP BY 1"),
    "sink_rolled_files": S + (
        f", l AS (SELECT strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') AS bucket, (ts % 86400) // {P.FILE_EVERY_S} AS part, ts, seq, "
        "octet_length(encode(concat_ws(',', id, ts, vc))) + 1 AS size FROM sensor), "
        "c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY bucket, part ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM l) "
        f"SELECT bucket, '{P.FILE_PREFIX}-' || CAST(part AS VARCHAR) || '-' || CAST(CAST(before AS BIGINT) // {P.FILE_BYTES} AS VARCHAR) || '{P.FILE_SUFFIX}' AS file, "
        "count(*) AS cnt, CAST(sum(size) AS BIGINT) AS n_bytes FROM c GROUP BY 1, 2"),
    "sink_kafka_records": S + f"SELECT '{P.TOPIC}' AS topic, concat_ws(',', id, ts, vc) AS value FROM sensor",
    "sink_kafka_keyed": S + f"SELECT '{P.TOPIC}' AS topic, id AS key, concat_ws(',', id, ts, vc) AS value FROM sensor",
    "sink_table_insert": S + "SELECT seq, id, ts, vc FROM sensor",
}
