"""DuckDB statements equal to the registered queries (same column names).

They are written independently of the Spark code: plain SQL over the
driver's views, using DuckDB's own zone conversion (ICU), window functions
and ``generate_series``.
"""

from __future__ import annotations

from lmplake.feeds import FEEDS

NY = "America/New_York"


def _ny(e: str) -> str:
    """UTC wall time -> New York wall time."""
    return f"((({e}) AT TIME ZONE 'UTC') AT TIME ZONE '{NY}')"


def _utc_of_ny(e: str) -> str:
    """New York wall time -> UTC wall time."""
    return f"((({e}) AT TIME ZONE '{NY}') AT TIME ZONE 'UTC')"


def _floor5(e: str) -> str:
    return f"(date_trunc('minute', {e}) - to_minutes(CAST(minute({e}) % 5 AS BIGINT)))"


def _prices(src: str, pull: str, seq: str, t: str, node: str, v: str) -> str:
    return f"""
      SELECT {t} AS utcbegin,
             CAST({_ny(t)} AS DATE) AS pricedate,
             CAST(hour({_ny(t)}) + 1 AS INTEGER) AS hour,
             {node} AS node_id,
             {v} AS dalmp, {v} / 4 AS damcc, -{v} / 8 AS damcl,
             {pull} AS pull_id, {seq} AS ingest_seq
      FROM {src}"""


EV = _prices("events", "event_type", "event_id", "date_trunc('hour', ts)", "user_id", "value")
EV5 = _prices("events", "event_type", "event_id", _floor5("ts"), "user_id", "value")
OR = _prices("orders", "o_orderpriority", "o_orderkey", "o_orderdate", "o_custkey", "o_totalprice")

WITH_EV = f"WITH ev AS ({EV})"
WITH_OR = f"WITH o AS ({OR})"

LAKE_COLS = "utcbegin, pricedate, hour, node_id, dalmp, damcc, damcl, ingest_seq"

MERGED = f"""
  SELECT {LAKE_COLS} FROM ev
  QUALIFY row_number() OVER (PARTITION BY node_id, utcbegin ORDER BY ingest_seq % 2 DESC, ingest_seq DESC) = 1"""

TEST_ASSETS = "(VALUES (CAST(8 AS BIGINT), 'fern'), (46, 'camden'), (7, 'dom')) AS a(node_id, node)"

def _verified(begin: str) -> str:
    nd = f"(CAST({_ny(begin)} AS DATE) + 1)"
    d = f"({nd} + CASE isodow({nd}) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END)"
    return _utc_of_ny(f"CAST({d} AS TIMESTAMP) + INTERVAL 10 HOUR")


def _delay(expected: str, now: str, floor: int) -> str:
    diff = f"date_diff('second', TIMESTAMP '{now}', {expected})"
    return f"CAST(CASE WHEN {diff} > 0 THEN {diff} ELSE {floor} END AS BIGINT)"


def _mmddyyyy(e: str) -> str:
    return f"strftime({e}, '%m-%d-%Y %H:%M')"


EVENT_FEED_CASE = """CASE event_type WHEN 'click' THEN 'da_hrl_lmps' WHEN 'signup' THEN 'da_hrl_lmps'
      WHEN 'view' THEN 'rt_fivemin_hrl_lmps' WHEN 'error' THEN 'rt_fivemin_hrl_lmps'
      WHEN 'purchase' THEN 'rt_unverified_fivemin_lmps' END"""

PAGES = """
  pos AS (SELECT event_type AS pull_id, event_id,
                 row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS position FROM events),
  pg AS (SELECT pull_id, CAST((position - 1) // 500 AS BIGINT) AS page_index, count(*) AS n_rows
         FROM pos GROUP BY 1, 2)"""

ORACLE: dict[str, str] = {
    "normalize_prices": f"{WITH_OR} SELECT * FROM o",

    "scan_json_pages": f"""
      WITH ev AS ({EV}),
      pos AS (SELECT *, row_number() OVER (PARTITION BY pull_id ORDER BY ingest_seq) AS position FROM ev)
      SELECT utcbegin, pricedate, hour, node_id, dalmp, damcc, damcl, pull_id,
             CAST((position - 1) // 500 AS BIGINT) AS page_index
      FROM pos""",

    "parse_timestamps": """
      SELECT event_id AS ingest_seq,
             strftime(ts, '%Y-%m-%dT%H:%M:%S') AS raw_text,
             date_trunc('second', ts) AS utcbegin,
             strftime(ts, '%Y-%m-%dT%H:%M:%S') AS round_trip,
             strftime(date_trunc('second', ts), '%m-%d-%Y %H:%M') AS api_text
      FROM events""",

    "quarantine_rows": """
      WITH r AS (
        SELECT event_type AS pull_id,
               CASE WHEN event_id % 97 = 0 THEN 'not a time'
                    ELSE strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') END AS t,
               CASE WHEN event_id % 89 = 0 THEN 'node-x' ELSE CAST(user_id AS VARCHAR) END AS n,
               CASE WHEN event_id % 83 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS p1, CAST(value / 4 AS VARCHAR) AS p2, CAST(-value / 8 AS VARCHAR) AS p3
        FROM events),
      f AS (
        SELECT pull_id,
               try_strptime(t, '%Y-%m-%dT%H:%M:%S') IS NULL AS bad_t,
               TRY_CAST(n AS BIGINT) IS NULL AS bad_n,
               (p1 IS NOT NULL AND TRY_CAST(p1 AS DOUBLE) IS NULL)
               OR (p2 IS NOT NULL AND TRY_CAST(p2 AS DOUBLE) IS NULL)
               OR (p3 IS NOT NULL AND TRY_CAST(p3 AS DOUBLE) IS NULL) AS bad_p
        FROM r)
      SELECT pull_id, count(*) AS n_rows,
             count(*) FILTER (WHERE bad_t OR bad_n OR bad_p) AS n_quarantined,
             count(*) FILTER (WHERE bad_t) AS n_bad_time,
             count(*) FILTER (WHERE bad_n) AS n_bad_node,
             count(*) FILTER (WHERE bad_p) AS n_bad_price
      FROM f GROUP BY pull_id""",

    "latest_wins": f"""{WITH_EV}
      SELECT {LAKE_COLS} FROM ev
      QUALIFY row_number() OVER (PARTITION BY node_id, utcbegin ORDER BY ingest_seq DESC) = 1""",

    "first_day_filter": f"""{WITH_EV}
      SELECT * FROM ev e
      WHERE pricedate = (SELECT min(pricedate) FROM ev m WHERE m.pull_id = e.pull_id)""",

    "next_cursor": f"""
      WITH d AS ({EV}), r AS ({EV5})
      SELECT 'da_hrl_lmps' AS feed, pull_id, max(utcbegin) AS last_utcbegin,
             max(utcbegin) + INTERVAL 60 MINUTE AS next_begin_utc FROM d GROUP BY pull_id
      UNION ALL
      SELECT 'rt_fivemin_hrl_lmps' AS feed, pull_id, max(utcbegin) AS last_utcbegin,
             max(utcbegin) + INTERVAL 5 MINUTE AS next_begin_utc FROM r GROUP BY pull_id""",

    "page_plan": """
      WITH t AS (SELECT event_type AS pull_id, count(*) AS total_rows FROM events GROUP BY 1),
      p AS (SELECT pull_id, unnest(range(0, CAST(ceil(total_rows / 500) AS BIGINT))) AS page_index
            FROM t WHERE total_rows > 0)
      SELECT pull_id, CAST(page_index AS BIGINT) AS page_index,
             CAST(page_index * 500 + 1 AS BIGINT) AS start_row FROM p""",

    "page_completeness": f"""
      WITH {PAGES.replace("  pg AS (", "  whole AS (")},
      pg AS (SELECT pull_id, page_index, page_index * 500 + 1 AS start_row, n_rows FROM whole
             WHERE NOT (pull_id IN ('view', 'signup') AND page_index % 3 = 1)
             UNION ALL SELECT pull_id, -1, 3, 1 FROM whole WHERE pull_id IN ('error', 'signup') AND page_index = 0),
      t AS (SELECT event_type AS pull_id, count(*) AS total_rows FROM events GROUP BY 1),
      g AS (SELECT pull_id, count(*) AS received_pages, CAST(sum(n_rows) AS BIGINT) AS received_rows
            FROM pg GROUP BY 1),
      e AS (SELECT pull_id, unnest(range(0, CAST(ceil(total_rows / 500) AS BIGINT))) AS page_index
            FROM t WHERE total_rows > 0),
      m AS (SELECT pull_id, count(*) AS missing_pages FROM
              (SELECT pull_id, page_index FROM e EXCEPT SELECT pull_id, page_index FROM pg) GROUP BY 1),
      x AS (SELECT pull_id, count(*) AS unexpected_pages FROM
              (SELECT pull_id, page_index FROM pg EXCEPT SELECT pull_id, page_index FROM e) GROUP BY 1)
      SELECT t.pull_id, CAST(t.total_rows AS BIGINT) AS total_rows,
             CAST(ceil(t.total_rows / 500) AS BIGINT) AS expected_pages,
             coalesce(g.received_pages, 0) AS received_pages,
             coalesce(g.received_rows, 0) AS received_rows,
             coalesce(m.missing_pages, 0) AS missing_pages,
             coalesce(x.unexpected_pages, 0) AS unexpected_pages,
             coalesce(m.missing_pages, 0) = 0 AND coalesce(x.unexpected_pages, 0) = 0
               AND coalesce(g.received_rows, 0) = t.total_rows AS complete
      FROM t LEFT JOIN g USING (pull_id) LEFT JOIN m USING (pull_id) LEFT JOIN x USING (pull_id)""",

    "request_windows": f"""
      WITH r AS (
        SELECT event_id AS ingest_seq, {EVENT_FEED_CASE} AS feed,
               CASE WHEN {EVENT_FEED_CASE} = 'da_hrl_lmps' THEN date_trunc('hour', ts) ELSE {_floor5('ts')} END AS begin_utc
        FROM events),
      w AS (SELECT *, begin_utc + CASE WHEN feed = 'da_hrl_lmps' THEN INTERVAL 23 HOUR ELSE INTERVAL 10 MINUTE END AS end_utc
            FROM r)
      SELECT ingest_seq, feed, begin_utc, CAST(1 AS BIGINT) AS start_row,
             '50000' AS rowCount, '1' AS StartRow, 'True' AS download,
             CASE WHEN feed = 'rt_unverified_fivemin_lmps' THEN NULL ELSE 'True' END AS row_is_current,
             {_mmddyyyy('begin_utc')} || ' to ' || {_mmddyyyy('end_utc')} AS datetime_beginning_utc,
             CASE WHEN feed = 'da_hrl_lmps'
                  THEN 'datetime_beginning_utc,pnode_id,total_lmp_da,congestion_price_da,marginal_loss_price_da'
                  ELSE 'datetime_beginning_utc,pnode_id,total_lmp_rt,congestion_price_rt,marginal_loss_price_rt' END AS fields,
             end_utc
      FROM w""",

    "expected_at": f"""
      WITH b AS (SELECT event_id AS ingest_seq, date_trunc('hour', ts) AS begin_utc FROM events)
      SELECT ingest_seq, begin_utc,
             begin_utc - INTERVAL 14 HOUR AS expected_da,
             {_verified('begin_utc')} AS expected_verified,
             begin_utc + INTERVAL 5 MINUTE AS expected_unverified
      FROM b""",

    "request_delay": f"""
      WITH b AS (SELECT event_id AS ingest_seq, date_trunc('hour', ts) AS begin_utc FROM events)
      SELECT ingest_seq, begin_utc,
             {_delay("begin_utc - INTERVAL 14 HOUR", "2024-01-15 12:00:00", 60)} AS delay_da,
             {_delay(_verified("begin_utc"), "2024-01-15 12:00:00", 0)} AS delay_verified,
             {_delay("begin_utc + INTERVAL 5 MINUTE", "2024-01-15 12:00:00", 0)} AS delay_unverified
      FROM b""",

    "control_messages": f"""
      WITH m AS (
        SELECT event_id, event_type, {_floor5('ts')} AS b,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
      SELECT event_id AS ingest_seq,
             CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'fetch'
                  WHEN event_type = 'signup' THEN 'merge' ELSE 'bad' END AS kind,
             CASE event_type WHEN 'click' THEN 'da_hrl_lmps' WHEN 'view' THEN 'rt_fivemin_hrl_lmps'
                  WHEN 'purchase' THEN 'rt_unverified_fivemin_lmps' WHEN 'signup' THEN 'rt_fivemin_hrl_lmps' END AS feed,
             CASE WHEN event_type IN ('click', 'view', 'purchase') THEN b END AS begin_utc,
             CASE WHEN event_type IN ('click', 'view', 'purchase') THEN k % 2 = 0 END AS queue_next,
             CASE WHEN event_type = 'signup' THEN CAST({_ny('b')} AS DATE) END AS merge_date
      FROM m""",

    "pending_merges": f"""
      SELECT 'rt_fivemin_hrl_lmps' AS feed, CAST({_ny(_floor5('ts'))} AS DATE) AS merge_date,
             count(*) AS n_requests
      FROM events WHERE event_type = 'signup' GROUP BY 2""",

    "next_requests": f"""
      WITH o AS ({OR}),
      d AS (SELECT pull_id, min(pricedate) AS lo, max(pricedate) AS hi FROM o GROUP BY 1),
      r AS (SELECT pull_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS pricedate FROM d),
      g AS (SELECT pull_id, pricedate, count(*) AS n_rows, max(utcbegin) AS last FROM o GROUP BY 1, 2),
      j AS (SELECT r.pull_id, r.pricedate, coalesce(g.n_rows, 0) AS n_rows,
                   CASE WHEN g.n_rows IS NULL THEN {_utc_of_ny('CAST(r.pricedate AS TIMESTAMP)')}
                        ELSE g.last + INTERVAL 1 HOUR END AS next_begin_utc
            FROM r LEFT JOIN g USING (pull_id, pricedate)),
      k AS (SELECT *, {_delay("next_begin_utc - INTERVAL 14 HOUR", "2001-07-15 12:00:00", 60)} AS delay_secs,
                   '{{"begin_time_iso_str":"' || strftime(next_begin_utc, '%Y-%m-%dT%H:%M:%S')
                     || '+0000","pjm_end_point":"da_hrl_lmps","queue_next":true}}' AS message
            FROM j)
      SELECT 'da_hrl_lmps' AS feed, pull_id, pricedate, n_rows, next_begin_utc, delay_secs,
             TIMESTAMP '2001-07-15 12:00:00' + to_seconds(delay_secs) AS not_before,
             'dahrllmps' AS queue, message, to_base64(encode(message)) AS payload
      FROM k""",

    "day_merge": f"{WITH_EV} {MERGED}",

    "carried_over_nodes": f"""{WITH_EV}
      SELECT DISTINCT pricedate, node_id FROM ev WHERE ingest_seq % 2 = 0
      EXCEPT
      SELECT DISTINCT pricedate, node_id FROM ev WHERE ingest_seq % 2 = 1""",

    "input_manifest": f"""{WITH_EV},
      f AS (SELECT *, 'da_hrl_lmps/_input/' || pull_id || '/' || CAST(CAST(utcbegin AS DATE) AS VARCHAR)
                      || '/batch' || CAST(ingest_seq % 2 AS VARCHAR) || '.parquet' AS file_path FROM ev)
      SELECT pricedate, file_path, count(*) AS n_rows, min(utcbegin) AS first_utcbegin,
             max(utcbegin) AS last_utcbegin, regexp_replace(file_path, '^da_hrl_lmps/', '') AS rel_path
      FROM f GROUP BY 1, 2""",

    "unprocessed_inputs": f"""{WITH_EV},
      f AS (SELECT ingest_seq % 2 AS batch, 'da_hrl_lmps/_input/' || pull_id || '/' || CAST(CAST(utcbegin AS DATE) AS VARCHAR)
                      || '/batch' || CAST(ingest_seq % 2 AS VARCHAR) || '.parquet' AS file_path FROM ev)
      SELECT DISTINCT file_path FROM f
      EXCEPT SELECT file_path FROM f WHERE batch = 0""",

    "node_inventory": f"""{WITH_EV}, m AS ({MERGED})
      SELECT DISTINCT pricedate, node_id FROM m""",

    "node_day_lookup": f"""{WITH_EV}, m AS ({MERGED})
      SELECT * FROM m WHERE node_id IN (SELECT node_id FROM {TEST_ASSETS})""",

    "asset_lookup": f"""{WITH_EV}
      SELECT a.node, ev.utcbegin, ev.pricedate, ev.hour, ev.dalmp, ev.damcc, ev.damcl, ev.ingest_seq
      FROM ev JOIN {TEST_ASSETS} ON ev.node_id = a.node_id""",

    "asset_upsert": f"""{WITH_EV},
      s AS (SELECT a.node, ev.utcbegin, ev.pricedate, ev.hour, ev.dalmp, ev.damcc, ev.damcl, ev.ingest_seq
            FROM ev JOIN {TEST_ASSETS} ON ev.node_id = a.node_id)
      SELECT * FROM s
      QUALIFY row_number() OVER (PARTITION BY node, utcbegin ORDER BY ingest_seq % 2 DESC, ingest_seq DESC) = 1""",

    "gap_report": f"""{WITH_EV},
      p AS (SELECT DISTINCT pull_id, utcbegin FROM ev),
      b AS (SELECT pull_id, min(utcbegin) AS lo, max(utcbegin) AS hi FROM p GROUP BY 1),
      g AS (SELECT pull_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS utcbegin FROM b)
      SELECT pull_id, utcbegin FROM g EXCEPT SELECT pull_id, utcbegin FROM p""",

    "gap_report_nodes": f"""{WITH_EV},
      p AS (SELECT DISTINCT node_id, utcbegin FROM ev),
      b AS (SELECT node_id, min(utcbegin) AS lo, max(utcbegin) AS hi FROM p GROUP BY 1),
      g AS (SELECT node_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS utcbegin FROM b)
      SELECT node_id, utcbegin FROM g EXCEPT SELECT node_id, utcbegin FROM p""",

    "freshness": f"""
      WITH d AS ({EV}), r AS ({EV5}),
      l AS (SELECT 'da_hrl_lmps' AS feed, pull_id, max(utcbegin) AS last_utcbegin,
                   max(utcbegin) + INTERVAL 60 MINUTE AS next_utcbegin FROM d GROUP BY pull_id
            UNION ALL
            SELECT 'rt_fivemin_hrl_lmps' AS feed, pull_id, max(utcbegin) AS last_utcbegin,
                   max(utcbegin) + INTERVAL 5 MINUTE AS next_utcbegin FROM r GROUP BY pull_id),
      e AS (SELECT *, CASE feed WHEN 'da_hrl_lmps' THEN next_utcbegin - INTERVAL 14 HOUR
                                ELSE {_verified('next_utcbegin')} END AS expected_at FROM l)
      SELECT *, date_diff('second', expected_at, TIMESTAMP '2024-01-15 12:00:00') AS overdue_secs FROM e""",

    "day_completeness": f"""{WITH_EV},
      p AS (SELECT DISTINCT pull_id, pricedate, utcbegin FROM ev),
      d AS (SELECT pull_id, pricedate, count(*) AS n_intervals, min(utcbegin) AS first_utcbegin,
                   max(utcbegin) AS last_utcbegin FROM p GROUP BY 1, 2),
      e AS (SELECT *, {_utc_of_ny('CAST(pricedate AS TIMESTAMP)')} AS day_first,
                      {_utc_of_ny('CAST(pricedate + 1 AS TIMESTAMP)')} AS next_first FROM d)
      SELECT pull_id, pricedate, n_intervals, first_utcbegin, last_utcbegin,
             CAST(date_diff('minute', day_first, next_first) / 60 AS BIGINT) AS expected_intervals,
             first_utcbegin = day_first AND last_utcbegin = next_first - INTERVAL 60 MINUTE
               AND n_intervals = CAST(date_diff('minute', day_first, next_first) / 60 AS BIGINT) AS complete
      FROM e""",

    "day_boundaries": f"""{WITH_OR},
      m AS (SELECT * REPLACE (CASE ingest_seq % 3
                     WHEN 0 THEN {_utc_of_ny('CAST(pricedate AS TIMESTAMP)')}
                     WHEN 1 THEN {_utc_of_ny('CAST(pricedate + 1 AS TIMESTAMP)')} - INTERVAL 1 HOUR
                     ELSE utcbegin END AS utcbegin) FROM o),
      b AS (SELECT * REPLACE (CAST(hour({_ny('utcbegin')}) + 1 AS INTEGER) AS hour) FROM m)
      SELECT *, utcbegin = {_utc_of_ny('CAST(pricedate AS TIMESTAMP)')} AS is_first_of_day,
             CAST({_ny('utcbegin + INTERVAL 60 MINUTE')} AS DATE) > pricedate AS is_last_of_day
      FROM b""",

    "feed_source_read": f"""
      WITH ev AS ({EV}),
      pos AS (SELECT *, row_number() OVER (PARTITION BY pull_id ORDER BY ingest_seq) AS position FROM ev)
      SELECT utcbegin, pricedate, hour, node_id, dalmp, damcc, damcl, pull_id,
             CAST(((position - 1) // 500) * 500 + 1 AS BIGINT) AS start_row,
             CAST(position AS BIGINT) AS api_row
      FROM pos""",

    "feed_source_plan": """
      WITH t AS (SELECT event_type AS pull, count(*) AS total_rows FROM events GROUP BY 1),
      p AS (SELECT pull, total_rows, unnest(range(0, CAST(ceil(total_rows / 500) AS BIGINT))) AS page_index
            FROM t WHERE total_rows > 0)
      SELECT pull, CAST(page_index * 500 + 1 AS BIGINT) AS start_row,
             CAST(least(500, total_rows - page_index * 500) AS BIGINT) AS expected_rows
      FROM p""",

    "land_intake": f"{WITH_EV} SELECT {LAKE_COLS} FROM ev",

    "stream_cursor": f"""
      WITH ev AS ({EV}),
      pos AS (SELECT *, row_number() OVER (PARTITION BY pull_id ORDER BY ingest_seq) AS position FROM ev)
      SELECT utcbegin, pricedate, hour, node_id, dalmp, damcc, damcl, pull_id,
             CAST(((position - 1) // 500) * 500 + 1 AS BIGINT) AS start_row,
             CAST(position AS BIGINT) AS api_row
      FROM pos""",

    "fetch_cycle": f"""
      WITH ev AS ({EV}),
      f AS (SELECT * FROM ev e WHERE pricedate = (SELECT min(pricedate) FROM ev m WHERE m.pull_id = e.pull_id)),
      g AS (SELECT pull_id, count(*) AS n_rows, max(utcbegin) + INTERVAL 1 HOUR AS next_begin_utc FROM f GROUP BY 1),
      k AS (SELECT *, {_delay("next_begin_utc - INTERVAL 14 HOUR", "2024-01-15 12:00:00", 60)} AS delay_secs,
                   '{{"begin_time_iso_str":"' || strftime(next_begin_utc, '%Y-%m-%dT%H:%M:%S')
                     || '+0000","pjm_end_point":"da_hrl_lmps","queue_next":true}}' AS message
            FROM g)
      SELECT 'da_hrl_lmps' AS feed, pull_id AS pull, n_rows, next_begin_utc, delay_secs,
             TIMESTAMP '2024-01-15 12:00:00' + to_seconds(delay_secs) AS not_before,
             'dahrllmps' AS queue, message, to_base64(encode(message)) AS payload
      FROM k""",

    "intake_scan": f"""{WITH_EV}
      SELECT {LAKE_COLS} FROM ev
      WHERE pricedate IN (SELECT DISTINCT CAST({_ny(_floor5('ts'))} AS DATE) FROM events WHERE event_type = 'signup')""",

    "day_layout": f"""{WITH_EV}
      SELECT {LAKE_COLS} FROM ev
      QUALIFY row_number() OVER (PARTITION BY node_id, utcbegin ORDER BY ingest_seq DESC) = 1""",

    "intake_sweep": f"""{WITH_EV}, m AS ({MERGED})
      SELECT utcbegin, pricedate, hour, node_id, dalmp, damcc, damcl,
             CASE WHEN ingest_seq % 2 = 1 THEN ingest_seq + 4294967296 ELSE ingest_seq END AS ingest_seq
      FROM m""",

    "stream_day_merge": f"""{WITH_EV}, m AS ({MERGED})
      SELECT utcbegin, pricedate, hour, node_id, dalmp, damcc, damcl,
             CASE WHEN ingest_seq % 2 = 1 THEN ingest_seq + 4294967296 ELSE ingest_seq END AS ingest_seq
      FROM m""",

    "stream_asset_upsert": f"""{WITH_EV},
      s AS (SELECT a.node, ev.utcbegin, ev.pricedate, ev.hour, ev.dalmp, ev.damcc, ev.damcl,
                   CASE WHEN ev.ingest_seq % 2 = 1 THEN ev.ingest_seq + 4294967296 ELSE ev.ingest_seq END AS ingest_seq
            FROM ev JOIN {TEST_ASSETS} ON ev.node_id = a.node_id)
      SELECT * FROM s
      QUALIFY row_number() OVER (PARTITION BY node, utcbegin ORDER BY ingest_seq % 2 DESC, ingest_seq DESC) = 1""",

    "save_targets": f"""{WITH_OR}
      SELECT DISTINCT pricedate, CAST(date_trunc('month', pricedate) AS DATE) AS month,
             pricedate AS save_target FROM o""",
}

ORACLE["scan_json_files"] = f"{WITH_EV} SELECT utcbegin, pricedate, hour, node_id, dalmp, damcc, damcl FROM ev"

ORACLE["overlapping_pulls"] = f"""{WITH_EV},
  u AS (SELECT *, date_trunc('day', utcbegin) AS begin_utc FROM ev
        UNION ALL
        SELECT * REPLACE (dalmp + 1000 AS dalmp), date_trunc('day', utcbegin) + INTERVAL 12 HOUR AS begin_utc
        FROM ev WHERE hour(utcbegin) >= 12)
  SELECT utcbegin, pricedate, hour, node_id, dalmp, damcc, damcl FROM u
  QUALIFY row_number() OVER (PARTITION BY node_id, utcbegin ORDER BY begin_utc DESC, ingest_seq DESC) = 1"""

ORACLE["quarantined_messages"] = """
  WITH m AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 = 0 AS bad_day FROM events)
  SELECT event_id AS ingest_seq,
         CASE WHEN event_type = 'purchase' THEN 'fetch' ELSE 'bad' END AS kind,
         CASE WHEN event_type = 'purchase' THEN 'rt_unverified_fivemin_lmps' END AS feed
  FROM m WHERE event_type IN ('error', 'purchase') OR (event_type = 'signup' AND bad_day)"""

ORACLE["stream_pending_merges"] = f"""
  SELECT event_id % 3 AS batch_id, 'rt_fivemin_hrl_lmps' AS feed, CAST({_ny(_floor5('ts'))} AS DATE) AS merge_date,
         count(*) AS n_requests
  FROM events WHERE event_type = 'signup' GROUP BY 1, 3"""

ORACLE["due_requests"] = f"""
  SELECT feed, pull_id, pricedate, not_before, message FROM ({ORACLE['next_requests']})
  WHERE not_before <= TIMESTAMP '2001-07-15 13:00:00'"""

ORACLE["list_files"] = f"""
  SELECT pull, start_row, CAST(1 AS BIGINT) AS n_files, true AS has_bytes FROM ({ORACLE['feed_source_plan']})"""

ORACLE["serving_rt"] = f"""
  WITH ev AS ({EV5})
  SELECT a.node, ev.utcbegin, ev.pricedate, ev.hour, ev.dalmp AS rtlmp, ev.damcc AS rtmcc, ev.damcl AS rtmcl, ev.ingest_seq
  FROM ev JOIN {TEST_ASSETS} ON ev.node_id = a.node_id
  QUALIFY row_number() OVER (PARTITION BY node, utcbegin ORDER BY ingest_seq DESC) = 1"""

ORACLE["landing_sequence"] = f"""{WITH_EV}
  SELECT * REPLACE (ingest_seq + (1 + ingest_seq % 4) * 4294967296 AS ingest_seq), 1 + ingest_seq % 4 AS landing
  FROM (SELECT {LAKE_COLS} FROM ev)"""

ORACLE["intake_mixed_types"] = f"{WITH_EV} SELECT {LAKE_COLS} FROM ev"

ORACLE["stream_mixed_types"] = f"""{WITH_EV}
  SELECT {LAKE_COLS} FROM ev QUALIFY row_number() OVER (PARTITION BY node_id, utcbegin ORDER BY ingest_seq DESC) = 1"""

ORACLE["stream_late_rows"] = f"""{WITH_EV}, p AS (SELECT {LAKE_COLS} FROM ev),
  w AS (SELECT * REPLACE (ingest_seq + 4294967296 AS ingest_seq) FROM p WHERE ingest_seq % 3 <> 0
        UNION ALL
        SELECT * REPLACE (CASE WHEN ingest_seq % 3 = 1 THEN dalmp + 1 ELSE dalmp END AS dalmp, ingest_seq + 8589934592 AS ingest_seq)
        FROM p WHERE ingest_seq % 3 <> 2)
  SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY node_id, utcbegin ORDER BY ingest_seq DESC) = 1"""


def _gaps(prices: str, step: int) -> str:
    return f"""SELECT node_id, utcbegin + INTERVAL {step} MINUTE AS gap_start, next - INTERVAL {step} MINUTE AS gap_end,
               CAST(date_diff('minute', utcbegin, next) / {step} AS BIGINT) - 1 AS n_missing
        FROM (SELECT node_id, utcbegin, lead(utcbegin) OVER (PARTITION BY node_id ORDER BY utcbegin) AS next
              FROM (SELECT DISTINCT node_id, utcbegin FROM ({prices})))
        WHERE next > utcbegin + INTERVAL {step} MINUTE"""


def _refills(name: str, prices: str) -> str:
    spec = FEEDS[name]
    return f"""SELECT '{name}' AS feed, unnest(generate_series(gap_start, gap_end, INTERVAL {spec.request_span_minutes} MINUTE)) AS begin_utc
        FROM ({_gaps(prices, spec.step_minutes)})"""


ORACLE["gap_ranges"] = _gaps(EV, 60)

ORACLE["refill_requests"] = f"""
  WITH b AS ({_refills('da_hrl_lmps', EV)} UNION ALL {_refills('rt_fivemin_hrl_lmps', EV5)})
  SELECT feed, begin_utc, count(*) AS n_gaps, replace(feed, '_', '') AS queue,
         '{{"begin_time_iso_str":"' || strftime(begin_utc, '%Y-%m-%dT%H:%M:%S')
           || '+0000","pjm_end_point":"' || feed || '","queue_next":false}}' AS message
  FROM b GROUP BY feed, begin_utc"""

#: Waves 0, 1 and 3 bring requests, wave 2 ends the merges of odd days among those of wave 0.
ORACLE["stream_merge_actions"] = f"""
  WITH a AS (SELECT 'rt_fivemin_hrl_lmps' AS feed, CAST({_ny(_floor5('ts'))} AS DATE) AS merge_date, count(*) AS n
             FROM events WHERE event_type = 'signup' GROUP BY 2),
  d AS (SELECT *, day(merge_date) % 5 <> 0 AS w0, day(merge_date) % 3 = 0 AS w1,
               day(merge_date) % 5 <> 0 AND day(merge_date) % 2 = 1 AS w2 FROM a)
  SELECT CAST(0 AS BIGINT) AS batch_id, feed, merge_date, 'start' AS action, n AS n_requests FROM d WHERE w0
  UNION ALL SELECT 1, feed, merge_date, 'start', n FROM d WHERE w1 AND NOT w0
  UNION ALL SELECT 2, feed, merge_date, 'rerun', n FROM d WHERE w0 AND w1 AND w2
  UNION ALL SELECT 3, feed, merge_date, 'start', n FROM d WHERE (w2 AND NOT w1) OR (NOT w0 AND NOT w1)"""

ORACLE["released_requests"] = f"""
  SELECT message, CAST(CASE WHEN not_before <= TIMESTAMP '2001-07-15 12:30:00' THEN 0
                            WHEN not_before <= TIMESTAMP '2001-07-15 13:00:00' THEN 1 ELSE 2 END AS BIGINT) AS release_id
  FROM ({ORACLE['next_requests']}) WHERE not_before <= TIMESTAMP '2001-07-20 00:00:00'"""

#: A request goes out in the wave that brings it, or in the first later one whose clock has reached its time.
ORACLE["stream_due_requests"] = f"""
  SELECT message, CAST(greatest(day(pricedate) % 3, CASE WHEN not_before <= TIMESTAMP '2001-07-15 12:30:00' THEN 0
                                                         WHEN not_before <= TIMESTAMP '2001-07-15 13:00:00' THEN 1 ELSE 2 END) AS BIGINT) AS wave
  FROM ({ORACLE['next_requests']}) WHERE not_before <= TIMESTAMP '2001-07-20 00:00:00'"""

ORACLE["versioned_day_merge"] = f"""
  {WITH_EV}, p AS (SELECT {LAKE_COLS} FROM ev),
  old AS (SELECT * FROM p WHERE ingest_seq % 2 = 0 QUALIFY row_number() OVER (PARTITION BY node_id, utcbegin ORDER BY ingest_seq DESC) = 1),
  new AS (SELECT * REPLACE (CASE WHEN ingest_seq % 2 = 1 THEN ingest_seq + 4294967296 ELSE ingest_seq END AS ingest_seq) FROM p)
  SELECT *, CAST(1 AS BIGINT) AS version FROM old
  UNION ALL
  SELECT *, 2 FROM (SELECT * FROM new QUALIFY row_number() OVER (PARTITION BY node_id, utcbegin ORDER BY ingest_seq DESC) = 1)"""

ORACLE["node_set_inventory"] = f"{WITH_EV} SELECT DISTINCT pricedate, node_id FROM ev"

ORACLE["node_set_carried_over"] = f"""{WITH_EV}
  SELECT DISTINCT pricedate, node_id FROM ev WHERE ingest_seq % 2 = 0 AND pricedate IN (SELECT pricedate FROM ev WHERE ingest_seq % 2 = 1)
  EXCEPT
  SELECT DISTINCT pricedate, node_id FROM ev WHERE ingest_seq % 2 = 1"""

ORACLE["node_set_lookup"] = f"""
  SELECT * EXCLUDE (version) FROM ({ORACLE['versioned_day_merge']}) WHERE version = 2 AND node_id IN (SELECT node_id FROM {TEST_ASSETS})"""

ORACLE["stream_cursor_limited"] = ORACLE["stream_cursor"]
