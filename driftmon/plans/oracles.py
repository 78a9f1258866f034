"""The same results in plain SQL, for an independent engine on the same tables."""

POINTS = """
points AS (
  SELECT lpad(CAST(l_orderkey AS VARCHAR), 12, '0')
      || '-' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0')
      || '-' || lpad(CAST(l_partkey AS VARCHAR), 11, '0')
      || '-' || lpad(CAST(l_suppkey AS VARCHAR), 10, '0')
      || '-' || strftime(l_shipdate, '%Y%m%d') AS id,
    l_shipdate AS "timestamp",
    l_quantity / 5 AS feature_0,
    l_extendedprice / 10500 AS feature_1,
    l_discount * 100 AS feature_2,
    (l_orderkey * 7 + l_partkey * 13 + l_suppkey * 3 + l_linenumber) % 10 = 0 AS noisy
  FROM lineitem),
blocks AS (
  SELECT *, ntile(4) OVER (ORDER BY "timestamp", id) AS blk FROM points)"""

SEA = f"""{POINTS},
concepts AS (
  SELECT *, feature_0 + feature_1 <= CASE blk WHEN 1 THEN 8.0::DOUBLE WHEN 2 THEN 9.0::DOUBLE
    WHEN 3 THEN 7.0::DOUBLE ELSE 9.5::DOUBLE END AS is_clean FROM blocks),
sea AS (
  SELECT id, "timestamp", feature_0, feature_1, feature_2, noisy, blk,
    CAST(is_clean AS DOUBLE) AS clean,
    CAST(is_clean <> noisy AS DOUBLE) AS label,
    CAST(feature_0 + feature_1 <= 8.0::DOUBLE AS DOUBLE) AS hard,
    -(feature_0 + feature_1) AS rank_score
  FROM concepts)"""

STEPS = f"""{POINTS},
bounded AS (
  SELECT id, "timestamp", round(feature_0 * 5) AS feature_0, round(feature_2) AS feature_1,
    1.0::DOUBLE AS feature_2, blk,
    CASE blk WHEN 1 THEN 25 WHEN 2 THEN 35 WHEN 3 THEN 25 ELSE 40 END AS bound
  FROM blocks),
steps AS (
  SELECT id, "timestamp", feature_0, feature_1, feature_2, blk,
    CAST(feature_0 <= bound AS DOUBLE) AS label, CAST(feature_0 <= 25 AS DOUBLE) AS hard
  FROM bounded)"""

EVENTS = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS id, ts AS "timestamp", value AS feature_0,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS feature_1,
    CAST(user_id AS DOUBLE) AS feature_2,
    CAST(event_type = 'error' AS DOUBLE) AS label
  FROM events)"""

RUN_LOG = """
runs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_custkey AS model, o_orderdate AS start_time,
    CASE WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'FINISHED' END AS status,
    CASE WHEN o_orderstatus = 'P' THEN NULL
      WHEN o_orderpriority = '1-URGENT' THEN 'NaN'::DOUBLE
      ELSE o_totalprice / 1000000 END AS auc
  FROM orders)"""

RECORD = 'id, "timestamp", feature_0, feature_1, feature_2, label'
STORED = """id, {time} AS "timestamp",
  CAST(CAST(feature_0 AS FLOAT) AS DOUBLE) AS feature_0,
  CAST(CAST(feature_1 AS FLOAT) AS DOUBLE) AS feature_1,
  CAST(CAST(feature_2 AS FLOAT) AS DOUBLE) AS feature_2, label"""


def _auc(source: str, by: str = "") -> str:
    """CTEs ending in `areas`, from `source` with columns score and label."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
scores AS (
  SELECT {keys}score, count(*) FILTER (WHERE label > 0.5) AS pos,
    count(*) FILTER (WHERE label <= 0.5) AS neg
  FROM {source} GROUP BY {keys}score),
running AS (
  SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY score
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM scores),
totals AS (
  SELECT {keys}CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(neg) AS BIGINT) AS neg,
    sum(pos * (2 * below + neg)) AS area FROM running {group}),
areas AS (
  SELECT {keys}pos, neg, CAST(0 AS BIGINT) AS dropped,
    CASE WHEN pos > 0 AND neg > 0
      THEN CAST(area AS DOUBLE) / CAST(2 * CAST(pos AS HUGEINT) * neg AS DOUBLE) END AS auc
  FROM totals)"""


def _block_aucs(score: str, points: str = SEA, table: str = "sea") -> str:
    return f"""{points},
scored AS (SELECT blk, {score} AS score, label FROM {table}),{_auc("scored", "blk")},
verdicts AS (
  SELECT blk, (SELECT auc FROM areas WHERE blk = 1) AS train_auc, auc AS test_auc,
    abs(auc - (SELECT auc FROM areas WHERE blk = 1)) > 0.05::DOUBLE AS drift FROM areas)"""


def _block_rmse(points: str, table: str) -> str:
    return f"""{points},
errors AS (
  SELECT blk, sqrt(avg((label - hard) * (label - hard))) AS rmse FROM {table} GROUP BY blk),
verdicts AS (
  SELECT blk, (SELECT rmse FROM errors WHERE blk = 1) AS train_rmse, rmse AS test_rmse,
    rmse > (SELECT rmse FROM errors WHERE blk = 1) * 1.1::DOUBLE AS drift FROM errors)"""


BLOCK_RMSE = _block_rmse(SEA, "sea")
# The two streamed blocks of the cycle, judged together.
STREAMED = f"""{STEPS},
scored AS (SELECT hard AS score, label FROM steps WHERE blk IN (2, 3)),{_auc("scored")}"""
CYCLED = 'SELECT id, "timestamp", feature_0, feature_1, feature_2, label FROM steps WHERE blk < 4'

VERDICT_ROWS = f"""WITH {_block_aucs("hard")},
rows_out AS (
  SELECT id, label, hard AS prediction, feature_0, feature_1, feature_2, "timestamp",
    train_auc, test_auc, drift
  FROM sea JOIN verdicts USING (blk))"""

LATEST_ITEMS = """
SELECT * EXCLUDE (version)
FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS version FROM lineitem)
WHERE version = 1"""

WINDOWS = f"""WITH {EVENTS},
scored AS (
  SELECT date_trunc('day', "timestamp") AS window_start, feature_0 AS score, label,
    FROM ev),{_auc("scored", "window_start")},
windows AS (
  SELECT CAST(window_start AS TIMESTAMP) AS window_start,
    CAST(window_start AS TIMESTAMP) + INTERVAL 1 DAY AS window_end, pos, neg, dropped,
    0.5::DOUBLE AS train_auc, auc AS test_auc,
    abs(auc - 0.5::DOUBLE) > 0.05::DOUBLE AS drift
  FROM areas)"""

ORACLES = {
    "json_encode": f"""WITH {EVENTS}
SELECT '{{"id":"' || id || '","timestamp":"' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f')
  || '","feature_0":' || CAST(feature_0 AS VARCHAR)
  || ',"feature_1":' || CAST(feature_1 AS VARCHAR)
  || ',"feature_2":' || CAST(feature_2 AS VARCHAR)
  || ',"label":' || CAST(label AS VARCHAR) || '}}' AS value
FROM ev""",
    "json_decode": f"WITH {EVENTS} SELECT " + STORED.format(time='"timestamp"') + " FROM ev",
    "decode_rejects": f"WITH {SEA} SELECT id AS sent_id FROM sea WHERE noisy",
    "round_features": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
  round(l_extendedprice / 7, 3) AS feature_1 FROM lineitem""",
    "iso_timestamp": """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS emitted_at FROM events""",
    "sink_coerce": f"""WITH {EVENTS},
hashed AS (SELECT * REPLACE (
  substr(md5(id), 1, 8) || '-' || substr(md5(id), 9, 4) || '-' || substr(md5(id), 13, 4)
  || '-' || substr(md5(id), 17, 4) || '-' || substr(md5(id), 21, 12) AS id) FROM ev)
SELECT """
    + STORED.format(time="date_trunc('millisecond', \"timestamp\")")
    + ", TRUE AS valid_id FROM hashed",
    "upsert_latest": LATEST_ITEMS,
    "table_scan_latest": LATEST_ITEMS,
    "clustered_newest_first": """
SELECT event_id, user_id, date_trunc('millisecond', ts) AS ts, TRUE AS in_order FROM events""",
    "csv_load": f"WITH {SEA} SELECT "
    + STORED.format(time='"timestamp"')
    + " FROM sea WHERE NOT noisy",
    "csv_rejects": f"""WITH {SEA}
SELECT "timestamp", CAST(CAST(feature_1 AS FLOAT) AS DOUBLE) AS feature_1 FROM sea WHERE noisy""",
    "catalog_latest": f"WITH {EVENTS} SELECT "
    + STORED.format(time="date_trunc('millisecond', \"timestamp\")").replace(
        ", label", ", CASE WHEN label = 1 THEN 2.0::DOUBLE ELSE label END AS label"
    )
    + " FROM ev",
    "catalog_after_promote": f"""WITH {EVENTS}, stored AS (
  SELECT * REPLACE (CAST(CASE WHEN CAST(id AS BIGINT) % 3 = 2 THEN 2
    WHEN label = 1 THEN CAST(id AS BIGINT) % 3 + 1 ELSE CAST(id AS BIGINT) % 3 END AS DOUBLE) AS label) FROM ev)
SELECT """
    + STORED.format(time="date_trunc('millisecond', \"timestamp\")")
    + " FROM stored WHERE label > 0",
    "compacted_scan": LATEST_ITEMS,
    "reclaimed_scan": LATEST_ITEMS,
    "reject_bad_ids": f"""WITH {EVENTS}
SELECT CASE WHEN label = 1 THEN id ELSE
  substr(md5(id), 1, 8) || '-' || substr(md5(id), 9, 4) || '-' || substr(md5(id), 13, 4)
  || '-' || substr(md5(id), 17, 4) || '-' || substr(md5(id), 21, 12) END AS id,
  label <> 1 AS stored FROM ev""",
    "promote_test_to_train": f"""WITH {SEA}
SELECT id, "timestamp", feature_0, feature_1, feature_2,
  CASE WHEN "timestamp" >= TIMESTAMP '1997-07-01' THEN label ELSE clean END AS label
FROM sea WHERE "timestamp" < TIMESTAMP '2000-01-01'""",
    "remaining_after_promote": f"""WITH {SEA}
SELECT {RECORD} FROM sea WHERE "timestamp" >= TIMESTAMP '2000-01-01'""",
    "arff_scan": f"""WITH {SEA}
SELECT row_number() OVER (ORDER BY "timestamp", id) - 1 AS idx,
  feature_0, feature_1, feature_2, label FROM sea""",
    "source_slice": f"""WITH {SEA}, placed AS (
  SELECT row_number() OVER (ORDER BY "timestamp", id) - 1 AS idx, * FROM sea)
SELECT idx, feature_0, feature_1, feature_2, label,
  CASE WHEN idx < 10 THEN 0 WHEN idx < 1000 THEN 10 ELSE 1000 END AS slice FROM placed""",
    "drift_sources": f"""WITH {SEA}
SELECT row_number() OVER (PARTITION BY blk ORDER BY "timestamp", id) - 1 AS idx,
  feature_0, feature_1, feature_2, label, CAST(blk AS INTEGER) AS drift_type FROM sea""",
    "slice_stream": f"""WITH {SEA}, placed AS (
  SELECT row_number() OVER (ORDER BY "timestamp", id) - 1 AS idx, count(*) OVER () AS n, * FROM sea)
SELECT idx, feature_0, feature_1, feature_2, label, idx // ((n + 2) // 3) AS slice FROM placed""",
    "row_number_by_time": f"""WITH {EVENTS}
SELECT id, "timestamp", label, row_number() OVER (ORDER BY "timestamp", id) AS row_num FROM ev""",
    "history_count": """
SELECT count(*) AS "rows", epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events""",
    "chrono_split": f"""WITH {SEA}
SELECT id, "timestamp", row_number() OVER (ORDER BY "timestamp", id)
  <= CAST(floor((SELECT count(*) FROM points) * 0.7::DOUBLE) AS BIGINT) AS in_train
FROM points""",
    "split_sizes": f"""WITH {EVENTS}, placed AS (
  SELECT *, row_number() OVER (ORDER BY "timestamp", id)
    <= CAST(floor((SELECT count(*) FROM ev) * 0.7::DOUBLE) AS BIGINT) AS early FROM ev)
SELECT CASE WHEN early THEN 'train' ELSE 'test' END AS part, count(*) AS "rows",
  min("timestamp") AS first_time, max("timestamp") AS last_time FROM placed GROUP BY early""",
    "auc_exact": f"""WITH {EVENTS},
scored AS (SELECT feature_0 AS score, label FROM ev),{_auc("scored")}
SELECT * FROM areas""",
    "auc_by_block": f"""WITH {SEA},
scored AS (
  SELECT 'hard' AS scorer, blk, hard AS score, label FROM sea
  UNION ALL SELECT 'rank', blk, rank_score, label FROM sea),{_auc("scored", "scorer, blk")}
SELECT * FROM areas""",
    "auc_drift_by_block": f"WITH {_block_aucs('hard')} SELECT * FROM verdicts",
    "auc_drift_by_rank_score": f"WITH {_block_aucs('rank_score')} SELECT * FROM verdicts",
    "auc_drift_by_window": f"{WINDOWS} SELECT * FROM windows",
    "rmse": f"""WITH {SEA}
SELECT count(*) AS "rows", round(sqrt(avg((label - hard) * (label - hard))), 9) AS rmse
FROM sea""",
    "rmse_drift_by_block": f"""WITH {BLOCK_RMSE}
SELECT blk, round(train_rmse, 9) AS train_rmse, round(test_rmse, 9) AS test_rmse, drift
FROM verdicts""",
    "rmse_conditional_rows": f"""WITH {_block_rmse(STEPS, "steps")}
SELECT id, TIMESTAMP '2024-04-12' + to_days(CAST(blk AS INTEGER)) AS test_timestamp, label,
  hard AS prediction, feature_0, feature_1, feature_2, "timestamp"
FROM steps JOIN verdicts USING (blk) WHERE drift""",
    "verdict_table": f"{VERDICT_ROWS} SELECT * FROM rows_out",
    "verdict_retest": f"""WITH {_block_aucs("hard")}
SELECT id, label, hard AS prediction, "timestamp",
  CAST(CAST(feature_0 AS FLOAT) AS DOUBLE) AS feature_0,
  CAST(CAST(feature_1 AS FLOAT) AS DOUBLE) AS feature_1,
  CAST(CAST(feature_2 AS FLOAT) AS DOUBLE) AS feature_2,
  CAST(CAST(train_auc AS FLOAT) AS DOUBLE) AS train_auc,
  CAST(CAST(test_auc AS FLOAT) AS DOUBLE) AS test_auc,
  abs(test_auc - train_auc) > CASE WHEN blk > 2 THEN 0.05::DOUBLE ELSE 0.08::DOUBLE END AS drift
FROM sea JOIN verdicts USING (blk)""",
    "panel_drift_series": f"""{VERDICT_ROWS}
SELECT "timestamp", CAST(drift AS INTEGER) AS drift FROM rows_out""",
    "panel_feature_series": f"""WITH {EVENTS}
SELECT "timestamp", feature_0 FROM ev ORDER BY "timestamp" DESC, id LIMIT 100""",
    "alerts": f"""WITH {_block_aucs("hard")}
SELECT *, 'drift: the metric left its allowed range' AS message FROM verdicts WHERE drift""",
    "latest_run": f"""WITH {RUN_LOG}
SELECT run_id, start_time, status FROM runs ORDER BY start_time DESC, run_id DESC LIMIT 1""",
    "latest_usable_run": f"""WITH {RUN_LOG}
SELECT run_id, start_time, status, auc FROM runs WHERE auc IS NOT NULL AND NOT isnan(auc)
ORDER BY start_time DESC, run_id DESC LIMIT 1""",
    "distinct_test_runs": f"""WITH {RUN_LOG}
SELECT count(DISTINCT start_time) AS runs FROM runs""",
    "retrain_gate": f"""WITH {RUN_LOG}
SELECT model, count(DISTINCT start_time) AS runs, count(DISTINCT start_time) >= 3 AS ready
FROM runs GROUP BY model""",
    "run_log_roundtrip": f"""WITH {RUN_LOG}
SELECT run_id, start_time, status, CASE WHEN isnan(auc) THEN -1 ELSE auc END AS auc FROM runs""",
    "class_spread": f"""WITH {SEA}
SELECT label, count(*) AS "rows", CAST(4 AS BIGINT) AS parts, TRUE AS even FROM sea GROUP BY label""",
    "gbt_train_test": f"""WITH {_block_aucs("hard", STEPS, "steps")}
SELECT blk, id, label, hard AS prediction, feature_0, feature_1, feature_2, "timestamp",
  train_auc, test_auc, drift FROM steps JOIN verdicts USING (blk)""",
    "gbt_score": f"""WITH {STEPS}
SELECT id, "timestamp", label, hard AS prediction, hard = 1 AS positive, hard = 1 AS likely,
  1.0::DOUBLE AS train_auc FROM steps""",
    "gbt_regressor": f"""WITH {_block_rmse(STEPS, "steps")}
SELECT blk, round(train_rmse, 9) AS train_rmse, round(test_rmse, 9) AS test_rmse, drift,
  0.0::DOUBLE AS stored_rmse FROM verdicts""",
    "cycle_history": f"WITH {STEPS} {CYCLED}",
    "cycle_remaining": f"WITH {STEPS} {CYCLED}".replace("blk < 4", "blk = 4"),
    "cycle_verdicts": f"""WITH {STREAMED}
SELECT id, label, hard AS prediction, feature_0, feature_1, feature_2, "timestamp",
  1.0::DOUBLE AS train_auc, CAST(CAST(auc AS FLOAT) AS DOUBLE) AS test_auc,
  abs(auc - 1) > 0.05::DOUBLE AS drift
FROM steps, areas WHERE blk IN (2, 3)""",
    "rmse_cycle": f"WITH {STEPS} {CYCLED}".replace(
        ", label FROM", ", label, 'promote:1,test:3,train:1' AS kinds FROM"
    ),
    "rmse_alerts": f"""WITH {STEPS}
SELECT 'rmse' AS metric, 0.0::DOUBLE AS baseline,
  round(sqrt(avg((label - hard) * (label - hard))), 6) AS measured,
  'drift: the metric left its allowed range' AS message
FROM steps, range(3) WHERE blk IN (2, 3) GROUP BY range""",
    "stream_ingest": f"WITH {EVENTS} SELECT "
    + STORED.format(time="date_trunc('millisecond', \"timestamp\")")
    + " FROM ev",
    "consumer_lag": f"""WITH {EVENTS}
SELECT consumer, count(*) AS messages,
  count(*) FILTER (WHERE consumer = 'late' OR (consumer = 'audit' AND label <> 1)) AS behind
FROM ev, (VALUES ('audit'), ('store'), ('late')) AS c(consumer) GROUP BY consumer""",
    "monitor_spells": f"""{WINDOWS}, closed AS (
  SELECT *, coalesce(abs(test_auc - train_auc) > 0.01::DOUBLE, false) AS moved FROM windows
  WHERE window_end <= (SELECT max("timestamp") FROM ev) - INTERVAL 10 MINUTE),
islands AS (
  SELECT *, sum(CASE WHEN moved THEN 0 ELSE 1 END) OVER (ORDER BY window_start) AS island,
    max(window_end) OVER () AS last FROM closed)
SELECT min(window_start) AS "begin", max(window_end) AS "end", count(*) AS windows,
  round(max(abs(test_auc - train_auc)), 9) AS worst, max(window_end) = max(last) AS open
FROM islands WHERE moved GROUP BY island""",
    "stream_monitor": f"""{WINDOWS} SELECT * FROM windows
WHERE window_end <= (SELECT max("timestamp") FROM ev) - INTERVAL 10 MINUTE""",
}
