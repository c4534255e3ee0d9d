"""The fixture formulas in SQL, as common table expressions for the checks."""

CHAIN_SQL = """
WITH steps AS (
  SELECT * FROM (VALUES
    ('plain', 1, 0, 0),
    ('replaced', 1, 0, 0), ('replaced', -1, 0, 1), ('replaced', 1, 1, 1),
    ('orphaned', 1, 0, 0), ('orphaned', -1, 0, 1),
    ('dup_revert', 1, 0, 0), ('dup_revert', -1, 0, 1), ('dup_revert', -1, 0, 2)
  ) v(class, sign, fork, step)
),
base_tx AS (
  SELECT event_id // 10 AS block_number, event_id % 10 AS tx_index,
         sha256('tx:' || event_id) AS tx_hash,
         lpad(lower(to_hex(user_id)), 40, '0') AS "from",
         CASE WHEN event_type <> 'signup' THEN lpad(lower(to_hex(4096 + (event_id * 7919) % 40)), 40, '0') END AS "to",
         CAST(CAST(round(value * 100) AS HUGEINT) * 10000000000000000 AS VARCHAR) AS value,
         lower(hex(event_type)) AS input,
         CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS status,
         event_id AS nonce,
         21000 + (event_id % 13) * 7000 AS gas_used, 21000 + (event_id % 13) * 10000 AS gas_limit,
         (20 + event_id % 31) * 1000000000 AS gas_price,
         CASE WHEN event_id % 3 <> 0 THEN (25 + event_id % 31) * 1000000000
              ELSE (20 + event_id % 31) * 1000000000 END AS max_fee_per_gas,
         CASE WHEN event_id % 3 <> 0 THEN 2000000000 END AS max_priority_fee_per_gas,
         1 AS chain_id
  FROM events
),
headers AS (
  SELECT event_id // 10 AS block_number, date_trunc('second', min(ts)) AS timestamp,
         CAST(sum(21000 + (event_id % 13) * 7000) AS BIGINT) AS gas_used
  FROM events GROUP BY 1
),
classed AS (
  SELECT block_number, CASE WHEN block_number % 17 = 3 THEN 'replaced' WHEN block_number % 53 = 7 THEN 'orphaned'
                            WHEN block_number % 211 = 11 THEN 'dup_revert' ELSE 'plain' END AS class
  FROM headers
),
marks AS (
  SELECT block_number, sign, fork, (block_number * 4 + step) * 2 + CASE WHEN sign = 1 THEN 1 ELSE 0 END AS seq
  FROM classed JOIN steps USING (class)
),
blocks AS (
  SELECT h.block_number, sign, sha256('block:' || h.block_number || ':' || fork) AS hash,
         sha256('block:' || (h.block_number - 1) || ':' || CASE WHEN (h.block_number - 1) % 17 = 3 THEN 1 ELSE 0 END) AS parent_hash,
         timestamp, gas_used, 30000000 AS gas_limit,
         10000000000 + (h.block_number % 200) * 100000000 AS base_fee,
         lpad(lower(to_hex(160 + h.block_number % 7)), 40, '0') AS miner,
         sha256('root:' || h.block_number) AS state_root,
         lower(hex('block_' || h.block_number)) AS extra_data, seq
  FROM headers h JOIN marks m ON h.block_number = m.block_number
),
transactions AS (
  SELECT t.*, sign, seq FROM base_tx t JOIN marks m ON t.block_number = m.block_number
  WHERE fork = 0 OR tx_index <> 9
),
folded AS (
  SELECT *, l_orderkey % (SELECT max(event_id) + 1 FROM events) AS event_id FROM lineitem
),
base_logs AS (
  SELECT event_id // 10 AS block_number, event_id % 10 AS tx_index,
         row_number() OVER (PARTITION BY event_id // 10 ORDER BY event_id % 10, l_orderkey, l_linenumber, l_partkey,
                            l_suppkey, l_extendedprice, l_shipdate) - 1 AS log_index,
         sha256('tx:' || event_id) AS tx_hash,
         lpad(lower(to_hex(49152 + l_suppkey % 5)), 40, '0') AS address,
         CASE WHEN l_returnflag IN ('A', 'R')
              THEN 'ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef' ELSE sha256('other') END AS topic0,
         lpad(lower(to_hex(l_partkey % 20 + 1)), 64, '0') AS topic1,
         lpad(lower(to_hex(l_suppkey % 20 + 1)), 64, '0') AS topic2,
         CASE WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN lpad(lower(to_hex(l_partkey)), 64, '0') END AS topic3,
         lpad(lower(to_hex(CAST(round(l_extendedprice * 100) AS BIGINT))), 52, '0') || '000000000000' AS data,
         CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS HUGEINT) * 281474976710656 AS amount,
         lpad(lower(to_hex(l_partkey % 8)), 64, '0') AS slot,
         l_partkey AS token_id
  FROM folded
),
logs AS (
  SELECT l.*, sign, seq FROM base_logs l JOIN marks m ON l.block_number = m.block_number
  WHERE fork = 0 OR tx_index <> 9
),
storage_diffs AS (
  SELECT block_number, sign, address, slot, arg_max(data, log_index) AS value, seq
  FROM logs GROUP BY block_number, sign, address, slot, seq
),
head AS (SELECT max(block_number) AS n FROM blocks WHERE sign = 1),
final_blocks AS (
  SELECT b.* FROM blocks b JOIN (SELECT block_number, hash, sum(sign) AS net, max(seq) FILTER (WHERE sign = 1) AS seq
                                 FROM blocks GROUP BY 1, 2) k
    ON b.block_number = k.block_number AND b.hash = k.hash AND b.seq = k.seq WHERE net > 0
),
final_transactions AS (
  SELECT b.* FROM transactions b JOIN (SELECT block_number, tx_hash, sum(sign) AS net, max(seq) FILTER (WHERE sign = 1) AS seq
                                 FROM transactions GROUP BY 1, 2) k
    ON b.block_number = k.block_number AND b.tx_hash = k.tx_hash AND b.seq = k.seq WHERE net > 0
),
final_logs AS (
  SELECT b.* FROM logs b JOIN (SELECT block_number, tx_hash, log_index, sum(sign) AS net, max(seq) FILTER (WHERE sign = 1) AS seq
                                 FROM logs GROUP BY 1, 2, 3) k
    ON b.block_number = k.block_number AND b.tx_hash = k.tx_hash AND b.log_index = k.log_index AND b.seq = k.seq WHERE net > 0
),
final_diffs AS (
  SELECT b.* FROM storage_diffs b JOIN (SELECT block_number, address, slot, sum(sign) AS net, max(seq) FILTER (WHERE sign = 1) AS seq
                                 FROM storage_diffs GROUP BY 1, 2, 3) k
    ON b.block_number = k.block_number AND b.address = k.address AND b.slot = k.slot AND b.seq = k.seq WHERE net > 0
),
metrics AS (
  SELECT ts, 'events_total_' || event_type AS name,
         CAST((row_number() OVER (PARTITION BY event_type ORDER BY event_id)) % 500 AS DOUBLE) AS value FROM events
  UNION ALL SELECT ts, 'buffer_rows', round(value) FROM events
  UNION ALL SELECT ts, 'latency_seconds', value / 1000 FROM events
)
"""
