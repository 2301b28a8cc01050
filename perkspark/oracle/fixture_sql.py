"""DuckDB text of the raw fixture relations (same formulas as
``perkspark.sources.fixtures``), the first CTEs of every oracle query.

The warehouse tables ``customer``, ``part`` and ``events`` are views in the
oracle's DuckDB connection.  The raw loyalty events are named
``loyalty_events`` to keep them apart from the warehouse ``events`` table.
"""

from __future__ import annotations

# --- fixed values: channel lists and printed dictionaries, as in the programme ---
RAW_CTES = {
    "customers": """
SELECT 'c' || CAST(c_custkey AS VARCHAR) AS customer_id,
       CAST((c_custkey % 6 + 2013) * 10000 + (c_custkey % 12 + 1) * 100 + (c_custkey % 28 + 1) AS INTEGER)
         AS became_member_on,
       CASE WHEN c_custkey % 8 = 0 OR c_custkey % 11 = 0 THEN NULL
            WHEN c_custkey % 3 = 0 THEN 'F' WHEN c_custkey % 3 = 1 THEN 'M' ELSE 'O' END AS gender,
       CAST(CASE WHEN c_custkey % 8 = 0 THEN 118 ELSE c_custkey % 90 + 16 END AS INTEGER) AS age,
       CAST(CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_acctbal < 0 THEN c_acctbal
                 ELSE c_acctbal * 10 + 30000 END AS DOUBLE) AS income
FROM customer""",
    "offers": """
SELECT 'o' || CAST(p_partkey AS VARCHAR) AS offer_id,
       CASE WHEN p_partkey % 5 <= 1 THEN 'bogo' WHEN p_partkey % 5 <= 3 THEN 'discount'
            ELSE 'informational' END AS offer_type,
       CAST(CASE WHEN p_partkey % 5 = 4 THEN 0 ELSE (p_partkey % 4 + 1) * 5 END AS INTEGER) AS difficulty,
       CAST(CASE WHEN p_partkey % 5 = 4 THEN 0 WHEN p_partkey % 5 <= 1 THEN (p_partkey % 4 + 1) * 5
                 ELSE p_partkey % 4 + 2 END AS INTEGER) AS reward,
       CAST(p_partkey % 8 + 3 AS INTEGER) AS duration,
       CASE p_partkey % 4 WHEN 0 THEN '[''email'', ''mobile'', ''social'']'
                          WHEN 1 THEN '[''web'', ''email'', ''mobile'', ''social'']'
                          WHEN 2 THEN '[''web'', ''email'']'
                          ELSE '[''web'', ''email'', ''mobile'']' END AS channels
FROM part""",
    "loyalty_events_k": """
SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CASE WHEN event_type = 'signup' THEN 'offer received'
            WHEN event_type IN ('view', 'error') THEN 'offer viewed'
            WHEN event_type = 'click' AND TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 = 4
              THEN 'offer viewed'
            WHEN event_type = 'click' THEN 'offer completed'
            WHEN event_type = 'purchase' THEN 'transaction'
            ELSE event_type END AS ev
FROM events""",
    "loyalty_events": """
SELECT 'c' || CAST(user_id AS VARCHAR) AS customer_id,
       ev AS event,
       CASE WHEN event_type = 'error' THEN '{}'
            WHEN ev IN ('offer received', 'offer viewed')
              THEN '{''offer id'': ''o' || CAST(k AS VARCHAR) || '''}'
            WHEN ev = 'offer completed'
              THEN '{''offer_id'': ''o' || CAST(k AS VARCHAR)
                   || ''', ''reward'': ' || CAST(k % 4 + 2 AS VARCHAR) || '}'
            WHEN event_id % 2 = 0 THEN '{"amount": ' || CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR) || '}'
            ELSE '{''amount'': ' || CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR) || '}'
       END AS value,
       CAST(date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts)
            + CASE WHEN ev = 'offer viewed' THEN 24 ELSE 0 END
            + CASE WHEN ev = 'offer completed' THEN 168 ELSE 0 END AS INTEGER) AS time
FROM loyalty_events_k""",
}

