"""DuckDB text per registered query name (see ``perkspark.plans.registry``)."""

from __future__ import annotations

from perkspark.oracle.sql import exact_mean, r2, with_layers

_V_CHANNEL = """
SELECT channel, total_offers_sent, offers_completed, completion_rate, total_revenue_generated, effectiveness_rank,
       CASE WHEN completion_rate >= 50 THEN 'High' WHEN completion_rate >= 30 THEN 'Medium' ELSE 'Low' END
         AS performance_level
FROM channel_effectiveness"""
# members by age group, straight from their profiles; the mean income is that of the (one or two) means by status
_V_AGE = f"""
SELECT age_group, COUNT(*) FILTER (WHERE completer) AS completed_count, COUNT(*) FILTER (WHERE NOT completer) AS not_completed_count,
       list_avg([{exact_mean("CASE WHEN completer THEN income END")}, {exact_mean("CASE WHEN NOT completer THEN income END")}]) AS avg_income,
       COUNT(*) AS total_customers, {r2("100.0 * COUNT(*) FILTER (WHERE completer) / COUNT(*)")} AS completion_rate
FROM profile_valid GROUP BY age_group"""
# journeys by type and channel, then the unweighted mean over the type's channels
_V_OFFER = f"""
SELECT offer_type, {r2("AVG(CAST(rate AS DECIMAL(10,2)))")} AS avg_completion_rate, {r2("AVG(CAST(mean_hours AS DECIMAL(12,2)))")} AS avg_completion_time,
       CAST(SUM(n_done) AS BIGINT) AS total_completions, CAST(SUM(n_got) AS BIGINT) AS total_received
FROM (SELECT offer_type, channel, COUNT(*) FILTER (WHERE done) AS n_done, COUNT(*) FILTER (WHERE got) AS n_got,
             {r2("100 * COUNT(*) FILTER (WHERE done) / COUNT(*) FILTER (WHERE got)")} AS rate, {r2("AVG(hours) FILTER (WHERE done)")} AS mean_hours
      FROM facts_on_channel GROUP BY offer_type, channel HAVING bool_or(done) AND bool_or(got))
GROUP BY offer_type"""


def _matrix(measure: str) -> str:
    """All channels of the metric table as columns; without a name: ``unnamed``."""
    cells = f"SELECT offer_type, CASE WHEN channel = '' THEN 'unnamed' ELSE channel END AS channel, {measure} AS cell FROM offer_completion_metrics"
    return f"SELECT * FROM (PIVOT ({cells}) ON channel USING first(cell) GROUP BY offer_type)"


_AUDIT_TABLES = [
    ("bronze", "customers", "customers"),
    ("bronze", "offers", "offers"),
    ("bronze", "events", "loyalty_events"),
    ("silver", "customers_cleansed", "customers_cleansed"),
    ("silver", "offers_enriched", "offers_enriched"),
    ("silver", "events_processed", "events_processed"),
    ("silver", "offer_interactions", "offer_interactions"),
    ("gold", "channel_effectiveness", "channel_effectiveness"),
    ("gold", "age_distribution_analysis", "age_distribution_analysis"),
    ("gold", "offer_completion_metrics", "offer_completion_metrics"),
    ("gold", "v_channel_performance", f"({_V_CHANNEL})"),
    ("gold", "v_age_summary", f"({_V_AGE})"),
    ("gold", "v_offer_summary", f"({_V_OFFER})"),
]
_AUDIT = "\nUNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, COUNT(*) AS row_count FROM {src} AS t"
    for layer, name, src in _AUDIT_TABLES
) + """
UNION ALL SELECT 'quality', 'customers_not_valid', COUNT(*) FROM customers_cleansed WHERE data_quality_flag <> 'valid'
UNION ALL SELECT 'quality', 'offer_events_unparsed', COUNT(*) FROM events_processed
  WHERE event_type IN ('offer received', 'offer viewed', 'offer completed') AND offer_id IS NULL"""

_SELECTS: dict[str, str] = {
    "raw_customers": "SELECT * FROM customers",
    "raw_offers": "SELECT * FROM offers",
    "raw_events": "SELECT * FROM loyalty_events",
    "customers_cleansed": """
SELECT * REPLACE (strftime(membership_date, '%Y-%m-%d') AS membership_date) FROM customers_cleansed""",
    "customer_quality_counts": """
SELECT data_quality_flag, COUNT(*) AS customers FROM customers_cleansed GROUP BY data_quality_flag""",
    "offers_enriched": """
SELECT offer_id, offer_type, difficulty, reward, duration, duration_hours,
       array_to_string(channels_list, ',') AS channels_list, num_channels, is_multichannel, roi_ratio
FROM offers_enriched""",
    "offer_channels": """
SELECT DISTINCT offer_id, channel FROM (SELECT offer_id, unnest(channels_list) AS channel FROM offers_enriched)
WHERE channel <> ''""",
    "events_parsed": """
SELECT * REPLACE (strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
                  strftime(event_date, '%Y-%m-%d') AS event_date)
FROM events_processed""",
    "event_value_extract": f"""
SELECT event_type, COUNT(*) AS events, COUNT(offer_id) AS with_offer_id,
       CAST(SUM(CASE WHEN offer_id IS NULL AND starts_with(event_type, 'offer ') THEN 1 ELSE 0 END) AS BIGINT)
         AS unparsed_offer_events,
       COUNT(transaction_amount) AS with_amount,
       {r2("SUM(CAST(transaction_amount AS DECIMAL(28,2)))")} AS amount_sum,
       COUNT(reward_amount) AS with_reward,
       COUNT(DISTINCT event_id) AS distinct_event_ids,
       strftime(MIN(event_date), '%Y-%m-%d') AS first_date, strftime(MAX(event_date), '%Y-%m-%d') AS last_date
FROM events_processed GROUP BY event_type""",
    "offer_interactions": "SELECT * FROM offer_interactions",
    "offer_interactions_pivot": "SELECT * FROM offer_interactions",
    "channel_metrics": f"""
SELECT channel, sent AS total_offers_sent, completed AS offers_completed, {r2("mean_hours")} AS avg_completion_time_hours,
       {r2("100 * completed / sent")} AS completion_rate FROM channel_measures""",
    "channel_revenue": f"""
SELECT channel, {r2("sold")} AS total_revenue_generated, selling_offers AS offers_with_revenue, buying_members AS customers_with_revenue
FROM channel_measures WHERE selling_offers > 0""",
    "channel_rewards": "SELECT channel, rewarded AS total_rewards_earned FROM channel_measures WHERE completed > 0",
    "channel_reach": """
SELECT channel, COUNT(DISTINCT i.customer_id) FILTER (WHERE i.is_received) AS customers_received,
       COUNT(DISTINCT i.customer_id) FILTER (WHERE i.is_viewed) AS customers_viewed,
       COUNT(DISTINCT i.customer_id) FILTER (WHERE i.is_completed) AS customers_completed
FROM (SELECT offer_id, unnest(channels_list) AS channel FROM offers_enriched) o JOIN offer_interactions i USING (offer_id)
WHERE channel <> '' GROUP BY channel""",
    "channel_effectiveness": "SELECT * FROM channel_effectiveness",
    "channel_revenue_breakdown": "SELECT * FROM channel_effectiveness_wide",
    "customer_offer_status": """
SELECT customer_id, COUNT(*) FILTER (WHERE is_completed) AS offers_completed, COUNT(*) AS offers_received,
       CASE WHEN bool_or(is_completed) THEN 'Completed' ELSE 'Not Completed' END AS completion_status
FROM offer_interactions WHERE is_received GROUP BY customer_id""",
    "age_distribution": "SELECT * FROM age_distribution_analysis",
    "offer_completion_metrics": "SELECT * FROM offer_completion_metrics",
    "completion_avg_overall": f"""
SELECT {r2("SUM(hours * len(channels_list)) / SUM(CASE WHEN hours IS NOT NULL THEN len(channels_list) END)")} AS avg_hours_channel_rows,
       {r2("AVG(hours)")} AS avg_hours_per_journey, CAST(SUM(len(channels_list)) AS BIGINT) AS completions_channel_rows,
       COUNT(*) AS completions_journeys
FROM facts WHERE done""",
    "completion_avg_by_type": "SELECT offer_type, AVG(hours) AS avg_hours, COUNT(*) AS completions FROM facts_on_channel WHERE done GROUP BY offer_type",
    "completion_avg_by_channel": "SELECT channel, AVG(hours) AS avg_hours, COUNT(*) AS completions FROM facts_on_channel WHERE done GROUP BY channel",
    "channel_effectiveness_completable": "SELECT * FROM channel_effectiveness_c",
    "completion_avg_by_type_unfanned": "SELECT offer_type, AVG(hours) AS avg_hours, COUNT(*) AS completions FROM facts WHERE done GROUP BY offer_type",
    "v_channel_performance": _V_CHANNEL,
    "v_age_summary": _V_AGE,
    "v_offer_summary": _V_OFFER,
    "layer_audit": _AUDIT,
    "channel_rates_sorted": "SELECT channel, completion_rate, avg_revenue_per_offer FROM channel_effectiveness",
    "age_status_matrix": """
SELECT age_group,
       MAX(CASE WHEN completion_status = 'Completed' THEN percentage END) AS completed_pct,
       MAX(CASE WHEN completion_status = 'Not Completed' THEN percentage END) AS not_completed_pct
FROM age_distribution_analysis GROUP BY age_group""",
    "offer_type_summary": f"""
SELECT offer_type, {exact_mean("avg_completion_time_hours")} AS avg_completion_time_hours,
       {exact_mean("completion_rate")} AS completion_rate,
       CAST(SUM(total_completions) AS BIGINT) AS total_completions,
       CAST(SUM(total_received) AS BIGINT) AS total_received
FROM offer_completion_metrics GROUP BY offer_type""",
    "offer_type_insights": f"""
SELECT offer_type,
       CAST(ROUND(CAST(({exact_mean("avg_completion_time_hours")}) AS DECIMAL(38,12)), 1) AS DOUBLE)
         AS avg_completion_time_hours,
       CAST(ROUND(CAST(({exact_mean("completion_rate")}) AS DECIMAL(38,12)), 1) AS DOUBLE) AS completion_rate
FROM offer_completion_metrics GROUP BY offer_type""",
    "offer_channel_time_matrix": _matrix("avg_completion_time_hours"),
    "offer_channel_rate_matrix": _matrix("completion_rate"),
    "best_combinations": """
SELECT offer_type, channel, completion_rate, avg_completion_time_hours FROM offer_completion_metrics
ORDER BY completion_rate DESC, offer_type, channel LIMIT 5""",
    "fastest_combinations": """
SELECT offer_type, channel, avg_completion_time_hours, completion_rate FROM offer_completion_metrics
WHERE avg_completion_time_hours IS NOT NULL
ORDER BY avg_completion_time_hours, offer_type, channel LIMIT 5""",
    "channels_for_offer_type": """
SELECT offer_type, channel,
       CAST(ROW_NUMBER() OVER (PARTITION BY offer_type ORDER BY channel) AS INTEGER) AS channel_position,
       avg_completion_time_hours, completion_rate
FROM offer_completion_metrics""",
    "offer_types": "SELECT DISTINCT offer_type FROM offer_completion_metrics",
}

# fixed values: the columns that the raw and cleansed contracts declare non-null
_NON_NULL = {
    "customers": "customer_id",
    "offers": "offer_id offer_type difficulty reward duration channels",
    "events": "customer_id event time",
    "customers_cleansed": "customer_id data_quality_flag",
    "offers_enriched": "offer_id offer_type difficulty reward duration duration_hours",
    "events_processed": "event_id customer_id event_type event_time_hours event_timestamp event_date",
    "offer_interactions": "customer_id offer_id is_received is_viewed is_completed",
}
_SELECTS["contract_violations"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{column}' AS column_name, COUNT(*) FILTER (WHERE {column} IS NULL) AS violations "
    f"FROM {'loyalty_events' if table == 'events' else table}"
    for table, columns in _NON_NULL.items()
    for column in columns.split()
)

for _name, _order in {
    "v_channel_performance": "effectiveness_rank, channel",
    "v_age_summary": "age_group NULLS LAST",
    "v_offer_summary": "avg_completion_rate DESC NULLS LAST, offer_type NULLS LAST",
    "age_distribution": "completion_status, age_group NULLS LAST",
    "offer_completion_metrics": "offer_type NULLS LAST, avg_completion_time_hours NULLS LAST, channel",
}.items():
    _SELECTS[f"{_name}_sorted"] = (
        f"SELECT *, CAST(row_number() OVER (ORDER BY {_order}) AS INTEGER) AS position FROM ({_SELECTS[_name]})"
    )

ORACLE_SQL: dict[str, str] = {name: with_layers(select) for name, select in _SELECTS.items()}

# Warehouse-size operator queries: plain SQL over the star-schema views.
ORACLE_SQL.update(
    {
        "events_csv_round_trip": "SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts) FROM events",
        "part_csv_round_trip": "SELECT * FROM part",
        "tpch_segment_conditional_sums": f"""
SELECT c.c_mktsegment, COUNT(*) AS orders,
       CAST(SUM(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished_orders,
       {r2("AVG(CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_totalprice AS DECIMAL(28,2)) END)")} AS avg_finished_price,
       {r2("SUM(CAST(o.o_totalprice AS DECIMAL(28,2)))")} AS total_price,
       {r2("SUM(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) / COUNT(*) * 100")} AS finished_share
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_mktsegment""",
        "tpch_orders_in_customer_interval": f"""
WITH f AS (SELECT o_custkey, MIN(o_orderdate) AS d0 FROM orders GROUP BY o_custkey)
SELECT f.o_custkey, strftime(f.d0, '%Y-%m-%d') AS first_order_date, COUNT(*) AS orders_first_year,
       {r2("SUM(CAST(o.o_totalprice AS DECIMAL(28,2)))")} AS revenue_first_year
FROM f JOIN orders o
  ON o.o_custkey = f.o_custkey AND o.o_orderdate >= f.d0 AND o.o_orderdate <= f.d0 + INTERVAL 365 DAY
GROUP BY f.o_custkey, f.d0""",
        "tpch_lines_sum_distinct": f"""
SELECT l_returnflag, COUNT(*) AS line_count,
       {r2("AVG(CAST(l_quantity AS DECIMAL(18,2)))")} AS avg_quantity,
       COUNT(DISTINCT l_orderkey) AS distinct_orders,
       COUNT(DISTINCT l_suppkey) AS distinct_suppliers,
       {r2("stddev_samp(l_extendedprice)")} AS price_stddev
FROM lineitem GROUP BY l_returnflag""",
        "tpch_median_price_by_brand": """
SELECT p.p_brand, quantile_disc(l.l_extendedprice, 0.5) AS median_price, COUNT(*) AS line_count
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_brand""",
        "tpch_customers_ranked_by_revenue": f"""
WITH r AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(28,2))) AS revenue FROM orders GROUP BY o_custkey)
SELECT o_custkey, {r2("revenue")} AS revenue, RANK() OVER (ORDER BY revenue DESC NULLS LAST) AS revenue_rank FROM r""",
        "tpch_priority_pivot": "SELECT o_custkey, "
        + ", ".join(
            f"strftime(MIN(CASE WHEN o_orderpriority = '{p}' THEN o_orderdate END), '%Y-%m-%d') AS first_{n}"
            for p, n in (
                ("1-URGENT", "urgent"),
                ("2-HIGH", "high"),
                ("3-MEDIUM", "medium"),
                ("4-NOT SPECIFIED", "not_specified"),
                ("5-LOW", "low"),
            )
        )
        + " FROM orders GROUP BY o_custkey",
        "tpch_share_and_rank": f"""
WITH r AS (SELECT c.c_mktsegment, c.c_nationkey, SUM(CAST(o.o_totalprice AS DECIMAL(28,2))) AS revenue
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
           GROUP BY c.c_mktsegment, c.c_nationkey)
SELECT r.c_nationkey, r.c_mktsegment, {r2("r.revenue")} AS revenue,
       {r2("CAST(r.revenue AS DOUBLE) / CAST(SUM(r.revenue) OVER (PARTITION BY r.c_mktsegment) AS DOUBLE) * 100")}
         AS revenue_share,
       CAST(RANK() OVER (PARTITION BY r.c_mktsegment ORDER BY r.revenue DESC) AS INTEGER) AS nation_rank,
       n.n_name
FROM r LEFT JOIN nation n ON r.c_nationkey = n.n_nationkey""",
    }
)
