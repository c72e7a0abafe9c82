"""SQL for the ticket reports."""

MONTHS = """m AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, l_returnflag, l_linestatus,
  sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2, 3)"""
PAIRS = [(f, s) for f in "ANR" for s in "FO"]

ORACLES = {
    "ticket_weekly_sales": """SELECT date_trunc('week', l_shipdate)::DATE AS week,
        sum(CASE WHEN p_name LIKE 'small%' THEN l_quantity ELSE 0 END) AS one_day,
        sum(CASE WHEN p_name LIKE 'large%' THEN l_quantity ELSE 0 END) AS two_day
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_shipdate >= TIMESTAMP '1997-04-01' AND l_shipdate < TIMESTAMP '1997-07-01' GROUP BY 1""",
    "visitors_by_province": """SELECT n_name AS province, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_visitors
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE strftime(o_orderdate, '%Y-%m') = '1997-06' GROUP BY 1""",
    "channel_rank": """WITH s AS (SELECT l_returnflag AS channel, sum(l_extendedprice::DECIMAL(18,2)) AS amount
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-06-01' AND l_shipdate < TIMESTAMP '1997-06-08' GROUP BY 1)
        SELECT channel, amount::DOUBLE AS amount, rank() OVER (ORDER BY amount DESC)::INT AS rank FROM s""",
    "top_5_entities": """SELECT s_suppkey, s_name, s_acctbal, format('{:,}', round_even(s_acctbal, 0)::BIGINT)
        AS balance_text FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 5""",
    "stacked_series_base": f"""WITH {MONTHS}, s AS (
        SELECT month, l_returnflag || '-' || l_linestatus AS series, quantity FROM m)
        SELECT *, coalesce(sum(quantity) OVER (PARTITION BY month ORDER BY series
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM s""",
    "dynamic_pivot_mean": f"WITH {MONTHS} SELECT month, " + ", ".join(
        f"""round(coalesce(avg(quantity) FILTER (l_returnflag = '{f}' AND l_linestatus = '{s}'), 0), 6)
            AS quantity_{f}_{s}""" for f, s in PAIRS
    ) + " FROM m GROUP BY 1",
    "parameterised_query": "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value > 50",
    "target_column_scan": "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem",
}
