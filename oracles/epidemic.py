"""SQL for the daily and district reports."""

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]

DAILY = """daily AS (
  SELECT o_orderdate::DATE AS report_date, count(*) AS new_cases, max(o_orderkey) AS cum_cases
  FROM orders GROUP BY 1)"""
DISTRICT = """d AS (
  SELECT o_orderdate::DATE AS report_date, n_name AS district, o_orderstatus AS risk,
         o_totalprice::DECIMAL(18,2) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def profile(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count({column}) AS n_values, round(avg({column}), 3) AS mean,
      round(stddev_samp({column}), 3) AS std, round(min({column})::DOUBLE, 3) AS lowest,
      round(quantile_cont({column}::DOUBLE, 0.25), 3) AS q1, round(quantile_cont({column}::DOUBLE, 0.5), 3) AS median,
      round(quantile_cont({column}::DOUBLE, 0.75), 3) AS q3, round(max({column})::DOUBLE, 3) AS highest,
      count(*) - count({column}) AS n_null,
      round((count(*) - count({column})) / count(*)::DOUBLE, 4) * 100 AS null_pct FROM lineitem"""


# Headers of the pivots: a view needs them named.
RISKS = "'F', 'O', 'P'"
MONTHS = ", ".join(f"'{year}-{month:02d}'" for year in range(1995, 2002) for month in range(1, 13) if (year, month) <= (2001, 8))

ORACLES = {
    "daily_totals": """SELECT ts::DATE AS report_date, sum(value::DECIMAL(18,2))::DOUBLE AS new_value,
        max(event_id) AS cumulative FROM events GROUP BY 1""",
    "daily_sum_of_cumulative": """SELECT ts::DATE AS report_date, sum(value::DECIMAL(18,2))::DOUBLE AS new_value,
        sum(event_id)::BIGINT AS cumulative FROM events GROUP BY 1""",
    "total_and_peak": """SELECT count(*) AS total_new_cases, max(o_orderkey) AS max_cum_cases FROM orders""",
    "moving_avg_7": f"""WITH {DAILY} SELECT report_date, new_cases,
        round(CASE WHEN count(*) OVER w = 7 THEN avg(new_cases) OVER w END, 6) AS moving_avg
        FROM daily WINDOW w AS (ORDER BY report_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "growth_rate": f"""WITH {DAILY} SELECT report_date, cum_cases,
        round(coalesce(CASE WHEN count(*) OVER w = 7 THEN avg(new_cases) OVER w END, 0), 6) AS moving_avg,
        round(coalesce((new_cases / nullif(lag(new_cases) OVER (ORDER BY report_date), 0)::DOUBLE - 1) * 100, 0), 6)
          AS growth_pct
        FROM daily WINDOW w AS (ORDER BY report_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "last_30_days": f"WITH {DAILY} SELECT * FROM daily ORDER BY report_date DESC LIMIT 30",
    "last_30_days_kpi": f"""WITH {DAILY}, r AS (SELECT * FROM daily ORDER BY report_date DESC LIMIT 30)
        SELECT sum(new_cases)::BIGINT AS total, max_by(cum_cases, report_date) AS latest_level,
          round_even(avg(new_cases), 1) AS daily_mean, count(*) AS n_days,
          (SELECT sum(new_cases)::BIGINT FROM r) AS last_total,
          (SELECT round_even(avg(new_cases), 1) FROM r) AS last_daily_mean, (SELECT count(*) FROM r) AS last_days
        FROM daily""",
    "every_kth_day": f"""WITH {DAILY}, p AS (
        SELECT row_number() OVER (ORDER BY report_date) - 1 AS position, report_date, new_cases FROM daily)
        SELECT * FROM p WHERE position % 15 = 0""",
    "district_rate_per_100k": f"""WITH {DISTRICT}, p AS (
        SELECT n_name AS district, count(*) AS population FROM customer JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1)
        SELECT district, count(*) AS new_cases, population, round_even(count(*) / population::DOUBLE * 100000, 2)
          AS rate_100k FROM d JOIN p USING (district) GROUP BY district, population""",
    "latest_snapshot": """SELECT ts::DATE AS report_date, event_id, user_id, event_type, value FROM events
        WHERE ts::DATE = (SELECT max(ts::DATE) FROM events)""",
    "share_with_other_bucket": f"""WITH {DISTRICT}, t AS (SELECT district, sum(value) AS value FROM d GROUP BY 1),
        s AS (SELECT district, value, value::DOUBLE / (SELECT sum(value) FROM t)::DOUBLE * 100 AS share_pct FROM t
              WHERE value > 0)
        SELECT CASE WHEN share_pct >= 4 THEN district ELSE 'other' END AS district, sum(value)::DOUBLE AS value,
          round(sum(share_pct), 4) AS share_pct, count(*) AS n_members FROM s GROUP BY 1""",
    "risk_value_counts": "SELECT o_orderpriority AS risk, count(*) AS n_rows FROM orders GROUP BY 1",
    "district_risk_counts": f"WITH {DISTRICT} SELECT district, risk, count(*) AS n_rows FROM d GROUP BY 1, 2",
    "district_risk_pivot": f"""WITH {DISTRICT} SELECT * FROM (
        PIVOT d ON risk IN ({RISKS}) USING count(*) GROUP BY district)""",
    "month_district_pivot": f"""WITH {DISTRICT}, m AS (
        SELECT district, strftime(report_date, '%Y-%m') AS month, count(*) AS n FROM d GROUP BY 1, 2)
        SELECT * FROM (PIVOT m ON month IN ({MONTHS}) USING sum(n)::BIGINT GROUP BY district)""",
    "month_totals": f"""WITH {DISTRICT} SELECT strftime(report_date, '%Y-%m') AS month, district,
        sum(value)::DOUBLE AS value FROM d GROUP BY 1, 2""",
    "top_10_days": """SELECT ts::DATE AS report_date, sum(value::DECIMAL(18,2))::DOUBLE AS new_value FROM events
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "report_range": f"""WITH {DISTRICT} SELECT min(report_date) AS first_date, max(report_date) AS last_date,
        count(*) AS n_rows, count(DISTINCT district) AS n_keys FROM d""",
    "district_list": f"WITH {DISTRICT} SELECT DISTINCT district FROM d",
    "daily_payload": f"""WITH {DAILY} SELECT to_json({{'dates': list(strftime(report_date, '%Y-%m-%d')
        ORDER BY report_date), 'new_cases': list(new_cases ORDER BY report_date),
        'total_cases': list(cum_cases ORDER BY report_date)}})::VARCHAR AS payload FROM daily""",
    "district_payload": f"""WITH {DISTRICT}, p AS (
        SELECT n_name AS district, count(*) AS population FROM customer JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1), x AS (SELECT report_date, district, count(*) AS n FROM d GROUP BY 1, 2),
        c AS (SELECT *, sum(n) OVER (PARTITION BY district ORDER BY report_date)::INT AS total FROM x)
        SELECT to_json({{'name': district, 'value': n::INT, 'total': total, 'population': population::INT}})::VARCHAR
          AS record FROM c JOIN p USING (district) WHERE report_date = (SELECT max(report_date) FROM x)""",
    "column_profile": " UNION ALL ".join(map(profile, NUMBERS)),
    "correlation_matrix": " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, " + ("1.0::DOUBLE AS corr" if a == b
                                              else f"round(corr({a}, {b}), 2) AS corr FROM lineitem")
        for a in NUMBERS for b in NUMBERS
    ),
}
