"""SQL for the occupancy reports."""

NAMED = """u AS (
  SELECT l_suppkey AS hospital_id, s_name AS hospital_name, r_name AS hospital_district, p_type AS department_name,
         l_shipdate AS timestamp, l_quantity AS occupancy_rate, l_extendedprice AS price
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)"""


def box(key: str, value: str) -> str:
    return f"""WITH {NAMED}, q AS (
      SELECT {key}, count({value}) AS n, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
             quantile_cont({value}, 0.75) AS q3 FROM u GROUP BY 1)
      SELECT {key}, any_value(n) AS n, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median,
        round(any_value(q3), 4) AS q3,
        min({value}) FILTER ({value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS low_whisker,
        max({value}) FILTER ({value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS high_whisker,
        count(*) FILTER (NOT {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
      FROM u JOIN q USING ({key}) GROUP BY 1"""


# Headers of the pivots: a view needs them named.
DISTRICTS = "'AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'"

ORACLES = {
    "occupancy_by_hospital": f"""WITH {NAMED} SELECT hospital_id, hospital_name,
        round_even(avg(occupancy_rate), 2) AS mean_value, count(occupancy_rate) AS n_samples FROM u GROUP BY 1, 2""",
    "occupancy_by_dept": f"""WITH {NAMED} SELECT hospital_id, hospital_name, department_name,
        round_even(avg(occupancy_rate), 2) AS mean_value, count(occupancy_rate) AS n_samples
        FROM u GROUP BY 1, 2, 3""",
    "mean_std_by_district": f"""WITH {NAMED} SELECT hospital_district, round_even(avg(occupancy_rate), 2) AS mean_value,
        round_even(stddev_samp(occupancy_rate), 2) AS std_value FROM u GROUP BY 1""",
    "mean_std_by_dept": f"""WITH {NAMED} SELECT department_name, round_even(avg(occupancy_rate), 2) AS mean_value,
        round_even(stddev_samp(occupancy_rate), 2) AS std_value FROM u GROUP BY 1""",
    "dept_district_pivot": f"""WITH {NAMED} SELECT * FROM (
        PIVOT u ON hospital_district IN ({DISTRICTS}) USING round_even(avg(occupancy_rate), 2) GROUP BY department_name)""",
    "time_trend": f"WITH {NAMED} SELECT timestamp, round(avg(occupancy_rate), 6) AS mean_rate FROM u GROUP BY 1",
    "trend_by_district": f"""WITH {NAMED} SELECT * FROM (
        PIVOT u ON hospital_district IN ({DISTRICTS}) USING round(avg(occupancy_rate), 6) GROUP BY timestamp)""",
    "boxplot_stats": box("hospital_district", "price"),
    "boxplot_by_hospital": box("hospital_id", "occupancy_rate"),
    "boxplot_outliers": """WITH u AS (SELECT *, pow(c_acctbal / 1000, 3) AS size FROM customer), q AS (
        SELECT c_mktsegment, quantile_cont(size, 0.25) AS q1, quantile_cont(size, 0.75) AS q3 FROM u GROUP BY 1)
        SELECT c_custkey, c_mktsegment, c_acctbal FROM u JOIN q USING (c_mktsegment)
        WHERE NOT size BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1)""",
    "left_join_quarter_score": """WITH s AS (
        SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*) AS score FROM orders
        WHERE year(o_orderdate) = 1997 AND quarter(o_orderdate) = 4 GROUP BY 1)
        SELECT c_custkey AS employee_id, c_name AS name, score AS score_1997_q4
        FROM customer LEFT JOIN s ON c_custkey = o_custkey""",
}
