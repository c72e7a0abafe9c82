"""SQL for the park queries."""

DAYS = """d AS (SELECT ts::DATE AS date, count(*) AS total_attendance,
    count(*) FILTER (event_type = 'click') AS ap_attendance, count(*) FILTER (event_type = 'view') AS ticket_attendance,
    count(*) FILTER (event_type = 'purchase') AS promotional_ticket_attendance,
    count(*) FILTER (event_type = 'error') * 100 / count(*)::DOUBLE AS beijing_guest_ratio,
    max(value) AS max_temperature, count(DISTINCT hour(ts))::DOUBLE AS operating_hours,
    sum(value::DECIMAL(18,2))::DOUBLE AS total_fb_revenue,
    sum(value::DECIMAL(18,2))::DOUBLE / count(*) AS rev_per_cap,
    CASE WHEN dayofweek(any_value(ts::DATE)) IN (0, 6) THEN 2 ELSE 0 END AS marquee_event FROM events GROUP BY 1)"""

DRIVERS = ("ap_attendance", "date_diff", "promotional_ticket_attendance", "ticket_attendance")


def fitted(drivers: tuple[str, ...] = DRIVERS, where: str = "marquee_event = 0", more: str = "") -> str:
    """CTEs ending in b(feature, value): the least squares coefficients of revenue on all drivers.

    For each driver the others are taken out of it and of revenue one after the other; what is left of revenue, divided
    by what is left of the driver, is the coefficient.
    """
    parts = [DAYS, f"""e AS (SELECT *, datediff('day', DATE '2023-01-01', date) AS date_diff{more} FROM d
        WHERE {where})"""]
    for f, driver in enumerate(drivers):
        others = [x for x in drivers if x != driver]
        columns = [*others, driver, "total_fb_revenue"]
        parts.append(f"f{f}_0 AS MATERIALIZED (SELECT " + ", ".join(f"{c} - avg({c}) OVER () AS {c}" for c in columns) + " FROM e)")
        for i, out in enumerate(others):
            columns = columns[1:]
            left = ", ".join(f"{c} - {out} * sum({c} * {out}) OVER () / sum({out} * {out}) OVER () AS {c}" for c in columns)
            parts.append(f"f{f}_{i + 1} AS MATERIALIZED (SELECT {left} FROM f{f}_{i})")
    solved = " UNION ALL ".join(
        f"SELECT '{driver}' AS feature, sum(total_fb_revenue * {driver}) / sum({driver} * {driver}) AS value FROM f{f}_{len(drivers) - 1}"
        for f, driver in enumerate(drivers)
    )
    return ", ".join([*parts, f"b AS ({solved})"])


WEEKDAYS = ("Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
DAY_NAMES = "".join(f", (dayname(date) = '{day}')::INT AS {day}" for day in WEEKDAYS)


TREE_FEATURES = ("week_days", "Att", "Pass Revisit %", "Max Temp", "POO outside BJ", "Park Hrs", "date_diff")
DEPTH = 4


def tree(target: str) -> str:
    """CTEs ending in nodes(node, n, s, f, threshold, gain) and held(y, node), the held-out days in their leaves.

    Each level scores every midpoint between two values of every feature by what it takes from the squared error.
    """
    mine = ", ".join(f"f{i}" for i in range(len(TREE_FEATURES)))
    value = "CASE b.f " + " ".join(f"WHEN {i} THEN f{i}" for i in range(len(TREE_FEATURES))) + " END"
    parts = [DAYS, f"""v AS MATERIALIZED (SELECT isodow(date)::DOUBLE AS f0, total_attendance::DOUBLE AS f1,
          ap_attendance / total_attendance::DOUBLE * 100 AS f2, max_temperature::DOUBLE AS f3, 100 - beijing_guest_ratio AS f4,
          operating_hours AS f5, datediff('day', DATE '2023-01-01', date)::DOUBLE AS f6, {target} AS y,
          ('0x' || substr(md5(date::VARCHAR || ':42'), 1, 8))::BIGINT < {int(0.8 * 2**32)} AS is_train FROM d)""",
             f"r0 AS MATERIALIZED (SELECT {mine}, round(y * 1000000)::BIGINT AS y, 1 AS node FROM v WHERE is_train)"]
    for i in range(DEPTH + 1):
        parts.append(f"""t{i} AS MATERIALIZED (SELECT node, count(*) AS n, sum(y)::BIGINT AS s, min(y) < max(y) AS mixed
            FROM r{i} GROUP BY 1)""")
        if i == DEPTH:
            break
        rows = " UNION ALL ".join(f"SELECT node, {j} AS f, f{j} AS x, y FROM r{i}" for j in range(len(TREE_FEATURES)))
        parts.append(f"""g{i} AS (SELECT node, f, x, count(*) AS n, sum(y)::BIGINT AS s FROM ({rows}) GROUP BY 1, 2, 3),
          c{i} AS (SELECT node, f, x, sum(n) OVER w AS un, (sum(s) OVER w)::BIGINT AS us, lead(x) OVER w AS nx FROM g{i}
            WINDOW w AS (PARTITION BY node, f ORDER BY x)),
          k{i} AS (SELECT node, f, (x + nx) / 2 AS threshold, us::DOUBLE * us::DOUBLE / un
              + (s - us)::DOUBLE * (s - us)::DOUBLE / (n - un) AS score, s::DOUBLE * s::DOUBLE / n AS whole
            FROM c{i} JOIN t{i} USING (node) WHERE nx IS NOT NULL AND mixed),
          b{i} AS MATERIALIZED (SELECT node, f, threshold, score - whole AS gain FROM (SELECT *, row_number() OVER (
            PARTITION BY node ORDER BY score DESC, f, threshold) AS k FROM k{i}) WHERE k = 1),
          r{i + 1} AS MATERIALIZED (SELECT {mine}, y, 2 * r.node + ({value} > threshold)::INT AS node
            FROM r{i} r JOIN b{i} b USING (node))""")
    totals = " UNION ALL ".join(f"FROM t{i}" for i in range(DEPTH + 1))
    splits = " UNION ALL ".join(f"FROM b{i}" for i in range(DEPTH))
    parts.append(f"b AS MATERIALIZED ({splits}), nodes AS (SELECT node, n, s, f, threshold, gain FROM ({totals}) LEFT JOIN b USING (node))")
    parts.append(f"h0 AS (SELECT {mine}, y, 1 AS node FROM v WHERE NOT is_train)")
    for i in range(DEPTH):
        parts.append(f"""h{i + 1} AS (SELECT {mine}, y, CASE WHEN b.node IS NULL THEN h.node
            ELSE 2 * h.node + ({value} > threshold)::INT END AS node FROM h{i} h LEFT JOIN b ON b.node = h.node)""")
    parts.append(f"held AS (SELECT y, node FROM h{DEPTH})")
    return ", ".join(parts)


def factors(target: str) -> str:
    names = " UNION ALL ".join(f"SELECT {i} AS f, '{name}' AS feature" for i, name in enumerate(TREE_FEATURES))
    return f"""WITH {tree(target)}, m AS (SELECT avg((y - s::DOUBLE / n / 1000000) ** 2) AS mse FROM held JOIN nodes USING (node)),
        i AS (SELECT feature, coalesce(sum(gain), 0) / (SELECT sum(gain) FROM b) AS importance
              FROM ({names}) LEFT JOIN b USING (f) GROUP BY 1)
        SELECT feature, round(importance, 6) AS importance, round(mse, 3) AS mse FROM i, m"""


ORACLES = {
    "cart_drivers": factors("total_fb_revenue"),
    "cart_drivers_per_head": factors("rev_per_cap"),
    "cart_rules": f"""WITH {tree("total_fb_revenue")}
        SELECT (row_number() OVER (ORDER BY bin(node)) - 1)::INT AS line_no, node::BIGINT AS node,
          (length(bin(node)) - 1)::INT AS depth, (ARRAY[{", ".join(f"'{x}'" for x in TREE_FEATURES)}])[f + 1] AS feature,
          round(threshold, 6) AS threshold, n AS n_rows, round(s::DOUBLE / n / 1000000, 6) AS prediction FROM nodes""",
    "park_days_of_event": f"""WITH {DAYS} SELECT date, ap_attendance, ticket_attendance, promotional_ticket_attendance,
        total_fb_revenue FROM d WHERE marquee_event = 2""",
    "tree_features": f"""WITH {DAYS} SELECT date, isodow(date)::INT AS week_days, total_attendance AS "Att",
        round(ap_attendance / total_attendance::DOUBLE * 100, 6) AS "Pass Revisit %",
        round(max_temperature, 6) AS "Max Temp", round(100 - beijing_guest_ratio, 6) AS "POO outside BJ",
        round(operating_hours, 6) AS "Park Hrs", round(rev_per_cap, 6) AS rev_per_cap,
        datediff('day', DATE '2023-01-01', date)::INT AS date_diff FROM d""",
    "ols_slope": f"""WITH {DAYS} SELECT marquee_event, round(regr_slope(total_fb_revenue, total_attendance), 4) AS slope,
        round(regr_intercept(total_fb_revenue, total_attendance), 4) AS intercept, count(*) AS n_rows FROM d GROUP BY 1""",
    "ols_drivers": f"WITH {fitted()} SELECT feature, round(value, 3) AS value, round(value / (SELECT max(value) FROM b)"
        " * 100, 3) AS relative FROM b",
    "ols_weekdays": f"""WITH {fitted(("total_attendance", "date_diff", *WEEKDAYS), "true", DAY_NAMES)}
        SELECT CASE WHEN feature IN ('total_attendance', 'date_diff') THEN feature ELSE 'week_days=' || feature END AS feature,
          round(value, 3) AS value FROM b""",
    "ols_drivers_of_type": f"""WITH {fitted()} SELECT feature, round(value, 3) AS value FROM b
        WHERE feature IN ('ap_attendance', 'date_diff')""",
    "ols_important": f"""WITH {fitted()}, r AS (SELECT feature, round(value, 3) AS value,
          round(value / (SELECT max(value) FROM b) * 100, 3) AS relative FROM b)
        SELECT * FROM r WHERE relative > 10""",
    "ols_conclusion": f"""WITH {fitted()} SELECT '餐饮消费主要随这些因素上升：'
          || string_agg(feature, ', ' ORDER BY value DESC) || '；线性回归系数依次为 '
          || string_agg(format('{{:.1f}}', value), ', ' ORDER BY value DESC) AS conclusion FROM b WHERE value > 0""",
    "geo_lookup": """WITH c AS (SELECT c_nationkey + 5 AS c_nationkey, count(*) AS value FROM customer GROUP BY 1)
        SELECT c.c_nationkey, value, r_name AS feature, r_name IS NOT NULL AS matched FROM c
        LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
          ON c_nationkey = n_nationkey""",
}
