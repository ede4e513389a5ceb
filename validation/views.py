"""The adapter's derivations as SQL, for the check in DuckDB.

Each entry is one common table expression; ``statement`` puts those that a query
needs in front of it.
"""

from __future__ import annotations

import re

from validation.adapter import ANCHORS, AS_OF, HORIZON_DAYS

TODAY = f"DATE '{AS_OF.isoformat()}'"
DAY_Z = 2.81

VIEWS: dict[str, str] = {
    "v_site": "SELECT r_regionkey AS site_id, r_name AS region_code, 'C' || (r_regionkey % 2) AS country FROM region",
    "v_dataset": """
        SELECT site_id * 10 + n AS dataset_id, region_code, country, wh AS warehouse, 0.5::DOUBLE AS weight
        FROM v_site, (VALUES (0, 'ALL'), (1, 'W0'), (2, 'W1'), (3, 'W2')) AS kinds(n, wh)""",
    # Datasets of any accumulation, with two forecast setups each.
    "v_every_setup": """
        SELECT site_id * 10 + n AS dataset_id, region_code, wh AS warehouse, (site_id * 10 + n) * 2 + k AS params_id
        FROM v_site, (VALUES (0, 'ALL'), (1, 'W0'), (2, 'W1'), (3, 'W2'), (9, 'ALL')) AS kinds(n, wh), range(2) AS t(k)""",
    "v_header": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, r_name AS region_code, 'W' || (o_custkey % 3) AS warehouse,
               c_mktsegment AS tag, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS status,
               CAST(o_orderdate AS DATE) AS close_date,
               (o_custkey % 97)::DOUBLE / 10 AS x, (o_custkey % 89)::DOUBLE / 10 AS y
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
             JOIN region ON r_regionkey = n_regionkey""",
    "v_line": """
        SELECT l_orderkey AS order_id, l_partkey % 50 AS product_id,
               CASE WHEN l_orderkey % 45 = 7 THEN 2000.0::DOUBLE ELSE l_quantity + (l_suppkey % 8)::DOUBLE / 8 END AS quantity, p_retailprice AS price,
               l_returnflag = 'R' AS deleted,
               NOT (l_partkey % 50 % 4 = 0 OR (l_partkey % 50 % 4 = 1 AND l_suppkey % 2 = 1)) AS first_party
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "v_sku": """
        SELECT DISTINCT p_partkey % 50 AS old_id, p_partkey % 50 - 1 AS new_id,
               CASE WHEN p_partkey % 10 = 9 THEN 4.0 ELSE 0.5 END::DOUBLE AS factor
        FROM part WHERE p_partkey % 10 IN (7, 9)""",
    "v_vip": """
        SELECT region_code, tag, wh FROM v_site,
               (VALUES ('BUILDING', 'W1'), ('MACHINERY', 'W0'), ('MACHINERY', 'W1')) AS t(tag, wh)""",
    "v_block": """
        SELECT c_custkey AS element, 'user' AS kind, r_name AS region_code
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        WHERE c_acctbal < -500
        UNION ALL SELECT order_id, 'order', region_code FROM v_header WHERE order_id % 211 = 0
        UNION ALL SELECT 13, 'product', r_name FROM region WHERE r_name IN ('AFRICA', 'ASIA')
        UNION ALL SELECT NULL, 'user', r_name FROM region WHERE r_regionkey = 4""",
    "v_closed": f"""
        SELECT * FROM v_header WHERE status = 1 AND close_date <= {TODAY} AND dayofweek(close_date) <> 0""",
    # Zones as range predicates; zone 1 has a hole, zone 2 is stored twice, zone 3 is an L and a triangle.
    "v_zone_hit": """
        SELECT order_id, region_code, 1 AS zone FROM v_header
        WHERE x > 0.05 AND x < 5.05 AND y > 0.05 AND y < 6.05 AND NOT (x > 1.05 AND x < 2.05 AND y > 1.05 AND y < 2.05)
        UNION ALL SELECT order_id, region_code, 2 FROM v_header WHERE x > 3.05 AND x < 7.05 AND y > 2.05 AND y < 7.05
        UNION ALL SELECT order_id, region_code, 3 FROM v_header
        WHERE (x > 5.05 AND x < 9.65 AND y > 0.05 AND y < 4.05) OR (x > 7.05 AND x < 9.65 AND y > 0.05 AND y < 8.85)
        UNION ALL SELECT order_id, region_code, 2 FROM v_header WHERE x > 3.05 AND x < 7.05 AND y > 2.05 AND y < 7.05
        UNION ALL SELECT order_id, region_code, 3 FROM v_header
        WHERE x > 0.05 AND y > 7.05 AND (x - 0.05) / 4 + (y - 7.05) / 1.5 < 1""",
    "v_group": """
        SELECT * FROM (VALUES ('ALL', 1), ('ALL', 2), ('ALL', 3), ('W0', 1), ('W0', 2), ('W1', 2), ('W1', 3),
                              ('W2', 1), ('W2', 3)) AS t(wh, zone)""",
    "v_zone_order": """
        SELECT h.order_id, h.user_id, h.close_date, h.region_code, d.dataset_id, d.weight
        FROM v_closed h
        JOIN v_dataset d ON d.region_code = h.region_code
        JOIN v_group g ON g.wh = d.warehouse
        JOIN v_zone_hit z ON z.order_id = h.order_id AND z.zone = g.zone
        LEFT JOIN v_vip v ON v.region_code = h.region_code AND v.tag = h.tag
        WHERE v.wh IS NULL OR d.warehouse = 'ALL'""",
    "v_account_order": """
        SELECT h.order_id, h.user_id, h.close_date, h.region_code, d.dataset_id, d.weight
        FROM v_closed h
        JOIN v_vip v ON v.region_code = h.region_code AND v.tag = h.tag
        JOIN v_dataset d ON d.region_code = h.region_code AND d.warehouse = v.wh""",
    "v_routed": "SELECT * FROM v_zone_order UNION ALL SELECT * FROM v_account_order",
    "v_lines_all": """
        SELECT r.close_date, l.product_id, l.quantity, r.dataset_id, r.region_code, r.weight, r.user_id
        FROM v_routed r JOIN v_line l ON l.order_id = r.order_id AND NOT l.deleted
        WHERE r.order_id NOT IN (SELECT element FROM v_block b WHERE b.kind = 'order' AND b.region_code = r.region_code)
          AND l.product_id NOT IN
              (SELECT element FROM v_block b WHERE b.kind = 'product' AND b.region_code = r.region_code)""",
    "v_lines_open": """
        SELECT * FROM v_lines_all r
        WHERE r.user_id NOT IN (SELECT element FROM v_block b WHERE b.kind = 'user' AND b.region_code = r.region_code)""",
    "v_stats_all": """
        SELECT dataset_id, product_id, AVG(quantity) AS mean, COALESCE(STDDEV_SAMP(quantity), 0) AS sd,
               QUANTILE_CONT(quantity, 0.99) AS p99 FROM v_lines_all GROUP BY ALL""",
    "v_stats_open": """
        SELECT dataset_id, product_id, AVG(quantity) AS mean, COALESCE(STDDEV_SAMP(quantity), 0) AS sd,
               QUANTILE_CONT(quantity, 0.99) AS p99 FROM v_lines_open GROUP BY ALL""",
    "v_lost": """
        SELECT CAST(l_shipdate AS DATE) AS close_date, l_partkey % 50 AS product_id, h.region_code, h.warehouse,
               l_quantity / 2 AS amount
        FROM lineitem JOIN v_header h ON h.order_id = l_orderkey WHERE l_returnflag = 'N' AND l_linenumber = 1""",
    "v_stockout_wh": f"""
        SELECT s.close_date, COALESCE(new_id, s.product_id) AS product_id, s.region_code, d.dataset_id,
               SUM(amount * COALESCE(factor, 1) * d.weight) AS stockouts
        FROM v_lost s JOIN v_dataset d ON d.region_code = s.region_code AND d.warehouse = s.warehouse
        LEFT JOIN v_sku ON old_id = s.product_id
        WHERE s.close_date <= {TODAY} GROUP BY 1, 2, 3, 4 HAVING SUM(amount * COALESCE(factor, 1) * d.weight) > 0""",
    "v_stockout_region": f"""
        SELECT s.close_date, COALESCE(new_id, s.product_id) AS product_id, s.region_code, d.dataset_id,
               SUM(amount * COALESCE(factor, 1) * d.weight) AS stockouts
        FROM v_lost s JOIN v_dataset d ON d.region_code = s.region_code
        LEFT JOIN v_sku ON old_id = s.product_id
        WHERE s.close_date <= {TODAY} GROUP BY 1, 2, 3, 4 HAVING SUM(amount * COALESCE(factor, 1) * d.weight) > 0""",
}


def kept_lines_sql(sigma: bool, percentile: bool, users: bool) -> str:
    """Lines of a variant with their remapped product and quantity."""
    scope = "open" if users else "all"
    tests = (["l.quantity <= t.mean + 6 * t.sd"] if sigma else []) + (["l.quantity <= t.p99"] if percentile else [])
    stats = (
        f"LEFT JOIN v_stats_{scope} t ON t.dataset_id = l.dataset_id AND t.product_id = l.product_id" if tests else ""
    )
    where = "WHERE " + " AND ".join(tests) if tests else ""
    return f"""
        SELECT l.close_date, COALESCE(new_id, l.product_id) AS product_id, l.dataset_id, l.region_code, l.weight,
               SUM(l.quantity * COALESCE(factor, 1)) AS quantity
        FROM v_lines_{scope} l LEFT JOIN v_sku ON old_id = l.product_id {stats} {where} GROUP BY 1, 2, 3, 4, 5"""


def days_sql(lines: str, stockouts: str) -> str:
    """Full outer join of line demand and stockouts, summed per day."""
    return f"""
        SELECT COALESCE(q.close_date, s.close_date) AS day, COALESCE(q.product_id, s.product_id) AS product_id,
               COALESCE(q.dataset_id, s.dataset_id) AS dataset_id,
               SUM(COALESCE(q.quantity, 0) + COALESCE(s.stockouts, 0)) AS demand
        FROM ({lines}) q FULL OUTER JOIN {stockouts} s
          ON s.dataset_id = q.dataset_id AND s.product_id = q.product_id AND s.close_date = q.close_date
        GROUP BY 1, 2, 3"""


# The design: which steps each variant uses (sigma, percentile, users, smoothing).
DESIGN = {
    1: (0, 0, 0, 0), 2: (1, 0, 0, 1), 3: (0, 1, 0, 1), 4: (1, 1, 0, 0),
    5: (0, 0, 1, 1), 6: (1, 0, 1, 0), 7: (0, 1, 1, 0), 8: (1, 1, 1, 1),
}

for number, (a, b, c, _) in DESIGN.items():
    VIEWS[f"v_kept_{number}"] = kept_lines_sql(bool(a), bool(b), bool(c))
    VIEWS[f"v_days_{number}"] = days_sql(f"SELECT * FROM v_kept_{number}", "v_stockout_wh")
    VIEWS[f"v_scored_{number}"] = f"""
        SELECT *, COALESCE((demand - AVG(demand) OVER p) / NULLIF(STDDEV_SAMP(demand) OVER p, 0), 0) AS z
        FROM v_days_{number} WINDOW p AS (PARTITION BY product_id, dataset_id)"""


def demand_sql(number: int, condition: str = "TRUE") -> str:
    """Final demand of a variant for the days that meet ``condition``."""
    if DESIGN[number][3]:
        rows = f"""
            SELECT day, product_id, dataset_id, CASE WHEN z >= {DAY_Z} OR z <= -{DAY_Z}
                   THEN AVG(demand) OVER (PARTITION BY product_id, dataset_id) ELSE demand END AS demand
            FROM v_scored_{number} WHERE {condition}"""
    else:
        rows = f"SELECT day, product_id, dataset_id, demand FROM v_days_{number} WHERE {condition}"
    return f"""
        SELECT day AS date, product_id, ROUND(demand, 6) AS demand, dataset_id AS dp_input_datasets_id,
               'experiment_{number}' AS experiment FROM ({rows})"""


_ANCHOR_ROWS = ", ".join(f"(DATE '{day.isoformat()}')" for day in ANCHORS)
_TIMEFRAME = """date_diff('day', {a}, {b})
    - date_diff('day', {a} - CAST(dayofweek({a}) AS INTEGER), {b} - CAST(dayofweek({b}) AS INTEGER)) // 7"""


def timeframe_sql(start: str, end: str) -> str:
    return "CAST(" + _TIMEFRAME.format(a=start, b=end) + " AS INTEGER)"


VIEWS.update(
    {
        "v_case": f"SELECT anchor, dataset_id, region_code, warehouse FROM v_dataset, (VALUES {_ANCHOR_ROWS}) AS t(anchor)",
        "v_actual": "SELECT day, product_id, dataset_id, demand FROM v_days_1",
        "v_catalog": """
            SELECT DISTINCT p_partkey % 50 AS product_id, wh AS warehouse,
                   CASE WHEN p_partkey % 50 % 3 = 0 THEN 'FRUVER' ELSE 'OTHER' END AS category
            FROM part, (VALUES ('ALL'), ('W0'), ('W1'), ('W2')) AS t(wh)""",
        "v_setup": """
            SELECT dataset_id * 2 + n AS params_id, dataset_id, region_code, warehouse,
                   CASE n WHEN 0 THEN DATE '1995-01-01' ELSE DATE '2001-05-10' END AS live_from,
                   CASE WHEN n = 0 THEN DATE '2001-05-20' WHEN dataset_id % 2 = 1 THEN DATE '2001-07-15' END AS live_to
            FROM v_dataset, (VALUES (0), (1)) AS t(n)""",
        "v_forecast": f"""
            SELECT a.day AS forecast_date, c.anchor AS created_on, c.region_code, c.warehouse, c.dataset_id * 2 + 1 AS params_id,
                   CASE WHEN a.product_id % 10 = 8 AND k % 2 = 0 THEN a.product_id + 1 ELSE a.product_id END AS product_id,
                   CASE WHEN a.product_id % 10 = 8 AND k % 2 = 0 THEN a.demand * (1 + k / 16::DOUBLE) / 4
                        ELSE a.demand * (1 + k / 16::DOUBLE) END AS quantity, k
            FROM v_actual a
            JOIN v_case c ON c.dataset_id = a.dataset_id AND a.day BETWEEN c.anchor AND c.anchor + {HORIZON_DAYS}
            JOIN (VALUES (1), (2), (3), (4), (5), (6), (7), (8)) AS t(k) ON a.product_id % 8 <> k - 1""",
        "v_cohort": """
            SELECT c.anchor, c.dataset_id, c.region_code, c.warehouse, COALESCE(new_id, l.product_id) AS product_id,
                   CASE WHEN BOOL_OR(l.first_party) THEN '1pl' ELSE '3pl' END AS warehouse_type
            FROM v_case c
            JOIN v_header h ON h.region_code = c.region_code AND h.status = 1 AND h.close_date >= c.anchor - 30
            JOIN v_line l ON l.order_id = h.order_id AND NOT l.deleted
            LEFT JOIN v_sku ON old_id = l.product_id
            GROUP BY 1, 2, 3, 4, 5
            HAVING c.warehouse NOT IN ('W0', 'W1', 'W2') OR (c.warehouse = 'W2') = (NOT BOOL_OR(l.first_party))""",
        "v_clean": f"""
            SELECT c.anchor, c.dataset_id, a.day, c.region_code, c.warehouse, COALESCE(new_id, a.product_id) AS product_id,
                   SUM(a.demand * COALESCE(factor, 1)) AS demand
            FROM v_actual a LEFT JOIN v_sku ON old_id = a.product_id
            JOIN v_case c ON c.dataset_id = a.dataset_id AND a.day BETWEEN c.anchor AND c.anchor + {HORIZON_DAYS}
            JOIN v_cohort t ON t.anchor = c.anchor AND t.dataset_id = c.dataset_id
                           AND t.product_id = COALESCE(new_id, a.product_id)
            GROUP BY 1, 2, 3, 4, 5, 6""",
        "v_sold": f"""
            SELECT c.anchor, c.dataset_id, c.warehouse, h.close_date AS day, COALESCE(new_id, l.product_id) AS product_id,
                   SUM(l.quantity * l.price) AS value
            FROM v_case c
            JOIN v_setup u ON u.region_code = c.region_code AND u.warehouse = c.warehouse
            JOIN v_group g ON g.wh = u.warehouse
            JOIN v_header h ON h.region_code = c.region_code AND h.status = 1
                 AND (u.warehouse = 'ALL' OR h.warehouse = u.warehouse)
                 AND h.close_date BETWEEN c.anchor AND c.anchor + {HORIZON_DAYS}
                 AND h.close_date >= u.live_from AND h.close_date <= COALESCE(u.live_to, {TODAY} + 1000)
            JOIN v_zone_hit z ON z.order_id = h.order_id AND z.zone = g.zone
            JOIN v_line l ON l.order_id = h.order_id AND NOT l.deleted
            LEFT JOIN v_sku ON old_id = l.product_id
            JOIN v_cohort t ON t.anchor = c.anchor AND t.dataset_id = c.dataset_id
                           AND t.product_id = COALESCE(new_id, l.product_id)
            WHERE COALESCE(new_id, l.product_id) NOT IN
                  (SELECT element FROM v_block b WHERE b.kind = 'product' AND b.region_code = c.region_code)
            GROUP BY 1, 2, 3, 4, 5""",
        "v_share": """
            SELECT anchor, dataset_id, day, product_id, value / SUM(value) OVER (PARTITION BY anchor, dataset_id, day) AS share
            FROM v_sold""",
        "v_predicted": f"""
            SELECT c.anchor, c.dataset_id, f.k, f.forecast_date, f.created_on, f.region_code, f.warehouse, f.params_id,
                   {timeframe_sql("f.created_on", "f.forecast_date")} AS timeframe,
                   COALESCE(new_id, f.product_id) AS product_id,
                   COALESCE(SUM(f.quantity * COALESCE(factor, 1)), 0) AS forecast
            FROM v_forecast f LEFT JOIN v_sku ON old_id = f.product_id
            JOIN v_case c ON c.anchor = f.created_on AND c.region_code = f.region_code AND c.warehouse = f.warehouse
            JOIN v_cohort t ON t.anchor = c.anchor AND t.dataset_id = c.dataset_id
                           AND t.product_id = COALESCE(new_id, f.product_id)
            GROUP BY ALL""",
        "v_wide": "SELECT anchor, dataset_id, forecast_date, region_code, warehouse, product_id, timeframe, "
        + ", ".join(f"COALESCE(SUM(forecast) FILTER (WHERE k = {k}), 0) AS f{k}" for k in DESIGN)
        + " FROM v_predicted GROUP BY ALL",
        # The same for each catalog category.
        "v_clean_cat": """
            SELECT v.*, category FROM v_clean v JOIN v_catalog k ON k.product_id = v.product_id AND k.warehouse = v.warehouse""",
        "v_share_cat": """
            SELECT anchor, dataset_id, category, day, v.product_id,
                   value / SUM(value) OVER (PARTITION BY anchor, dataset_id, category, day) AS share
            FROM v_sold v JOIN v_catalog k ON k.product_id = v.product_id AND k.warehouse = v.warehouse""",
        "v_wide_cat": """
            SELECT v.*, category FROM v_wide v JOIN v_catalog k ON k.product_id = v.product_id AND k.warehouse = v.warehouse""",
    }
)


def _errors_sql(wide: str, clean: str, share: str, category: bool) -> str:
    keys = "w.anchor, w.dataset_id, " + ("w.category, " if category else "")
    same = " AND {0}.category = w.category" if category else ""
    plain = keys.replace("w.", "")
    cells = ", ".join(
        f"CASE WHEN demand = 0 AND f{k} > 0 THEN 100 WHEN demand = 0 AND f{k} = 0 THEN 0 "
        f"ELSE 100 * ABS(f{k} - demand) / NULLIF(demand, 0) END::DOUBLE AS e{k}"
        for k in DESIGN
    )
    return f"""
        SELECT {plain} forecast_date, region_code, warehouse, product_id, timeframe, demand,
               {", ".join(f"f{k}" for k in DESIGN)}, {cells},
               COALESCE(CASE WHEN SUM(share) OVER p > 0 THEN share / SUM(share) OVER p ELSE 0 END, 0) AS share
        FROM (SELECT {keys} w.forecast_date, d.region_code, w.warehouse, w.product_id, w.timeframe, d.demand, s.share,
                     {", ".join(f"w.f{k}" for k in DESIGN)}
              FROM {wide} w
              JOIN {clean} d ON d.anchor = w.anchor AND d.dataset_id = w.dataset_id AND d.day = w.forecast_date
                            AND d.product_id = w.product_id{same.format("d")}
              LEFT JOIN {share} s ON s.anchor = w.anchor AND s.dataset_id = w.dataset_id AND s.day = w.forecast_date
                            AND s.product_id = w.product_id{same.format("s")})
        WINDOW p AS (PARTITION BY {plain} forecast_date, timeframe)"""


def _rollup_sql(errors: str, category: bool) -> str:
    keys = "anchor, dataset_id, " + ("category, " if category else "")
    return (
        f"SELECT {keys} forecast_date, region_code, warehouse, timeframe, "
        + ", ".join(f"SUM(e{k} * share) AS mafe_exp{k}" for k in DESIGN)
        + f" FROM {errors} GROUP BY ALL"
    )


VIEWS["v_error"] = _errors_sql("v_wide", "v_clean", "v_share", False)
VIEWS["v_error_cat"] = _errors_sql("v_wide_cat", "v_clean_cat", "v_share_cat", True)
VIEWS["v_mafe"] = _rollup_sql("v_error", False)
VIEWS["v_mafe_cat"] = _rollup_sql("v_error_cat", True)


# Forecasts of every live setup, and the outer joins written out.
VIEWS["v_forecast_live"] = f"""
    SELECT a.day AS forecast_date, c.anchor AS created_on, c.region_code, c.warehouse, u.params_id,
           CASE WHEN a.product_id % 10 = 8 AND k % 2 = 0 THEN a.product_id + 1 ELSE a.product_id END AS product_id,
           CASE WHEN a.product_id % 10 = 8 AND k % 2 = 0 THEN a.demand * (1 + k / 16::DOUBLE) / 4
                ELSE a.demand * (1 + k / 16::DOUBLE) END AS quantity, k
    FROM v_actual a
    JOIN v_case c ON c.dataset_id = a.dataset_id AND a.day BETWEEN c.anchor AND c.anchor + {HORIZON_DAYS}
    JOIN v_setup u ON u.dataset_id = a.dataset_id AND a.day BETWEEN u.live_from AND COALESCE(u.live_to, {TODAY} + 1000)
    JOIN (VALUES (1), (2), (3), (4), (5), (6), (7), (8)) AS t(k)
      ON a.product_id % 8 <> k - 1 AND (u.params_id % 2 = 1 OR k <= 4)"""
VIEWS["v_predicted_live"] = VIEWS["v_predicted"].replace("v_forecast f", "v_forecast_live f")
_CHAIN_KEYS = ("anchor", "dataset_id", "forecast_date", "region_code", "warehouse", "product_id", "timeframe")
VIEWS["v_wide_chain"] = (
    "SELECT "
    + ", ".join(f"COALESCE({', '.join(f'e{k}.{key}' for k in DESIGN)}) AS {key}" for key in _CHAIN_KEYS)
    + ", "
    + ", ".join(f"SUM(COALESCE(e{k}.forecast, 0)) AS f{k}" for k in DESIGN)
    + " FROM (SELECT * FROM v_predicted_live WHERE k = 1) e1 "
    + " ".join(
        f"FULL OUTER JOIN (SELECT * FROM v_predicted_live WHERE k = {k}) e{k} ON "
        + " AND ".join(f"e1.{key} = e{k}.{key}" for key in ("anchor", "dataset_id", "forecast_date", "product_id", "timeframe"))
        for k in DESIGN
        if k > 1
    )
    + " GROUP BY ALL"
)
VIEWS["v_error_chain"] = _errors_sql("v_wide_chain", "v_clean", "v_share", False)
VIEWS["v_mafe_chain"] = _rollup_sql("v_error_chain", False)


def statement(query: str) -> str:
    """The query with every view it needs, directly or not, in order."""
    needed: set[str] = set()
    waiting = [query]
    while waiting:
        for name in set(re.findall(r"\bv_\w+", waiting.pop())) - needed:
            needed.add(name)
            waiting.append(VIEWS[name])
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in _ordered(needed))
    return f"WITH {views}\n{query}" if views else query


def _ordered(names: set[str]) -> list[str]:
    placed: list[str] = []
    while len(placed) < len(names):
        for name in VIEWS:
            inputs = set(re.findall(r"\bv_\w+", VIEWS[name]))
            if name in names and name not in placed and inputs <= set(placed):
                placed.append(name)
    return placed
