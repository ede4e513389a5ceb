"""The same queries as plain SQL for DuckDB."""

from __future__ import annotations

from validation.adapter import AS_OF
from validation.views import DESIGN, demand_sql, statement, timeframe_sql

_LINE_COLUMNS = (
    "close_date, product_id, quantity, dataset_id AS dp_input_datasets_id, region_code, weight AS stockout_weight"
)
_LINE_DEMAND = (
    "close_date AS date, product_id, dataset_id AS dp_input_datasets_id, region_code, weight AS stockout_weight, "
    "ROUND(quantity, 6) AS quantity"
)
_CASE = "anchor, dataset_id AS dp_input_datasets_id"
_MEANS = ", ".join(f"AVG(mafe_exp{k}) AS mafe_exp{k}" for k in DESIGN)
_ROUNDED = ", ".join(f"ROUND(mafe_exp{k}, 6) AS mafe_exp{k}" for k in DESIGN)
_ERRORS = ", ".join(f"ROUND(e{k}, 6) AS mafe_exp{k}" for k in DESIGN)
_FORECASTS = ", ".join(f"ROUND(f{k}, 6) AS forecast_exp{k}" for k in DESIGN)
_BY_HORIZON = f"SELECT timeframe, {_MEANS} FROM v_mafe GROUP BY timeframe"
_FULL_LOAD = """
    SELECT COALESCE(q.close_date, s.close_date) AS date, COALESCE(q.product_id, s.product_id) AS product_id,
           ROUND(SUM(COALESCE(q.quantity, 0) + COALESCE(s.stockouts, 0)), 6) AS demand,
           COALESCE(q.dataset_id, s.dataset_id) AS dp_input_datasets_id
    FROM v_kept_6 q FULL OUTER JOIN v_stockout_region s
      ON s.dataset_id = q.dataset_id AND s.product_id = q.product_id AND s.close_date = q.close_date
    GROUP BY 1, 2, 4"""
_DAY = f"day = DATE '{AS_OF.isoformat()}'"
_COUNTRY_LOAD = f"""
    SELECT f.* FROM ({_FULL_LOAD}) f JOIN v_dataset d ON d.dataset_id = f.dp_input_datasets_id
    WHERE LOWER(d.country) = LOWER('c1')"""
_START_DATES = f"""
    SELECT dp_input_datasets_id, product_id, MIN(date) AS start_demand_date FROM ({_COUNTRY_LOAD}) GROUP BY 1, 2"""
_OTHER_DATASET = f"SELECT DATE '{AS_OF}', -4, 1.0, 99, 'experiment_1'"


def _stored_sql(condition: str) -> str:
    """All variants on the days and datasets of the condition."""
    return " UNION ALL ".join(f"({demand_sql(k, condition)})" for k in DESIGN)


_ALL_VARIANTS_ON_DAY = " UNION ALL ".join(f"({demand_sql(k, _DAY)})" for k in DESIGN)


def _design_rows() -> str:
    runs = []
    for k, levels in DESIGN.items():
        plain = ", ".join(f"{level} AS {name}" for name, level in zip("abcd", levels))
        coded = ", ".join(f"{2 * level - 1} AS {name}f" for name, level in zip("abcd", levels))
        runs.append(
            f"SELECT dataset_id AS dp_input_datasets_id, {k} AS experiment, ROUND(AVG(mafe_exp{k}), 6) AS y, "
            f"{plain}, {coded} FROM v_mafe WHERE timeframe = 2 GROUP BY dataset_id"
        )
    return " UNION ALL ".join(runs)


_SQL: dict[str, str] = {
    "working_day_orders": "SELECT order_id AS id, region_code, close_date FROM v_closed",
    "country_orders": """
        SELECT order_id AS id, region_code, LOWER(country) AS country FROM v_header JOIN v_site USING (region_code)
        WHERE LOWER(country) = LOWER('c0')""",
    "region_fanout": """
        SELECT order_id AS id, region_code, close_date, LOWER(country) AS country, d.warehouse AS dataset_warehouse,
               dataset_id AS dataset_identifier, weight AS stockout_weight
        FROM v_header JOIN v_dataset d USING (region_code)""",
    "shipping_horizon": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS line, dayofweek(l_shipdate) <> 0 AS working_day,
               {timeframe_sql("CAST(o_orderdate AS DATE)", "CAST(l_shipdate AS DATE)")} AS timeframe
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "sku_remap": """
        SELECT order_id, COALESCE(new_id, product_id) AS product_id, quantity * COALESCE(factor, 1) AS quantity
        FROM v_line LEFT JOIN v_sku ON old_id = product_id WHERE NOT deleted""",
    "zone_join": """
        SELECT order_id AS id, region_code, site_id * 10 + zone AS microzone_id
        FROM v_zone_hit JOIN v_site USING (region_code)""",
    "zone_group_join": """
        SELECT order_id AS id, 'G' || site_id || '_' || wh AS microzone_group_code, site_id * 10 + zone AS microzone_id
        FROM v_zone_hit JOIN v_site USING (region_code) JOIN v_group USING (zone)""",
    "zone_order_routes": """
        SELECT order_id AS id, user_id, close_date, region_code, dataset_id AS dataset_identifier FROM v_zone_order""",
    "kam_lines": f"""
        SELECT {_LINE_COLUMNS}
        FROM (SELECT r.*, l.product_id, l.quantity FROM v_account_order r
              JOIN v_line l ON l.order_id = r.order_id AND NOT l.deleted) r
        WHERE order_id NOT IN (SELECT element FROM v_block b WHERE b.kind = 'order' AND b.region_code = r.region_code)
          AND product_id NOT IN
              (SELECT element FROM v_block b WHERE b.kind = 'product' AND b.region_code = r.region_code)""",
    "order_lines_all": f"SELECT {_LINE_COLUMNS} FROM v_lines_all",
    "order_lines_bucketed": f"SELECT {_LINE_COLUMNS} FROM v_lines_all",
    "order_lines_user_blacklist": f"SELECT {_LINE_COLUMNS} FROM v_lines_open",
    "line_stats": """
        SELECT dataset_id AS dp_input_datasets_id, product_id, ROUND(mean, 6) AS average, ROUND(sd, 6) AS std_dev
        FROM v_stats_all""",
    "line_p99": """
        SELECT dataset_id AS dp_input_datasets_id, product_id, ROUND(p99, 6) AS percentile_99 FROM v_stats_all""",
    "line_demand_unfiltered": f"SELECT {_LINE_DEMAND} FROM v_kept_1",
    "line_demand_six_sigma": f"SELECT {_LINE_DEMAND} FROM v_kept_2",
    "line_demand_p99": f"SELECT {_LINE_DEMAND} FROM v_kept_3",
    "line_demand_six_sigma_p99": f"SELECT {_LINE_DEMAND} FROM v_kept_4",
    "stockouts_by_wh": """
        SELECT close_date, product_id, region_code, dataset_id AS dataset_identifier, ROUND(stockouts, 6) AS stockouts
        FROM v_stockout_wh""",
    "stockouts_no_wh": """
        SELECT close_date, product_id, region_code, dataset_id AS dataset_identifier, ROUND(stockouts, 6) AS stockouts
        FROM v_stockout_region""",
    **{f"demand_exp{k}": demand_sql(k) for k in DESIGN},
    "demand_all_variants": " UNION ALL ".join(f"({demand_sql(k)})" for k in DESIGN),
    "demand_day_variants": _ALL_VARIANTS_ON_DAY,
    "demand_day_from_lines": _ALL_VARIANTS_ON_DAY,
    "line_state_counts": """
        SELECT l.close_date, l.product_id, l.quantity, l.dataset_id AS dp_input_datasets_id, l.user_listed, COUNT(*) AS line_count
        FROM (SELECT close_date, product_id, quantity, dataset_id, false AS user_listed FROM v_lines_open
              UNION ALL
              (SELECT close_date, product_id, quantity, dataset_id, true FROM
                 (SELECT close_date, product_id, quantity, dataset_id FROM v_lines_all
                  EXCEPT ALL SELECT close_date, product_id, quantity, dataset_id FROM v_lines_open))) l
        GROUP BY ALL""",
    "demand_exp1_one_dataset": demand_sql(1, "dataset_id = 11"),
    "demand_exp2_june_history": f"""
        SELECT * EXCLUDE (experiment) FROM ({demand_sql(2)}) WHERE date >= DATE '2001-06-01'""",
    "demand_exp2_june": demand_sql(2, "day >= DATE '2001-06-01'"),
    "zscore_days": """
        SELECT day AS date, product_id, dataset_id AS dp_input_datasets_id, ROUND(demand, 6) AS demand,
               ROUND(z, 6) AS z_score FROM v_scored_1""",
    "full_load_daily": _FULL_LOAD,
    "full_load_stored": _COUNTRY_LOAD,
    "full_load_twice": _COUNTRY_LOAD,
    "all_dates": f"SELECT DISTINCT date AS raw_date FROM ({_FULL_LOAD}) WHERE dayofweek(date) <> 0",
    "all_dates_stored": f"SELECT DISTINCT date AS raw_date FROM ({_COUNTRY_LOAD}) WHERE dayofweek(date) <> 0",
    "start_demand_dates": _START_DATES,
    "start_dates_stored": _START_DATES,
    "daily_run_stored": f"""
        SELECT * FROM ({_stored_sql(f"{_DAY} AND dataset_id = 10")})
        UNION ALL SELECT DATE '{AS_OF}' - 1, -3, 1.0, 10, 'experiment_1' UNION ALL {_OTHER_DATASET}""",
    "dataset_replaced_stored": f"{_stored_sql('dataset_id = 10')} UNION ALL {_OTHER_DATASET}",
    "latest_forecast_params": """
        SELECT dataset_id AS dp_input_datasets_id, region_code, warehouse, MAX(params_id) AS dp_forecast_params_id
        FROM v_every_setup GROUP BY ALL""",
    "regular_warehouses": """
        SELECT region_code, 'W' || n AS warehouse, CASE n WHEN 2 THEN 'True' ELSE 'False' END AS is_3pl
        FROM v_site, range(3) AS t(n)""",
    "order_days_csv": """
        SELECT anchor, dataset_id AS dp_input_datasets_id, region_code, warehouse, 40 AS days
        FROM v_dataset, (SELECT DISTINCT close_date AS anchor FROM v_header)""",
    "mafe_csv_round_trip": f"SELECT {_CASE}, forecast_date, region_code, warehouse, timeframe, {_ROUNDED} FROM v_mafe",
    "cohort": f"SELECT {_CASE}, region_code, warehouse, product_id, warehouse_type FROM v_cohort",
    "clean_demand": f"""
        SELECT {_CASE}, day AS close_date, region_code, product_id, ROUND(demand, 6) AS demand FROM v_clean""",
    "gmv_share": f"SELECT {_CASE}, day AS close_date, product_id, ROUND(share, 6) AS share FROM v_share",
    "gmv_share_category": f"""
        SELECT {_CASE}, category, day AS close_date, product_id, ROUND(share, 6) AS share FROM v_share_cat""",
    "forecast_by_experiment": f"""
        SELECT {_CASE}, 'experiment_' || k AS experiment, forecast_date, created_on, region_code, warehouse,
               params_id AS dp_forecast_params_id, timeframe, product_id, ROUND(forecast, 6) AS forecast
        FROM v_predicted""",
    "forecast_wide": f"""
        SELECT {_CASE}, forecast_date, region_code, warehouse, product_id, timeframe, {_FORECASTS} FROM v_wide""",
    "repeated_forecasts": f"""
        SELECT {_CASE}, 'experiment_' || k AS experiment, forecast_date, product_id, timeframe, COUNT(*) AS setups
        FROM v_predicted_live GROUP BY ALL HAVING COUNT(*) > 1""",
    "forecast_chain": f"""
        SELECT {_CASE}, forecast_date, region_code, warehouse, product_id, timeframe, {_FORECASTS} FROM v_wide_chain""",
    "mafe_warehouse_chain": f"""
        SELECT {_CASE}, forecast_date, region_code, warehouse, timeframe, {_ROUNDED} FROM v_mafe_chain""",
    "demand_by_view": f"""
        SELECT dp_input_datasets_id, date, ROUND(SUM(demand), 6) AS demand, COUNT(*) AS products
        FROM ({demand_sql(1)}) GROUP BY ALL""",
    "mafe_product": f"""
        SELECT {_CASE}, forecast_date, warehouse, product_id, timeframe, ROUND(demand, 6) AS demand, {_FORECASTS},
               {_ERRORS}, ROUND(share, 6) AS share FROM v_error""",
    "mafe_warehouse": f"SELECT {_CASE}, forecast_date, region_code, warehouse, timeframe, {_ROUNDED} FROM v_mafe",
    "mafe_category": f"""
        SELECT {_CASE}, category, forecast_date, region_code, warehouse, timeframe, {_ROUNDED} FROM v_mafe_cat""",
    "mafe_by_timeframe": f"SELECT timeframe, {_ROUNDED} FROM ({_BY_HORIZON})",
    "mafe_sum_by_timeframe": "SELECT timeframe, CAST(SUM(product_id) AS BIGINT) AS product_id, ROUND(SUM(demand), 6) AS demand, "
    + ", ".join(f"ROUND(SUM(f{k}), 6) AS forecast_exp{k}, ROUND(SUM(e{k}), 6) AS mafe_exp{k}" for k in DESIGN)
    + ", ROUND(SUM(share), 6) AS share FROM v_error GROUP BY timeframe",
    "exp6_higher": f"""
        SELECT {_CASE}, forecast_date, product_id, timeframe, CASE WHEN e6 > e5 THEN 1 ELSE 0 END AS exp6_higher
        FROM v_error""",
    "design_matrix": _design_rows(),
    "variant_comparison": f"""
        SELECT timeframe, {_ROUNDED}, ROUND(mafe_exp6 - mafe_exp5, 6) AS comp FROM ({_BY_HORIZON})""",
    "mafe_overall": "SELECT ROUND(AVG(timeframe), 6) AS timeframe, "
    + ", ".join(f"ROUND(AVG(mafe_exp{k}), 6) AS mafe_exp{k}" for k in DESIGN)
    + f", ROUND(AVG(mafe_exp6 - mafe_exp5), 6) AS comp FROM ({_BY_HORIZON})",
}

ORACLE = {name: statement(sql) for name, sql in _SQL.items()}
