"""The registered queries as SQL over the test tables, written independently of the Spark code.

``TABLES`` holds the derived tables as common table expressions; ``sql`` puts the needed ones before a
select. Doubles are rounded to six decimals, dates and decimals take the same form as in the registry.
"""

from __future__ import annotations

import re

from shelfline.functions.lookups import MODEL_FEATURES
from testbed.tables import PRODUCTS

ORACLES: dict[str, str] = {}


def r(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) + 0.0 AS {name}"


def rs(*columns: str) -> str:
    return ", ".join(r(c, c) for c in columns)


def n(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


def i(expression: str, name: str) -> str:
    return f"CAST({expression} AS INTEGER) AS {name}"


def d(column: str = "date", name: str | None = None) -> str:
    return f"CAST(CAST({column} AS DATE) AS VARCHAR) AS {name or column}"


def title(column: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower(trim({column})), '([a-z]+|[^a-z]+)'), "
            f"lambda p: upper(p[1]) || p[2:]), '')")


def dec(expression: str, kind: str = "DECIMAL(12,2)") -> str:
    """Exact half-even rounding of the binary value, by way of its printed form."""
    return f"CAST(format('{{:.2f}}', CAST({expression} AS DOUBLE)) AS {kind})"


SIZE = "CASE {0} WHEN 'A' THEN 'Large' WHEN 'B' THEN 'Medium-Large' WHEN 'C' THEN 'Small' " \
       "WHEN 'D' THEN 'Medium' WHEN 'E' THEN 'Medium-Small' END"
TYPE_CODE = "CASE {0} WHEN 'A' THEN 5 WHEN 'B' THEN 4 WHEN 'C' THEN 1 WHEN 'D' THEN 3 WHEN 'E' THEN 2 ELSE 0 END"
CATEGORY_CODE = "CASE {0} WHEN 'FMCG' THEN 3 WHEN 'Fresh' THEN 2 WHEN 'Non-Food' THEN 1 ELSE 0 END"
AVG_RANK = "(rank() OVER (ORDER BY {0} DESC) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0)"

CAL = {
    "year": "year({0})", "month": "month({0})", "day_of_week": "isodow({0}) - 1", "day_of_month": "day({0})",
    "week_of_year": "weekofyear({0})", "quarter": "quarter({0})", "day_of_year": "dayofyear({0})",
    "is_weekend": "CASE WHEN isodow({0}) >= 6 THEN 1 ELSE 0 END",
    "is_month_start": "CASE WHEN day({0}) = 1 THEN 1 ELSE 0 END",
    "is_month_end": "CASE WHEN last_day({0}) = {0} THEN 1 ELSE 0 END",
}
SEASON = {
    "is_ramadan_period": "CASE WHEN month({0}) IN (3, 4) THEN 1 ELSE 0 END",
    "is_eid_preparation": "CASE WHEN month({0}) IN (4, 6) AND day({0}) >= 15 THEN 1 ELSE 0 END",
    "is_summer_peak": "CASE WHEN month({0}) IN (5, 6, 7, 8) THEN 1 ELSE 0 END",
    "is_wedding_season": "CASE WHEN month({0}) IN (11, 12, 1, 2) THEN 1 ELSE 0 END",
    "is_school_season": "CASE WHEN month({0}) IN (3, 8, 9) THEN 1 ELSE 0 END",
    "is_payday_week": "CASE WHEN day({0}) <= 7 THEN 1 ELSE 0 END",
    "is_friday": "CASE WHEN isodow({0}) = 5 THEN 1 ELSE 0 END",
    "is_end_of_month": "CASE WHEN day({0}) >= 25 THEN 1 ELSE 0 END",
}


def parts(table: dict[str, str], column: str) -> str:
    return ", ".join(i(e.format(column), c) for c, e in table.items())


def window(rows: int) -> str:
    return f"OVER (PARTITION BY store_id, family ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


W = "OVER (PARTITION BY store_id, family ORDER BY date)"
LAGS = {f"sales_lag_{k}d": f"lag(sales, {k}) {W}" for k in (7, 14, 28)}
MEANS = {f"sales_rolling_mean_{k}d": f"avg(sales) {window(k)}" for k in (7, 14, 30)}
STDS = {f"sales_rolling_std_{k}d": f"coalesce(stddev_samp(sales) {window(k)}, 0)" for k in (7, 14)}
RANGE = {"sales_rolling_max_7d": f"max(sales) {window(7)}", "sales_rolling_min_7d": f"min(sales) {window(7)}"}
ROW_DIGEST = "md5(concat_ws('|', store_id, family, CAST(CAST(date AS DATE) AS VARCHAR)))"
DRAWN = f"(year >= 2001 OR CAST('0x' || substr({ROW_DIGEST}, 1, 6) AS BIGINT) % 100 < 15)"
FACT_MEASURES = ("sales", *(f"sales_lag_{k}d" for k in (7, 14, 28)), *(f"sales_rolling_mean_{k}d" for k in (7, 14, 30)),
                 "sales_rolling_std_7d", "sales_rolling_std_14d", "sales_trend_7d", "store_avg_daily_sales", "family_avg_sales",
                 "store_product_avg", "oil_price")
TREND = {"sales_trend_7d": f"avg(sales) {window(7)} - avg(sales) {window(30)}"}


def cols(table: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in table.items())


def rcols(table: dict[str, str]) -> str:
    return ", ".join(r(e, c) for c, e in table.items())


SEED = ", ".join(str(row) for row in PRODUCTS)

TABLES = {
    "lines": """SELECT CAST(l_shipdate AS DATE) AS date, s_nationkey AS store_nbr, p_type AS family, l_quantity AS qty,
        CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS promo
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
    "raw_sales": """SELECT d.date, k.store_nbr, k.family, CAST(coalesce(o.sales, 0) AS DOUBLE) AS sales,
        CAST(coalesce(o.onpromotion, 0) AS INTEGER) AS onpromotion
        FROM (SELECT DISTINCT store_nbr, family FROM lines) k CROSS JOIN (SELECT DISTINCT date FROM lines) d
        LEFT JOIN (SELECT store_nbr, family, date, sum(qty) AS sales, sum(promo) AS onpromotion FROM lines
                   GROUP BY ALL) o
        ON o.store_nbr = k.store_nbr AND o.family = k.family AND o.date = d.date""",
    "panel": "SELECT store_nbr AS store_id, family, date, sales, onpromotion FROM raw_sales",
    "raw_stores": """SELECT n_nationkey AS store_nbr, ' ' || lower(n_name) || ' ' AS city, r_name AS state,
        lower(chr(65 + n_nationkey % 5)) AS type, n_regionkey AS cluster
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "order_days": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders",
    "raw_holidays": """SELECT CASE WHEN m = 5 THEN 'not-a-date' ELSE CAST(day AS VARCHAR) END AS date, type, locale,
        description, transferred FROM (
        SELECT min(day) AS day, month(day) AS m,
            CASE month(day) % 4 WHEN 0 THEN ' Holiday ' WHEN 1 THEN 'EVENT' WHEN 2 THEN 'Additional' ELSE 'Bridge' END
            AS type, CASE month(day) % 3 WHEN 0 THEN 'National' WHEN 1 THEN 'Regional ' END AS locale,
            ' First orders of month ' || month(day) || ' ' AS description, month(day) % 6 = 0 AS transferred
        FROM order_days GROUP BY year(day), month(day)
        UNION ALL
        SELECT min(day), month(min(day)), 'Holiday', 'NATIONAL', 'Quarter ' || quarter(day), false
        FROM order_days GROUP BY year(day), quarter(day))""",
    "raw_oil": """SELECT CAST(o_orderdate AS DATE) AS date,
        CASE WHEN isodow(CAST(o_orderdate AS DATE)) < 6 THEN max(o_totalprice) / 1000 END AS dcoilwtico
        FROM orders GROUP BY CAST(o_orderdate AS DATE)""",
    "raw_cpi": """SELECT make_date(y, m, 1) AS date, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month,
        CAST(split_part(item_name, '#', 2) AS INTEGER) AS item_id, item_name,
        max(city_price) OVER (PARTITION BY y, m, item_name) AS national_avg_price,
        CASE WHEN disc < 0.1 THEN disc * 100 END AS pct_change, city, city_price FROM (
        SELECT year(l_shipdate) AS y, month(l_shipdate) AS m, p_brand AS item_name, n_name AS city,
            max(l_extendedprice) AS city_price, max(l_discount) AS disc
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey GROUP BY ALL)""",
    "seed": f"SELECT * FROM (VALUES {SEED}) v(family, category, subcategory, is_fmcg, is_perishable)",
    "base": """SELECT date, store_nbr, family, CASE WHEN sales < 0 THEN 0 ELSE sales END AS sales,
        CASE WHEN onpromotion > 0 THEN 1 ELSE 0 END AS onpromotion, onpromotion AS onpromotion_count
        FROM (SELECT DISTINCT * FROM raw_sales)""",
    "capped": """SELECT date, store_nbr, family, least(sales, (SELECT quantile_cont(sales, 0.995) FROM base)) AS sales,
        onpromotion, onpromotion_count FROM base""",
    "totals": "SELECT date, sum(sales) AS total FROM capped GROUP BY date",
    "odd_days": "SELECT date FROM totals WHERE total < (SELECT quantile_cont(total, 0.01) FROM totals)",
    "clean_sales": """SELECT date, store_nbr, upper(trim(family)) AS family, sales, onpromotion, onpromotion_count,
        CASE WHEN date IN (SELECT date FROM odd_days) THEN 1 ELSE 0 END AS is_anomaly_day FROM capped""",
    "clean_stores": f"""SELECT store_nbr, {title('city')} AS city, {title('state')} AS state, upper(trim(type)) AS type,
        cluster, {SIZE.format('upper(trim(type))')} AS store_size FROM raw_stores""",
    "clean_holidays": """SELECT try_cast(date AS DATE) AS date, lower(trim(type)) AS type, locale,
        trim(description) AS description, transferred,
        CASE WHEN lower(locale) LIKE '%national%' THEN 1 ELSE 0 END AS is_national
        FROM raw_holidays WHERE try_cast(date AS DATE) IS NOT NULL AND NOT transferred""",
    "clean_oil": """SELECT date, coalesce(
        last_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        AS dcoilwtico FROM raw_oil""",
    "known_prices": "SELECT date, dcoilwtico FROM raw_oil WHERE dcoilwtico IS NOT NULL",
    "day_prices": """SELECT s.date, coalesce(
        (SELECT arg_max(k.dcoilwtico, k.date) FROM known_prices k WHERE k.date <= s.date),
        (SELECT arg_min(k.dcoilwtico, k.date) FROM known_prices k)) AS price
        FROM (SELECT DISTINCT date FROM lines) s""",
    "holiday_days": "SELECT date, 1 AS is_holiday, max(is_national) AS is_national FROM clean_holidays GROUP BY date",
    "merged": """SELECT s.date, s.store_nbr AS store_id, s.family, s.sales, s.onpromotion, s.onpromotion_count,
        s.is_anomaly_day, t.city, t.state, t.type AS store_type, t.cluster, t.store_size,
        coalesce(h.is_holiday, 0) AS is_holiday, coalesce(h.is_national, 0) AS is_national_holiday,
        p.price AS oil_price
        FROM clean_sales s LEFT JOIN clean_stores t ON s.store_nbr = t.store_nbr
        LEFT JOIN holiday_days h ON h.date = s.date LEFT JOIN day_prices p ON p.date = s.date""",
    "store_means": "SELECT store_id, avg(sales) AS store_avg_daily_sales FROM merged GROUP BY store_id",
    "family_means": f"""SELECT family, family_avg_sales, {AVG_RANK.format('total')} AS family_popularity_rank
        FROM (SELECT family, avg(sales) AS family_avg_sales, sum(sales) AS total FROM merged GROUP BY family)""",
    "history": f"""SELECT *, {cols(LAGS)}, {cols(MEANS)}, {cols(STDS)}, {cols(RANGE)},
        CASE WHEN sales = 0 THEN 1 ELSE 0 END AS is_zero_sale, row_number() {W} AS pos,
        avg(sales) OVER (PARTITION BY store_id, family) AS store_product_avg FROM merged""",
    "featured": f"""SELECT h.* EXCLUDE (pos, sales_lag_7d, sales_lag_14d, sales_lag_28d),
        coalesce(sales_lag_7d, 0) AS sales_lag_7d, coalesce(sales_lag_14d, 0) AS sales_lag_14d,
        coalesce(sales_lag_28d, 0) AS sales_lag_28d,
        sales_rolling_mean_7d - sales_rolling_mean_30d AS sales_trend_7d,
        sum(is_zero_sale) {window(7)} AS zero_sales_last_7d,
        pos - coalesce(max(CASE WHEN is_zero_sale = 0 THEN pos END) {W}, 0) AS consecutive_zeros,
        {parts(CAL, 'date')}, {parts(SEASON, 'date')}, store_avg_daily_sales, family_avg_sales,
        family_popularity_rank,
        sales / CASE WHEN store_avg_daily_sales = 0 THEN 1 ELSE store_avg_daily_sales END AS sales_vs_store_avg
        FROM history h JOIN store_means USING (store_id) JOIN family_means USING (family)""",
    "days": """SELECT CAST(unnest(generate_series(date_trunc('year', min(date)),
        date_trunc('year', max(date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS full_date
        FROM lines""",
    "dim_date": f"""SELECT {i('year(full_date) * 10000 + month(full_date) * 100 + day(full_date)', 'date_key')}, full_date,
        {parts(CAL, 'full_date')}, monthname(full_date) AS month_name, dayname(full_date) AS day_name,
        {parts(SEASON, 'full_date')}, coalesce(is_holiday, 0) AS is_holiday,
        coalesce(is_national, 0) AS is_national_holiday
        FROM days LEFT JOIN holiday_days h ON h.date = full_date""",
    "store_metrics": """SELECT store_id, avg(sales) AS avg_daily_sales, sum(sales) AS total_revenue,
        round_even(avg(is_zero_sale) * 100, 2) AS stockout_rate FROM featured GROUP BY store_id""",
    "dim_store": f"""SELECT store_nbr AS store_key, store_nbr AS store_id, city, state, type AS store_type,
        coalesce(store_size, 'Unknown') AS store_size, cluster, {dec('avg_daily_sales')} AS avg_daily_sales,
        {dec('total_revenue', 'DECIMAL(25,2)')} AS total_revenue, {dec('stockout_rate', 'DECIMAL(5,2)')} AS stockout_rate
        FROM clean_stores LEFT JOIN store_metrics ON store_nbr = store_id""",
    "dim_product": "SELECT CAST(row_number() OVER (ORDER BY family) AS INTEGER) AS product_key, * FROM seed",
    "dim_economic": f"""SELECT {i('year(date) * 10000 + month(date) * 100 + day(date)', 'date_key')}, date AS full_date,
        {dec('dcoilwtico', 'DECIMAL(8,2)')} AS oil_price,
        {dec('avg(dcoilwtico) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 'DECIMAL(8,2)')}
        AS oil_price_7d_avg,
        {dec('coalesce(dcoilwtico - lag(dcoilwtico) OVER (ORDER BY date), 0)', 'DECIMAL(8,2)')} AS oil_price_change
        FROM clean_oil WHERE date IN (SELECT full_date FROM days)""",
    "dim_cpi": f"""SELECT row_number() OVER (ORDER BY year, month, item_id, city) AS cpi_key, date, year, month, item_id,
        item_name, coalesce({dec('national_avg_price', 'DECIMAL(10,2)')}, 0) AS national_avg_price,
        coalesce({dec('pct_change', 'DECIMAL(6,2)')}, 0) AS pct_change, city,
        {dec('city_price', 'DECIMAL(10,2)')} AS city_price FROM raw_cpi""",
    "fact": f"""SELECT datediff('day', DATE '1970-01-01', date)::DECIMAL(38,0) * 100000000000000000000 + store_id::DECIMAL(38,0) * 10000000000 + product_key AS sale_key,
        date_key, store_id AS store_key, product_key, {dec('sales')} AS sales, onpromotion, onpromotion_count,
        {', '.join(f"{dec(c)} AS {c}" for c in (*LAGS, *MEANS, *STDS, *TREND))}, is_zero_sale,
        {i('zero_sales_last_7d', 'zero_sales_last_7d')}, {i('consecutive_zeros', 'consecutive_zeros')},
        {dec('store_avg_daily_sales')} AS store_avg_daily_sales, {dec('family_avg_sales')} AS family_avg_sales,
        {dec('store_product_avg')} AS store_product_avg, {dec('oil_price', 'DECIMAL(8,2)')} AS oil_price
        FROM featured f JOIN dim_product USING (family) JOIN (SELECT date_key, full_date FROM dim_date) k
        ON k.full_date = f.date""",
    "star": """SELECT d.full_date AS date, d.* EXCLUDE (date_key, full_date), s.store_id, s.city, s.state, s.store_type,
        s.store_size, s.cluster, p.family, p.category, p.subcategory, p.is_fmcg, p.is_perishable,
        f.* EXCLUDE (sale_key, date_key, store_key, product_key)
        FROM fact f JOIN dim_date d ON f.date_key = d.date_key JOIN dim_store s ON f.store_key = s.store_key
        JOIN dim_product p ON f.product_key = p.product_key""",
    "family_codes": f"""SELECT family, CAST(floor({AVG_RANK.format('total')}) AS INTEGER) AS family_encoded
        FROM (SELECT family, sum(sales) AS total FROM star GROUP BY family)""",
    "ready": f"""SELECT star.*, {i(TYPE_CODE.format('store_type'), 'store_type_encoded')}, family_encoded,
        {i(CATEGORY_CODE.format('category'), 'category_encoded')}, onpromotion * is_weekend AS promo_weekend,
        is_ramadan_period * is_fmcg AS ramadan_fmcg,
        is_wedding_season * CASE WHEN family = 'ECONOMY' THEN 1 ELSE 0 END AS wedding_grocery,
        {i('is_payday_week * ' + CATEGORY_CODE.format('category'), 'payday_spending')}
        FROM star JOIN family_codes USING (family)""",
    "analysed": """SELECT * REPLACE (CAST(sales AS DOUBLE) AS sales,
        CAST(sales_rolling_mean_7d AS DOUBLE) AS sales_rolling_mean_7d,
        CAST(sales_rolling_std_7d AS DOUBLE) AS sales_rolling_std_7d, CAST(sales_lag_7d AS DOUBLE) AS sales_lag_7d)
        FROM ready""",
    "preds": """SELECT store_id, family, date, sales AS actual, sales_lag_7d AS predicted FROM analysed
        WHERE year >= 2001""",
    "predicted": "SELECT a.*, p.predicted AS predicted_sales FROM analysed a LEFT JOIN preds p "
                 "USING (store_id, family, date)",
    "risk": """SELECT *, CASE WHEN risk_score > 0 AND risk_score <= 25 THEN 'Low' WHEN risk_score > 25 AND risk_score <= 50
        THEN 'Medium' WHEN risk_score > 50 AND risk_score <= 75 THEN 'High' WHEN risk_score > 75 AND risk_score <= 100
        THEN 'Critical' END AS risk_category FROM (
        SELECT *, round_even(stockout_rate * 0.3 + avg_sales / max(avg_sales) OVER () * 100 * 0.3
            + max_consecutive_zeros / max(max_consecutive_zeros) OVER () * 100 * 0.2
            + sales_volatility / max(sales_volatility) OVER () * 100 * 0.2, 1) AS risk_score,
            round_even(avg_sales * zero_sale_days, 0) AS revenue_impact FROM (
        SELECT store_id, family, count(*) AS total_days, sum(is_zero_sale) AS zero_sale_days, avg(sales) AS avg_sales,
            sum(sales) AS total_sales, max(consecutive_zeros) AS max_consecutive_zeros,
            avg(sales_rolling_mean_7d) AS avg_rolling_mean, avg(sales_rolling_std_7d) AS sales_volatility,
            round_even(sum(is_zero_sale) / count(*) * 100, 2) AS stockout_rate,
            min(city) AS city, min(store_type) AS store_type, min(category) AS category, min(is_fmcg) AS is_fmcg
        FROM analysed GROUP BY store_id, family))""",
    "reorder": """SELECT *, round_even(avg_daily_demand * 2 + safety_stock_95, 0) AS reorder_point_95,
        round_even(avg_daily_demand * 2 + safety_stock_99, 0) AS reorder_point_99,
        round_even(suggested_order_qty + safety_stock_95, 0) AS max_stock_level FROM (
        SELECT store_id, family, avg(sales) AS avg_daily_demand, stddev_samp(sales) AS std_daily_demand,
            max(sales) AS max_daily_demand, median(sales) AS median_demand, count(*) AS total_days,
            min(city) AS city, min(category) AS category, min(is_fmcg) AS is_fmcg,
            round_even(1.65::DOUBLE * stddev_samp(sales) * sqrt(2), 0) AS safety_stock_95,
            round_even(2.33::DOUBLE * stddev_samp(sales) * sqrt(2), 0) AS safety_stock_99,
            round_even(avg(sales) * 7, 0) AS suggested_order_qty
        FROM analysed GROUP BY store_id, family)""",
    "ladder": """SELECT store_id, family, coalesce(city, 'Unknown') AS city, coalesce(category, 'Unknown') AS category,
        CASE rung WHEN 1 THEN 'CRITICAL' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'MEDIUM' ELSE 'LOW' END AS alert_level,
        CASE rung WHEN 1 THEN consecutive_zeros || ' consecutive zero-sale days for high-demand FMCG product'
            WHEN 2 THEN consecutive_zeros || ' consecutive zero-sale days, avg demand: ' || mean0
            WHEN 3 THEN 'Stockout today, predicted demand (' || pred0 || ') above average (' || mean0 || ')'
            ELSE 'Stockout today for product with avg demand ' || mean0 END AS alert_reason,
        consecutive_zeros, CAST(format('{:.1f}', m) AS DOUBLE) AS avg_daily_demand,
        CAST(format('{:.1f}', predicted_sales) AS DOUBLE) AS predicted_demand,
        round_even(m * 7, 0) AS suggested_order, date, rung FROM (
        SELECT *, sales_rolling_mean_7d AS m, CAST(round_even(sales_rolling_mean_7d, 0) AS BIGINT) AS mean0,
            CAST(round_even(predicted_sales, 0) AS BIGINT) AS pred0,
            CASE WHEN consecutive_zeros >= 3 AND is_fmcg = 1 AND sales_rolling_mean_7d > 10 THEN 1
                 WHEN consecutive_zeros >= 2 AND sales_rolling_mean_7d > 10 THEN 2
                 WHEN is_zero_sale = 1 AND predicted_sales > sales_rolling_mean_7d * 1.2::DOUBLE THEN 3
                 WHEN is_zero_sale = 1 AND sales_rolling_mean_7d > 5 THEN 4 END AS rung
        FROM predicted) WHERE rung IS NOT NULL""",
    "doubled": "SELECT * FROM raw_sales UNION ALL SELECT * FROM raw_sales WHERE onpromotion > 0",
}


def sql(select: str) -> str:
    """Prefix the tables a select needs, in order."""
    need: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text) and name not in need:
                visit(TABLES[name])
                if name not in need:
                    need.append(name)

    visit(select)
    if not need:
        return select
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({TABLES[name]})" for name in need) + "\n" + select


def add(**selects: str) -> None:
    for key, select in selects.items():
        ORACLES[key] = sql(select)


KEY = f"store_id, family, {d()}"

# ---- sources and sinks
add(
    read_sales=f"SELECT {d()}, store_nbr, family, {rs('sales')}, onpromotion FROM raw_sales",
    read_stores="SELECT * FROM raw_stores",
    read_holidays=f"SELECT date, type, locale, description, {i('transferred', 'transferred')} FROM raw_holidays",
    read_oil=f"SELECT {d()}, {rs('dcoilwtico')} FROM raw_oil",
    read_cpi=f"SELECT {d()}, year, month, item_id, item_name, {rs('national_avg_price', 'pct_change')}, city, "
             f"{rs('city_price')} FROM raw_cpi",
    generate_calendar=f"SELECT {d('full_date')} FROM days",
    product_seed=f"""SELECT s.family, {r('sum(sales)', 'total_sales')}, coalesce(any_value(category), 'none') AS category,
        coalesce(any_value(subcategory), 'none') AS subcategory, {i('coalesce(any_value(is_fmcg), -1)', 'is_fmcg')},
        {i('coalesce(any_value(is_perishable), -1)', 'is_perishable')}
        FROM raw_sales s LEFT JOIN seed USING (family) GROUP BY s.family""",
    load_dim_store=f"SELECT * EXCLUDE (avg_daily_sales, total_revenue, stockout_rate), "
                   f"{rs('avg_daily_sales', 'total_revenue', 'stockout_rate')} FROM dim_store",
    load_dim_economic=f"SELECT date_key, {d('full_date')}, {rs('oil_price', 'oil_price_7d_avg', 'oil_price_change')} "
                      "FROM dim_economic",
    load_dim_cpi=f"SELECT cpi_key, {d()}, year, month, item_id, item_name, {rs('national_avg_price', 'pct_change')}, "
                 f"city, {rs('city_price')} FROM dim_cpi",
    load_fact=f"""SELECT CAST(sale_key AS VARCHAR) AS sale_key, date_key, store_key, product_key, {rs('sales')}, onpromotion, onpromotion_count,
        {rs(*LAGS, *MEANS, *STDS, *TREND)}, is_zero_sale, zero_sales_last_7d, consecutive_zeros,
        {rs('store_avg_daily_sales', 'family_avg_sales', 'store_product_avg', 'oil_price')} FROM fact""",
    update_store_metrics=f"""SELECT d.store_key, d.store_id, d.city, d.state, d.store_type, d.store_size, d.cluster,
        {r(f"coalesce({dec('m.a')}, 0)", 'avg_daily_sales')},
        {r(f"coalesce({dec('m.t', 'DECIMAL(25,2)')}, total_revenue)", 'total_revenue')},
        {r(f"coalesce({dec('m.z', 'DECIMAL(5,2)')}, stockout_rate)", 'stockout_rate')} FROM dim_store d LEFT JOIN
        (SELECT store_id, avg(CAST(sales AS DOUBLE)) AS a, sum(CAST(sales AS DOUBLE)) AS t,
         avg(is_zero_sale) * 100 AS z FROM ready GROUP BY store_id) m USING (store_id)""",
    update_product_metrics=f"""SELECT d.product_key, family, d.category, d.subcategory, d.is_fmcg, d.is_perishable,
        {r(dec('m.a'), 'avg_daily_sales')}, {r(dec('m.t', 'DECIMAL(25,2)'), 'total_revenue')},
        {i(f"floor({AVG_RANK.format('m.t')})", 'popularity_rank')}, {r(dec('m.z', 'DECIMAL(5,2)'), 'stockout_rate')}
        FROM dim_product d JOIN
        (SELECT family, avg(CAST(sales AS DOUBLE)) AS a, sum(CAST(sales AS DOUBLE)) AS t,
         avg(is_zero_sale) * 100 AS z FROM ready GROUP BY family) m USING (family)""",
    table_row_counts=" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}" for name, source in (
            ("dim_date", "dim_date"), ("dim_store", "dim_store"), ("dim_product", "dim_product"),
            ("dim_economic", "dim_economic"), ("dim_cpi", "dim_cpi"), ("fact_daily_sales", "fact"))),
    union_all_counts=" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM raw_{name}"
        for name in ("sales", "stores", "holidays", "oil", "cpi")),
)

# ---- cleaning
RAW = f"{d()}, store_nbr, family"
add(
    dedup_rows=f"SELECT DISTINCT {RAW}, {rs('sales')}, onpromotion FROM doubled",
    dedup_by_key="""SELECT s_nationkey, s_suppkey, s_name FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey
        ORDER BY s_suppkey, s_name) AS rn FROM supplier) WHERE rn = 1""",
    coerce_dates=f"""SELECT {d('try_cast(date AS DATE)', 'date')}, type, locale, description,
        {i('transferred', 'transferred')} FROM raw_holidays WHERE try_cast(date AS DATE) IS NOT NULL""",
    promo_count_to_flag=f"""SELECT {RAW}, {rs('sales')}, {i('onpromotion > 0', 'onpromotion')},
        onpromotion AS onpromotion_count FROM raw_sales""",
    clip_negative=f"SELECT {RAW}, {r('greatest(sales - 10, 0)', 'sales')}, onpromotion FROM raw_sales",
    cap_outliers_quantile=f"""SELECT {RAW}, {r('least(sales, (SELECT quantile_cont(sales, 0.995) FROM raw_sales))', 'sales')},
        onpromotion FROM raw_sales""",
    flag_anomaly_days=f"""SELECT {RAW}, {rs('sales')}, onpromotion, {i('date IN (SELECT date FROM low)', 'is_anomaly_day')}
        FROM raw_sales""",
    standardise_text=f"""SELECT store_nbr, {title('city')} AS city, {title('state')} AS state, upper(trim(type)) AS type,
        cluster FROM raw_stores""",
    drop_transferred=f"""SELECT date, type, locale, description, {i('transferred', 'transferred')} FROM raw_holidays
        WHERE NOT transferred""",
    flag_national=f"""SELECT date, type, locale, description, {i('transferred', 'transferred')},
        {i("coalesce(lower(locale) LIKE '%national%', false)", 'is_national')} FROM raw_holidays""",
    clean_stores="SELECT * FROM clean_stores",
    clean_sales=f"SELECT {RAW}, {rs('sales')}, onpromotion, onpromotion_count, is_anomaly_day FROM clean_sales",
    clean_holidays=f"""SELECT {d()}, type, locale, description, {i('transferred', 'transferred')}, is_national
        FROM clean_holidays""",
    fill_forward_backward=f"SELECT {d()}, {rs('dcoilwtico')} FROM clean_oil",
    fill_numeric_nulls=f"""SELECT {d()}, year, month, item_id, item_name, {rs('national_avg_price')},
        {r('coalesce(pct_change, 0)', 'pct_change')}, city, {rs('city_price')} FROM raw_cpi""",
    fill_critical_nulls=f"""SELECT store_nbr AS store_id, CASE WHEN family = 'LARGE' THEN 'Unknown' ELSE family END AS family,
        {d()}, {r('CASE WHEN onpromotion = 0 THEN sales ELSE 0 END', 'sales')} FROM raw_sales""",
    map_store_size=f"SELECT store_nbr, upper(type) AS type, {SIZE.format('upper(type)')} AS store_size FROM raw_stores",
    encode_store_type=f"""SELECT store_nbr, upper(type) AS store_type,
        {i(TYPE_CODE.format('upper(type)'), 'store_type_encoded')} FROM raw_stores""",
    encode_category=f"""SELECT s.family, {r('sum(sales)', 'total_sales')}, coalesce(any_value(category), 'none') AS category,
        {i(CATEGORY_CODE.format('any_value(category)'), 'category_encoded')}
        FROM raw_sales s LEFT JOIN seed USING (family) GROUP BY s.family""",
    encode_family_rank=f"""SELECT {KEY}, {i('floor(rk)', 'family_encoded')} FROM panel JOIN
        (SELECT family, {AVG_RANK.format('t')} AS rk FROM (SELECT family, sum(sales) AS t FROM panel GROUP BY family))
        USING (family)""",
    interaction_features=f"SELECT {KEY}, promo_weekend, ramadan_fmcg, wedding_grocery, payday_spending FROM ready",
    latest_snapshot=f"SELECT {KEY}, {rs('sales')}, onpromotion FROM panel WHERE date = (SELECT max(date) FROM panel)",
    filter_store_year_category=f"""SELECT year, {KEY}, category, {rs('sales')} FROM ready WHERE store_id IN (1, 3, 5, 7)
        AND year(date) IN (1999, 2000) AND category IN ('FMCG', 'Fresh')""",
    filter_alert_levels=f"SELECT {KEY}, alert_level, {rs('suggested_order')} FROM ladder "
                        "WHERE alert_level IN ('CRITICAL', 'HIGH')",
    filter_store=f"SELECT {KEY}, {rs('sales')} FROM ready WHERE store_id = (SELECT min(store_id) FROM ready)",
    split_by_year="SELECT CASE WHEN year < 2001 THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM ready GROUP BY 1",
    filter_fmcg_having=f"""SELECT store_key, family, count(*) AS total_days, {n('sum(is_zero_sale)', 'zero_sale_days')},
        {r('sum(is_zero_sale) / count(*) * 100', 'stockout_rate')} FROM fact JOIN dim_product USING (product_key)
        WHERE is_fmcg = 1 GROUP BY store_key, family HAVING sum(is_zero_sale) / count(*) > 0.3""",
    latest_fact_date_filter=f"""SELECT {d('full_date')}, store_key, product_key, {rs('sales')} FROM fact
        JOIN dim_date USING (date_key) WHERE full_date = (SELECT max(full_date) FROM dim_date WHERE date_key IN
        (SELECT date_key FROM fact))""",
    scd_defaults_truncate=f"""SELECT {d()}, year, month, item_id, left(repeat(item_name, 30), 200) AS item_name,
        {rs('national_avg_price')}, {rs('pct_change')}, CASE WHEN month = 2 THEN 'Unknown' ELSE city END AS city,
        {rs('city_price')} FROM dim_cpi""",
    to_warehouse_decimals=f"""SELECT {KEY}, {', '.join(r(dec(c), c) for c in FACT_MEASURES)}, onpromotion, onpromotion_count,
        is_zero_sale, {i('zero_sales_last_7d', 'zero_sales_last_7d')}, {i('consecutive_zeros', 'consecutive_zeros')}
        FROM featured""",
    period_label_case="""SELECT CASE WHEN is_payday_week = 1 THEN 'Payday Week (1-7)' WHEN is_end_of_month = 1
        THEN 'End of Month (25-31)' ELSE 'Mid Month (8-24)' END AS period, count(*) AS n FROM dim_date GROUP BY 1""",
    format_report="""SELECT family, category, format('{:,}', CAST(round_even(CAST(sum(sales) AS DOUBLE), 0) AS BIGINT))
        AS total_revenue, format('{:,.2f}', round_even(avg(CAST(sales AS DOUBLE)), 2)) AS avg_daily_sales
        FROM fact JOIN dim_product USING (product_key) GROUP BY family, category ORDER BY sum(sales) DESC, family LIMIT 10""",
    alert_ladder=f"""SELECT store_id, family, city, category, alert_level, alert_reason, {i('consecutive_zeros', 'consecutive_zeros')},
        {rs('avg_daily_demand', 'predicted_demand', 'suggested_order')}, {d()} FROM ladder""",
    risk_category=f"""SELECT store_id, family, {r('s', 'score')}, CASE WHEN s > 0 AND s <= 25 THEN 'Low'
        WHEN s > 25 AND s <= 50 THEN 'Medium' WHEN s > 50 AND s <= 75 THEN 'High' WHEN s > 75 AND s <= 100
        THEN 'Critical' ELSE 'none' END AS risk_category FROM (SELECT store_id, family, risk_score * 2 AS s FROM risk)""",
)
ORACLES["flag_anomaly_days"] = re.sub(
    r"\nSELECT CAST\(CAST\(date AS DATE\) AS VARCHAR\) AS date, store_nbr",
    ",\ntot AS MATERIALIZED (SELECT date, sum(sales) AS total FROM raw_sales GROUP BY date),\n"
    "low AS (SELECT date FROM tot WHERE total < (SELECT quantile_cont(total, 0.01) FROM tot))"
    "\nSELECT CAST(CAST(date AS DATE) AS VARCHAR) AS date, store_nbr", ORACLES["flag_anomaly_days"])

# ---- joins
add(
    join_store_attrs=f"""SELECT {d()}, store_nbr, s.family, {rs('sales')}, onpromotion, city, state, type, cluster, store_size
        FROM raw_sales s LEFT JOIN clean_stores USING (store_nbr)""",
    join_holiday_flags=f"""SELECT store_nbr, family, {d('s.date', 'date')}, coalesce(is_holiday, 0) AS is_holiday,
        coalesce(is_national, 0) AS is_national_holiday FROM raw_sales s LEFT JOIN holiday_days h ON h.date = s.date""",
    join_oil_asof=f"""SELECT store_nbr, family, {d('s.date', 'date')}, {r('price', 'dcoilwtico')} FROM raw_sales s
        LEFT JOIN day_prices p ON p.date = s.date""",
    merge_all=f"SELECT * REPLACE ({r('sales', 'sales')}, {r('oil_price', 'oil_price')}, {d()}) FROM merged",
    join_sales_store_inner=f"SELECT {d()}, store_nbr, family, {rs('sales')}, onpromotion, type FROM raw_sales "
                           "JOIN raw_stores USING (store_nbr)",
    star_join=f"SELECT * REPLACE ({rs(*FACT_MEASURES)}, {d()}) FROM star",
    fact_date_join=f"SELECT quarter, is_holiday, {r('sum(sales)', 'total_sales')} FROM fact JOIN dim_date USING (date_key) "
                   "GROUP BY quarter, is_holiday",
    fact_product_join=f"SELECT category, {r('sum(sales)', 'total_sales')} FROM fact JOIN dim_product USING (product_key) "
                      "GROUP BY category",
    fact_store_join=f"SELECT state, {r('sum(sales)', 'total_sales')} FROM fact JOIN dim_store USING (store_key) "
                    "GROUP BY state",
    fact_store_product_join=f"SELECT state, category, {r('sum(sales)', 'total_sales')} FROM fact "
                            "JOIN dim_store USING (store_key) JOIN dim_product USING (product_key) GROUP BY state, category",
    stores_with_metrics=f"""SELECT s.store_nbr, s.city, s.state, s.type, s.cluster, store_id,
        {rs('avg_daily_sales', 'total_revenue', 'stockout_rate')} FROM raw_stores s
        LEFT JOIN store_metrics ON store_nbr = store_id""",
    product_key_lookup=f"""SELECT family, {i('coalesce(product_key, -1)', 'product_key')}, count(*) AS n FROM panel
        LEFT JOIN dim_product USING (family) GROUP BY 1, 2""",
    fk_conformance=f"""SELECT {i('year(date)', 'year')}, {i("date >= DATE '1996-01-01'", 'kept')}, count(*) AS n FROM panel
        GROUP BY 1, 2""",
    semi_join_in=f"""SELECT {RAW}, {rs('sales')}, onpromotion FROM raw_sales WHERE date IN (SELECT date FROM (
        SELECT date, sum(sales) AS t FROM raw_sales GROUP BY date) WHERE t < (SELECT quantile_cont(t, 0.01) FROM
        (SELECT sum(sales) AS t FROM raw_sales GROUP BY date)))""",
    join_back_aggregates=f"""SELECT {KEY}, {rs('sales', 'store_product_avg', 'store_avg_daily_sales', 'family_avg_sales',
        'family_popularity_rank')}, {r('sales / CASE WHEN store_avg_daily_sales = 0 THEN 1 ELSE store_avg_daily_sales END',
        'sales_vs_store_avg')} FROM (SELECT *, avg(sales) OVER (PARTITION BY store_id, family) AS store_product_avg,
        avg(sales) OVER (PARTITION BY store_id) AS store_avg_daily_sales FROM panel)
        JOIN (SELECT family, family_avg_sales, {AVG_RANK.format('t')} AS family_popularity_rank FROM
        (SELECT family, avg(sales) AS family_avg_sales, sum(sales) AS t FROM panel GROUP BY family)) USING (family)""",
    attribute_lookup="SELECT store_id, min(city) AS city, min(store_type) AS store_type FROM ready GROUP BY store_id",
    reorder_with_risk=f"""SELECT store_id, family, {rs('reorder_point_95', 'stockout_rate', 'risk_score')},
        coalesce(risk_category, 'none') AS risk_category FROM reorder
        LEFT JOIN (SELECT store_id, family, stockout_rate, risk_score, risk_category FROM risk) USING (store_id, family)""",
    attach_predictions=f"SELECT {KEY}, {rs('sales')}, {r('coalesce(predicted_sales, -1)', 'predicted_sales')} FROM predicted",
)

# ---- aggregations
CPI_COLUMNS = ["date", "year", "month", "item_id", "item_name", "national_avg_price", "pct_change", "city", "city_price"]
add(
    profile_table=" UNION ALL ".join(
        f"SELECT count(*) AS row_count, 9 AS column_count, '{c}' AS column_name, count(*) - count({c}) AS null_count "
        "FROM raw_cpi" for c in CPI_COLUMNS),
    null_summary="SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM raw_cpi" for c in CPI_COLUMNS)
        + ") WHERE null_count > 0",
    profile_sales=f"""SELECT {d('min(date)', 'first_date')}, {d('max(date)', 'last_date')}, count(DISTINCT date) AS days,
        count(DISTINCT store_nbr) AS stores, count(DISTINCT family) AS families, count(*) AS row_count,
        {r('avg(sales)', 'mean_sales')}, {r('min(sales)', 'min_sales')}, {r('max(sales)', 'max_sales')},
        {r('stddev_samp(sales)', 'std_sales')}, {r('median(sales)', 'median_sales')} FROM raw_sales""",
    zero_negative_profile=f"""SELECT {n('sum(CASE WHEN sales = 0 THEN 1 ELSE 0 END)', 'zero_rows')},
        {r('sum(CASE WHEN sales = 0 THEN 1 ELSE 0 END) / count(*) * 100', 'zero_pct')},
        {n('sum(CASE WHEN sales <> 0 THEN 1 ELSE 0 END)', 'non_zero_rows')},
        {n('sum(CASE WHEN sales < 0 THEN 1 ELSE 0 END)', 'negative_rows')} FROM raw_sales""",
    family_stats=f"""SELECT family, {r('sum(sales)', 'total_sales')}, {r('avg(sales)', 'avg_daily')},
        {n('sum(CASE WHEN sales = 0 THEN 1 ELSE 0 END)', 'zero_days')} FROM raw_sales GROUP BY family""",
    promotion_summary=f"""SELECT {n('t', 'promo_total')}, {r('p', 'promo_pct')}, {r('w', 'avg_with_promo')},
        {r('o', 'avg_without_promo')}, {r('CASE WHEN o > 0 THEN (w - o) / o * 100 ELSE 0 END', 'promo_lift_pct')} FROM (
        SELECT sum(onpromotion) AS t, sum(onpromotion) / count(*) * 100 AS p,
        avg(CASE WHEN onpromotion > 0 THEN sales END) AS w, avg(CASE WHEN onpromotion = 0 THEN sales END) AS o
        FROM raw_sales)""",
    promo_flag_means=f"SELECT {i('onpromotion > 0', 'on_promotion')}, {r('avg(sales)', 'avg_sales')} FROM raw_sales GROUP BY 1",
    store_value_counts=" UNION ALL ".join(
        f"SELECT '{c}' AS attribute, CAST({c} AS VARCHAR) AS value, count(*) AS stores FROM clean_stores GROUP BY {c}"
        for c in ("type", "city", "state", "cluster")),
    holiday_profile=" UNION ALL ".join(
        f"""SELECT {t} AS type, count(*) AS events, {d('min(try_cast(date AS DATE))', 'first_date')},
        {d('max(try_cast(date AS DATE))', 'last_date')}, {n('sum(CASE WHEN transferred THEN 1 ELSE 0 END)', 'transferred')}
        FROM raw_holidays WHERE try_cast(date AS DATE) IS NOT NULL {g}"""
        for t, g in (("type", "GROUP BY type"), ("'(all)'", ""))),
    oil_profile=f"""SELECT {d('min(date)', 'first_date')}, {d('max(date)', 'last_date')}, count(*) AS days,
        count(*) - count(dcoilwtico) AS null_prices, {r('(count(*) - count(dcoilwtico)) / count(*) * 100', 'null_pct')},
        {r('min(dcoilwtico)', 'min_price')}, {r('max(dcoilwtico)', 'max_price')}, {r('avg(dcoilwtico)', 'avg_price')}
        FROM raw_oil""",
    cpi_profile="""SELECT count(*) AS row_count, count(DISTINCT year) AS years, count(DISTINCT city) AS cities,
        count(DISTINCT item_name) AS items, array_to_string(list_sort(list(DISTINCT year)), ',') AS year_list,
        array_to_string(list_sort(list(DISTINCT city)), ',') AS city_list FROM raw_cpi""",
    preview_rows="""(SELECT 'event' AS kind, description AS value FROM clean_holidays ORDER BY date, type, description LIMIT 10)
        UNION ALL (SELECT 'item', item_name FROM (SELECT DISTINCT item_name FROM raw_cpi) ORDER BY item_name LIMIT 20)""",
    cpi_city_mean=f"SELECT count(*) AS row_count, {r('avg(city_price)', 'avg_price')} FROM raw_cpi WHERE city = 'NATION_5'",
    cpi_item_monthly=f"""SELECT year, month, {r('avg(city_price)', 'avg_price')},
        year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS date_str FROM raw_cpi
        WHERE lower(item_name) LIKE '%brand#2%' AND city = 'NATION_5' GROUP BY year, month""",
    daily_sales_total=f"SELECT {d()}, {r('sum(sales)', 'total_sales')} FROM raw_sales GROUP BY raw_sales.date",
    sales_by_month=f"SELECT {i('month(date)', 'month')}, {r('avg(sales)', 'avg_sales')} FROM raw_sales GROUP BY 1",
    sales_by_dow=f"SELECT {i('isodow(date) - 1', 'dow')}, {r('avg(sales)', 'avg_sales')} FROM raw_sales GROUP BY 1",
    sales_by_store_type=f"SELECT type, {r('avg(sales)', 'avg_sales')} FROM raw_sales JOIN raw_stores USING (store_nbr) "
                        "GROUP BY type",
    sales_by_year=f"SELECT {i('year(date)', 'year')}, {r('sum(sales)', 'total_sales')} FROM raw_sales GROUP BY 1",
    zero_days_by_family="SELECT family, count(*) AS zero_days FROM raw_sales WHERE sales = 0 GROUP BY family "
                        "ORDER BY zero_days DESC, family LIMIT 15",
    cleaning_report="SELECT source, metric, " + r("value", "value") + " FROM (" + " UNION ALL ".join([
        "SELECT 'sales' AS source, 'initial_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM doubled",
        "SELECT 'sales', 'duplicates_removed', (SELECT count(*) FROM doubled) - (SELECT count(*) FROM base)",
        "SELECT 'sales', 'anomaly_days_flagged', count(*) FROM odd_days",
        "SELECT 'sales', 'final_rows', count(*) FROM base",
        "SELECT 'sales', 'outliers_capped', count(*) FROM base WHERE sales > (SELECT quantile_cont(sales, 0.995) FROM base)",
        "SELECT 'sales', 'outlier_threshold', round_even(quantile_cont(sales, 0.995), 2) FROM base",
        "SELECT 'sales', 'actual_promo_rate', round_even(avg(onpromotion) * 100, 1) FROM base",
        "SELECT 'sales', 'zero_sales_kept', count(*) FROM base WHERE sales = 0",
        "SELECT 'stores', 'total_stores', count(*) FROM clean_stores",
        "SELECT 'stores', 'cities', count(DISTINCT city) FROM clean_stores",
        "SELECT 'stores', 'type_' || type, count(*) FROM clean_stores GROUP BY type",
        "SELECT 'holidays', 'total_events', count(*) FROM clean_holidays",
        "SELECT 'holidays', 'type_' || type, count(*) FROM clean_holidays GROUP BY type",
        "SELECT 'oil', 'total_days', count(*) FROM raw_oil",
        "SELECT 'oil', 'nulls_filled', count(*) - count(dcoilwtico) FROM raw_oil",
        "SELECT 'oil', 'lowest_price', min(dcoilwtico) FROM raw_oil",
        "SELECT 'oil', 'highest_price', max(dcoilwtico) FROM raw_oil",
        "SELECT 'merged', 'final_rows', count(*) FROM merged",
        "SELECT 'merged', 'final_columns', 15"]) + ")",
    store_metrics=f"SELECT store_id, {rs('avg_daily_sales', 'total_revenue', 'stockout_rate')} FROM store_metrics",
    product_metrics=f"""SELECT family, {r('a', 'avg_daily_sales')}, {r('t', 'total_revenue')},
        {r('round_even(z * 100, 2)', 'stockout_rate')}, {i(f"floor({AVG_RANK.format('t')})", 'popularity_rank')} FROM (
        SELECT family, avg(sales) AS a, sum(sales) AS t, avg(is_zero_sale) AS z FROM featured GROUP BY family)""",
    store_avg_daily_sales=f"SELECT {KEY}, {rs('sales')}, {r('avg(sales) OVER (PARTITION BY store_id)', 'store_avg_daily_sales')} "
                          "FROM panel",
    family_avg_sales=f"SELECT {KEY}, {rs('sales')}, {r('avg(sales) OVER (PARTITION BY family)', 'family_avg_sales')} FROM panel",
    store_product_avg=f"""SELECT {KEY}, {rs('sales')},
        {r('avg(sales) OVER (PARTITION BY store_id, family)', 'store_product_avg')} FROM panel""",
    sales_vs_store_avg=f"""SELECT {KEY}, {r('sales / CASE WHEN m = 0 THEN 1 ELSE m END', 'sales_vs_store_avg')} FROM
        (SELECT *, avg(sales) OVER (PARTITION BY store_id) AS m FROM panel)""",
    stockout_overall=f"""SELECT count(*) AS total_days, {n('sum(is_zero_sale)', 'stockout_days')},
        {r('avg(is_zero_sale) * 100', 'stockout_rate')} FROM analysed""",
    stockout_by_season=" UNION ALL ".join(
        f"""SELECT '{label}' AS season, {r('a', 'in_rate')}, {r('o', 'out_rate')}, {r('a - o', 'difference')},
        CASE WHEN a - o > 0 THEN 'UP' ELSE 'DOWN' END AS direction FROM (
        SELECT avg(CASE WHEN {flag} = 1 THEN is_zero_sale END) * 100 AS a,
        avg(CASE WHEN {flag} = 0 THEN is_zero_sale END) * 100 AS o FROM analysed)"""
        for flag, label in (("is_ramadan_period", "Ramadan Period"), ("is_wedding_season", "Wedding Season"),
                            ("is_summer_peak", "Summer Peak"), ("is_payday_week", "Payday Week"),
                            ("is_school_season", "School Season"))),
    stockout_by_family=f"""SELECT family, {r('avg(is_zero_sale) * 100', 'stockout_rate')} FROM analysed GROUP BY family
        ORDER BY avg(is_zero_sale) DESC, family LIMIT 15""",
    stockout_by_month=f"SELECT month, {r('avg(is_zero_sale) * 100', 'stockout_rate')} FROM analysed GROUP BY month",
    risk_scores=f"""SELECT store_id, family, total_days, {n('zero_sale_days', 'zero_sale_days')},
        {rs('avg_sales', 'total_sales')}, {i('max_consecutive_zeros', 'max_consecutive_zeros')},
        {rs('avg_rolling_mean', 'sales_volatility')}, city, store_type, category, is_fmcg,
        {rs('stockout_rate', 'risk_score', 'revenue_impact')}, coalesce(risk_category, 'none') AS risk_category FROM risk""",
    risk_distribution=f"""SELECT coalesce(risk_category, 'none') AS risk_category, count(*) AS series,
        {r('count(*) / sum(count(*)) OVER () * 100', 'pct')} FROM risk GROUP BY 1""",
    reorder_points=f"""SELECT store_id, family, {rs('avg_daily_demand', 'std_daily_demand', 'max_daily_demand', 'median_demand')},
        total_days, city, category, is_fmcg, {rs('safety_stock_95', 'safety_stock_99', 'suggested_order_qty',
        'reorder_point_95', 'reorder_point_99', 'max_stock_level')} FROM reorder""",
    alert_summary=" UNION ALL ".join(
        f"SELECT {k} AS severity, '{level}' AS alert_level, count(*) AS alerts FROM ladder WHERE rung = {k}"
        for k, level in enumerate(("CRITICAL", "HIGH", "MEDIUM", "LOW"), 1)),
    alert_volume_by_family=f"""SELECT family, {r('sum(suggested_order)', 'suggested_order')} FROM ladder GROUP BY family
        ORDER BY sum(suggested_order) DESC, family LIMIT 10""",
    fact_quality_check=f"""SELECT {r('min(sales)', 'min_sales')}, {r('max(sales)', 'max_sales')},
        {r('avg(CAST(sales AS DOUBLE))', 'avg_sales')}, {n('sum(is_zero_sale)', 'zero_sale_count')} FROM fact""",
    panel_verification=f"""SELECT {d('min(date)', 'first_date')}, {d('max(date)', 'last_date')},
        count(DISTINCT store_id) AS stores, count(DISTINCT family) AS families,
        {n('sum(is_zero_sale)', 'zero_sales')}, {r('avg(is_zero_sale) * 100', 'zero_share')} FROM featured""",
    regression_metrics=f"""SELECT {r('avg(abs(actual - predicted))', 'MAE')},
        {r('sqrt(avg((actual - predicted) * (actual - predicted)))', 'RMSE')},
        {r('1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(actual))', 'R2')},
        {r('coalesce(avg(CASE WHEN actual > 0 THEN abs((actual - predicted) / actual) END) * 100, 0)', 'MAPE')} FROM preds""",
    conditional_avg=f"""SELECT store_key, {r('avg(CASE WHEN onpromotion = 1 THEN CAST(sales AS DOUBLE) END)', 'avg_with_promo')},
        {r('avg(CASE WHEN onpromotion = 0 THEN CAST(sales AS DOUBLE) END)', 'avg_without_promo')} FROM fact GROUP BY store_key""",
    count_distinct_days=f"SELECT {i('year(date)', 'year')}, count(DISTINCT date) AS active_days FROM raw_sales GROUP BY 1",
)
for key, column, limit in (("stockout_by_store_type", "store_type", ""), ("stockout_by_category", "category", ""),
                           ("stockout_by_dow", "day_name", "")):
    mean = "" if column == "day_name" else f"{r('avg(sales)', 'avg_sales')}, "
    order = ("" if column != "day_name" else
             ", " + i("list_position(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'], day_name) - 1",
                      "day_order"))
    add(**{key: f"""SELECT {column}, count(*) AS total_days, {n('sum(is_zero_sale)', 'stockout_days')}, {mean}
        {r('round_even(sum(is_zero_sale) / count(*) * 100, 1)', 'stockout_rate')}{order} FROM analysed GROUP BY {column}"""})


def heatmap(stores: int) -> str:
    cells = ", ".join(
        r(f"coalesce(avg(CASE WHEN category = '{c}' THEN is_zero_sale END) * 100, 0)", f'"{c}"')
        for c in ("FMCG", "Fresh", "Non-Food"))
    return f"""SELECT store_id, {cells} FROM analysed WHERE store_id IN (SELECT store_id FROM (
        SELECT store_id, avg(is_zero_sale) AS z FROM analysed GROUP BY store_id ORDER BY z DESC, store_id LIMIT {stores}))
        GROUP BY store_id"""


add(stockout_heatmap=heatmap(20), dash_stockout_heatmap=heatmap(15))

# ---- windows
PANEL = f"{KEY}, {rs('sales')}"
add(
    lag_features=f"SELECT {PANEL}, {', '.join(r(f'coalesce({e}, -1)', c) for c, e in LAGS.items())} FROM panel",
    rolling_mean=f"SELECT {PANEL}, {rcols(MEANS)} FROM panel",
    rolling_std=f"SELECT {PANEL}, {rcols(STDS)} FROM panel",
    rolling_max_min=f"SELECT {PANEL}, {rcols(RANGE)} FROM panel",
    sales_trend=f"SELECT {PANEL}, {rcols(TREND)} FROM panel",
    zero_sales_last_7d=f"""SELECT {PANEL}, is_zero_sale, {i(f'sum(is_zero_sale) {window(7)}', 'zero_sales_last_7d')} FROM
        (SELECT *, CASE WHEN sales = 0 THEN 1 ELSE 0 END AS is_zero_sale FROM panel)""",
    consecutive_zeros=f"""SELECT {PANEL}, is_zero_sale,
        {i('CASE WHEN is_zero_sale = 1 THEN row_number() OVER (PARTITION BY store_id, family, island ORDER BY date) - head '
           'ELSE 0 END', 'consecutive_zeros')}
        FROM (SELECT *, CASE WHEN island = 0 THEN 0 ELSE 1 END AS head FROM (
        SELECT *, CASE WHEN sales = 0 THEN 1 ELSE 0 END AS is_zero_sale,
        sum(CASE WHEN sales = 0 THEN 0 ELSE 1 END) {W} AS island FROM panel))""",
    oil_rolling_mean=f"""SELECT {d()}, {rs('dcoilwtico')},
        {r('avg(dcoilwtico) OVER (ORDER BY clean_oil.date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 'oil_7d_avg')} FROM clean_oil""",
    oil_change=f"""SELECT {d()}, {rs('dcoilwtico')},
        {r('coalesce(dcoilwtico - lag(dcoilwtico) OVER (ORDER BY clean_oil.date), 0)', 'oil_change')} FROM clean_oil""",
    family_popularity_rank=f"""SELECT {PANEL}, {r('rk', 'family_popularity_rank')} FROM panel JOIN
        (SELECT family, {AVG_RANK.format('t')} AS rk FROM (SELECT family, sum(sales) AS t FROM panel GROUP BY family))
        USING (family)""",
    store_revenue_rank=f"""SELECT store_key, {r('t', 'total_revenue')}, {r('a', 'avg_daily_sales')},
        rank() OVER (ORDER BY t DESC) AS revenue_rank FROM (SELECT store_key, sum(CAST(sales AS DOUBLE)) AS t,
        avg(CAST(sales AS DOUBLE)) AS a FROM fact GROUP BY store_key)""",
    timeline_buckets=f"""SELECT {i('(rn - 1) // sz', 'period')}, {r('avg(actual)', 'actual')}, {r('avg(predicted)', 'predicted')}
        FROM (SELECT *, row_number() OVER (ORDER BY date, store_id, family) AS rn,
        greatest(count(*) OVER () // 100, 1) AS sz FROM preds) WHERE (rn - 1) // sz < 100 GROUP BY 1""",
    last_per_series=f"""SELECT {KEY}, {rs('sales')}, onpromotion FROM (SELECT *, row_number() OVER (PARTITION BY store_id, family
        ORDER BY date DESC) AS rn FROM panel WHERE date >= (SELECT max(date) - INTERVAL 7 DAY FROM panel)) WHERE rn = 1""",
)

# ---- sorts and top-k
add(
    top_families=f"""(SELECT family, {r('sum(sales)', 'total_sales')}, 'best' AS side FROM raw_sales GROUP BY family
        ORDER BY sum(sales) DESC, family LIMIT 3) UNION ALL (SELECT family, {r('sum(sales)', 'total_sales')}, 'worst'
        FROM raw_sales GROUP BY family ORDER BY sum(sales), family LIMIT 2)""",
    top_n_sql=f"""SELECT date_key, store_key, product_key, {rs('sales')} FROM fact
        ORDER BY fact.sales DESC, date_key, store_key, product_key LIMIT 30""",
    top_series=f"""SELECT store_id, family, {r('sum(sales)', 'total_sales')} FROM panel GROUP BY store_id, family
        ORDER BY sum(sales) DESC, store_id, family LIMIT 3""",
    top_risks=f"""SELECT store_id, family, city, {rs('stockout_rate', 'risk_score')} FROM risk
        ORDER BY risk.risk_score DESC, store_id, family LIMIT 20""",
    top_reorders=f"""SELECT store_id, family, {rs('avg_daily_demand', 'reorder_point_95', 'risk_score')} FROM reorder
        JOIN (SELECT store_id, family, risk_score FROM risk) k USING (store_id, family) WHERE avg_daily_demand > 0
        ORDER BY k.risk_score DESC, store_id, family LIMIT 50""",
    sort_alerts_by_severity=f"""SELECT alert_level, {KEY}, {rs('avg_daily_demand')} FROM ladder
        ORDER BY rung, ladder.avg_daily_demand DESC, store_id, family, ladder.date""",
    weekday_order=f"""SELECT day_name, {r('avg(CAST(sales AS DOUBLE))', 'avg_sales')},
        {i('min(day_of_week)', 'day_order')} FROM ready GROUP BY day_name""",
)

# ---- scalar functions
add(
    calendar_features=f"SELECT {KEY}, {parts(CAL, 'panel.date')} FROM panel",
    season_flags=f"SELECT {KEY}, {parts(SEASON, 'panel.date')} FROM panel",
    dim_date=f"SELECT * REPLACE ({d('full_date')}) FROM dim_date",
    date_key=f"SELECT {KEY}, {i('year(panel.date) * 10000 + month(panel.date) * 100 + day(panel.date)', 'date_key')} FROM panel",
    is_zero_sale=f"SELECT {PANEL}, {i('panel.sales = 0', 'is_zero_sale')} FROM panel",
)

# ---- the ten questions
S = "CAST(sales AS DOUBLE)"
MEAN, TOTAL = r(f"avg({S})", "avg_sales"), r(f"sum({S})", "total_sales")
RATE = r("sum(is_zero_sale) / count(*) * 100", "stockout_rate")
add(
    q01_top_products=f"""SELECT family, category, {r(f'sum({S})', 'total_revenue')}, {r(f'avg({S})', 'avg_daily_sales')} FROM fact
        JOIN dim_product USING (product_key) GROUP BY family, category ORDER BY sum(sales) DESC, family LIMIT 10""",
    q02_monthly_season=f"SELECT month, month_name, {MEAN}, {RATE} FROM fact JOIN dim_date USING (date_key) "
                       "GROUP BY month, month_name",
    q03_ramadan_impact=f"""SELECT CASE WHEN is_ramadan_period = 1 THEN 'Ramadan' ELSE 'Normal' END AS period, {MEAN}, {TOTAL},
        {RATE} FROM fact JOIN dim_date USING (date_key) GROUP BY is_ramadan_period""",
    q04_stockout_hotspots=f"""SELECT store_id, city, store_type, family, count(*) AS total_days,
        {n('sum(is_zero_sale)', 'zero_sale_days')}, {RATE} FROM fact JOIN dim_store USING (store_key)
        JOIN dim_product USING (product_key) WHERE is_fmcg = 1 GROUP BY store_id, city, store_type, family
        HAVING sum(is_zero_sale) / count(*) > 0.3 ORDER BY sum(is_zero_sale) DESC, store_id, family LIMIT 20""",
    q05_store_ranking=f"""SELECT store_id, city, store_type, store_size, {r(f'sum({S})', 'total_revenue')},
        {r(f'avg({S})', 'avg_daily_sales')}, rank() OVER (ORDER BY sum(sales) DESC) AS revenue_rank
        FROM fact JOIN dim_store USING (store_key) GROUP BY store_id, city, store_type, store_size""",
    q06_weekend_weekday=f"""SELECT CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type, {MEAN}, {TOTAL}
        FROM fact JOIN dim_date USING (date_key) GROUP BY is_weekend""",
    q07_promotion_lift=f"""SELECT family, category, {r('w', 'avg_with_promo')}, {r('o', 'avg_without_promo')},
        {r('(w - o) / nullif(o, 0) * 100', 'promotion_lift')} FROM (SELECT family, category,
        avg(CASE WHEN onpromotion = 1 THEN {S} END) AS w, avg(CASE WHEN onpromotion = 0 THEN {S} END) AS o FROM fact
        JOIN dim_product USING (product_key) GROUP BY family, category) WHERE w IS NOT NULL""",
    q09_payday_effect=f"""SELECT CASE WHEN is_payday_week = 1 THEN 'Payday Week (1-7)' WHEN is_end_of_month = 1
        THEN 'End of Month (25-31)' ELSE 'Mid Month (8-24)' END AS period, {MEAN}, {TOTAL} FROM fact
        JOIN dim_date USING (date_key) GROUP BY 1""",
    q10_reorder_alerts=f"""SELECT store_id, city, family, category, consecutive_zeros AS days_without_sale,
        {r('sales_rolling_mean_7d', 'normal_daily_demand')},
        {r('CAST(sales_rolling_mean_7d AS DOUBLE) * 7', 'suggested_order_qty')}, 'REORDER NOW' AS alert_status
        FROM fact JOIN dim_store USING (store_key) JOIN dim_product USING (product_key) JOIN dim_date USING (date_key)
        WHERE consecutive_zeros >= 3 AND is_fmcg = 1 AND sales_rolling_mean_7d > 10 AND full_date =
        (SELECT max(full_date) FROM dim_date WHERE date_key IN (SELECT date_key FROM fact))
        ORDER BY sales_rolling_mean_7d DESC, store_id, family LIMIT 30""",
)
YEARS = f"""SELECT year, {r('t', 'total_sales')}, {r('a', 'avg_daily_sales')}, active_days,
    {r('coalesce((t - lag(t) OVER (ORDER BY year)) / nullif(lag(t) OVER (ORDER BY year), 0) * 100, -999)', 'yoy_growth')}
    FROM (SELECT year, sum({S}) AS t, avg({S}) AS a, count(DISTINCT full_date) AS active_days FROM fact
    JOIN dim_date USING (date_key) GROUP BY year)"""
add(yoy_growth=YEARS, q08_yoy_growth=YEARS)

# ---- forecasting
add(
    feature_matrix=f"""SELECT {KEY}, {rs('sales')}, {r(' + '.join(f'CAST({c} AS DOUBLE)' for c in MODEL_FEATURES), 'feature_sum')}
        FROM ready""",
    seasonal_forecast_facts=f"""SELECT store_id, family, count(*) FILTER (year >= 2001) AS test_rows, count(*) FILTER (year >= 2001) AS forecast_rows,
        {d('min(date) FILTER (year >= 2001)', 'first_day')}, {d('max(date) FILTER (year >= 2001)', 'last_day')},
        {r('sum(sales) FILTER (year >= 2001)', 'sales')}, {i('count(*) FILTER (year < 2001)', 'train_size')} FROM analysed
        GROUP BY store_id, family HAVING count(*) FILTER (year < 2001) >= 100 AND count(*) FILTER (year >= 2001) >= 10""",
    prediction_errors=f"SELECT {KEY}, {rs('actual', 'predicted')}, {r('actual - predicted', 'error')} FROM preds",
    error_histogram=f"""SELECT {i('least(floor((e - lo) / (hi - lo) * 100) + 1, 100)', 'bin')}, count(*) AS rows,
        {r('min(lo)', 'lowest_error')}, {r('min(hi)', 'highest_error')} FROM (SELECT e, min(e) OVER () AS lo,
        max(e) OVER () AS hi FROM (SELECT actual - predicted AS e FROM preds)) GROUP BY 1""",
    season_feature_tag=" UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'avg({c})', 'importance')}, "
        f"{i(f'''regexp_matches('{c}', 'ramadan|eid|wedding|payday|friday|summer|school')''', 'is_season_feature')} FROM ready"
        for c in MODEL_FEATURES if c.startswith("is_") or c in (
            "promo_weekend", "ramadan_fmcg", "wedding_grocery", "payday_spending")),
)

# ---- dashboard tables
MONTH = "strftime(date, '%Y-%m') AS month"
ZERO = r("avg(is_zero_sale) * 100", "stockout_rate")
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
add(
    dash_kpis=f"""SELECT {r('sum(sales)', 'total_revenue')}, {r('avg(sales)', 'avg_daily_sales')},
        count(DISTINCT store_id) AS stores, count(DISTINCT family) AS families, {ZERO} FROM analysed""",
    dash_filter_counts=f"""SELECT {n('sum(CASE WHEN store_id IN (1, 3, 5, 7) AND year IN (1999, 2000) THEN 1 ELSE 0 END)',
        'shown_rows')}, count(*) AS all_rows, {d('min(date)', 'first_date')}, {d('max(date)', 'last_date')} FROM analysed""",
    dash_monthly_sales=f"SELECT {MONTH}, {r('sum(sales)', 'sales')} FROM analysed GROUP BY 1",
    dash_sales_by_type=f"SELECT store_type, {r('avg(sales)', 'avg_sales')}, {r('sum(sales)', 'total_sales')} FROM analysed "
                       "GROUP BY store_type",
    dash_top_products=f"SELECT family, {r('sum(sales)', 'sales')} FROM analysed GROUP BY family "
                      "ORDER BY sum(analysed.sales) DESC, family LIMIT 10",
    dash_dow_pattern=" UNION ALL ".join(
        f"SELECT {k} AS day_order, '{day}' AS day_name, {r('avg(sales)', 'avg_sales')} FROM analysed WHERE day_name = '{day}'"
        for k, day in enumerate(DAYS)),
    dash_season_impact=" UNION ALL ".join(
        f"""SELECT '{label}' AS season, {r('round_even(a, 1)', 'during_season')}, {r('round_even(o, 1)', 'normal_period')},
        {r('round_even(CASE WHEN o > 0 THEN (a - o) / o * 100 ELSE 0 END, 1)', 'impact_pct')} FROM (
        SELECT avg(CASE WHEN {flag} = 1 THEN sales END) AS a, avg(CASE WHEN {flag} = 0 THEN sales END) AS o FROM analysed)"""
        for flag, label in (("is_ramadan_period", "Ramadan"), ("is_wedding_season", "Wedding Season"),
                            ("is_summer_peak", "Summer Peak"), ("is_payday_week", "Payday Week"),
                            ("is_school_season", "School Season"))),
    dash_stockout_kpis=f"""SELECT t AS total_days, {n('z', 'stockout_days')}, {r('z / t * 100', 'stockout_pct')},
        {r('coalesce(a, 0)', 'avg_selling')}, {r('coalesce(a, 0) * z', 'est_lost')} FROM (SELECT count(*) AS t,
        sum(is_zero_sale) AS z, avg(CASE WHEN sales > 0 THEN sales END) AS a FROM analysed)""",
    dash_stockout_by_type=f"SELECT store_type, {ZERO} FROM analysed GROUP BY store_type",
    dash_stockout_by_category=f"SELECT category, {ZERO} FROM analysed GROUP BY category",
    dash_monthly_stockout=f"SELECT {MONTH}, {ZERO} FROM analysed GROUP BY 1",
    dash_alert_counts="SELECT alert_level, count(*) AS alerts FROM ladder GROUP BY alert_level",
    dash_alert_products="SELECT family, count(*) AS alerts FROM ladder GROUP BY family ORDER BY count(*) DESC, family LIMIT 10",
    dash_store_card=f"""SELECT min(city) AS city, min(store_type) AS store_type, {r('sum(sales)', 'revenue')},
        {r('avg(sales)', 'avg_sales')}, {ZERO} FROM analysed WHERE store_id = (SELECT min(store_id) FROM analysed)""",
    dash_store_monthly=f"SELECT {MONTH}, {r('sum(sales)', 'sales')} FROM analysed WHERE store_id = (SELECT min(store_id) FROM analysed) GROUP BY 1",
    dash_store_top_products=f"SELECT family, {r('sum(sales)', 'sales')} FROM analysed WHERE store_id = (SELECT min(store_id) FROM analysed) GROUP BY family "
                            "ORDER BY sum(analysed.sales) DESC, family LIMIT 10",
    dash_store_stockout_by_product=f"""SELECT family, count(*) AS total, {n('sum(is_zero_sale)', 'stockouts')},
        {r('round_even(sum(is_zero_sale) / count(*) * 100, 1)', 'rate')} FROM analysed WHERE store_id = (SELECT min(store_id) FROM analysed) GROUP BY family""",
    alert_totals=f"""SELECT count(*) AS total_alerts, {n('sum(CASE WHEN rung = 1 THEN 1 ELSE 0 END)', 'critical_alerts')},
        (SELECT count(*) FROM risk) AS total_series FROM ladder""",
    dash_store_alerts=f"""SELECT store_id, family, city, category, alert_level, alert_reason,
        {i('consecutive_zeros', 'consecutive_zeros')}, {rs('avg_daily_demand', 'predicted_demand', 'suggested_order')}, {d()}
        FROM ladder WHERE store_id = (SELECT min(store_id) FROM ladder)""",
)

# ---- whole flows
FEATURED_DOUBLES = ["sales", "oil_price", *LAGS, *MEANS, *STDS, *RANGE, *TREND, "store_product_avg", "store_avg_daily_sales",
                    "family_avg_sales", "family_popularity_rank", "sales_vs_store_avg"]
SEASON_FLAGS = ["is_ramadan_period", "is_wedding_season", "is_summer_peak", "is_payday_week", "is_school_season"]
READY_METRICS = f"""SELECT {{0}}, {dec('avg(CAST(sales AS DOUBLE))')} AS a, {dec('sum(CAST(sales AS DOUBLE))', 'DECIMAL(25,2)')} AS t,
    {dec('avg(is_zero_sale) * 100', 'DECIMAL(5,2)')} AS z FROM ready GROUP BY {{0}}""".replace("{:.2f}", "{{:.2f}}")
READY_DOUBLES = ["sales", *LAGS, *MEANS, *STDS, *TREND, "store_avg_daily_sales", "family_avg_sales", "store_product_avg",
                 "oil_price"]
add(
    flow_clean=f"SELECT * REPLACE ({rs('sales', 'oil_price')}, {d()}) FROM merged",
    flow_features=f"""SELECT * REPLACE ({rs(*FEATURED_DOUBLES)}, {d()}, {i('zero_sales_last_7d', 'zero_sales_last_7d')},
        {i('consecutive_zeros', 'consecutive_zeros')}) FROM featured""",
    bucketed_features=f"""SELECT {PANEL}, {', '.join(r(f'coalesce({e}, -1)', c) for c, e in LAGS.items())}, is_zero_sale,
        {i(f'sum(is_zero_sale) {window(7)}', 'zero_sales_last_7d')},
        {i(f'pos - coalesce(max(CASE WHEN is_zero_sale = 0 THEN pos END) {W}, 0)', 'consecutive_zeros')},
        {r('avg(sales) OVER (PARTITION BY store_id, family)', 'store_product_avg')}
        FROM (SELECT *, CASE WHEN sales = 0 THEN 1 ELSE 0 END AS is_zero_sale, row_number() {W} AS pos FROM panel)""",
    read_sales_csv=f"SELECT {d()}, store_nbr, family, {rs('sales')}, onpromotion FROM raw_sales",
    critical_null_counts="""SELECT count(*) FILTER (date IS NULL) AS date, count(*) FILTER (store_id IS NULL) AS store_id,
        count(*) FILTER (month(date) = 5) AS family, count(*) FILTER (isodow(date) = 7) AS sales FROM panel""",
    incremental_features=f"""SELECT * REPLACE ({rs(*FEATURED_DOUBLES)}, {d()}, {i('zero_sales_last_7d', 'zero_sales_last_7d')},
        {i('consecutive_zeros', 'consecutive_zeros')}) FROM featured WHERE date > (SELECT max(date) FROM featured) - INTERVAL 7 DAY""",
    panel_rollup=" UNION ALL ".join(f"""SELECT store_id, family, city, store_type, category, {month} AS year_month, {number} AS month, {day} AS day_name,
        {r('sum(sales)', 'sales')}, {n('sum(is_zero_sale)', 'is_zero_sale')}, {n('sum(onpromotion)', 'onpromotion')}, count(*) AS _rows,
        count(*) FILTER (sales > 0) AS _sold, {', '.join(
            f"""count(*) FILTER ({f} = 1) AS {f}_rows, {r(f'coalesce(sum(sales) FILTER ({f} = 1), 0)', f'{f}_sales')},
            {n(f'coalesce(sum(is_zero_sale) FILTER ({f} = 1), 0)', f'{f}_zeros')}""" for f in SEASON_FLAGS)}, '{part}' AS part
        FROM analysed GROUP BY ALL""" for part, month, number, day in (
            ("month", "strftime(date, '%Y-%m')", "month", "'-'"), ("weekday", "'-'", "-1", "day_name"))),
    flow_warehouse="""SELECT 'accepted' AS outcome, count(*) AS n FROM fact UNION ALL
        SELECT 'unknown_family', count(*) FROM featured WHERE family NOT IN (SELECT family FROM seed)""",
    flow_ml_ready=f"SELECT * REPLACE ({rs(*READY_DOUBLES)}, {d()}) FROM ready",
    flow_etl_report=f"""SELECT count(*) AS rows_extracted, count(*) AS rows_transformed, count(*) AS rows_loaded, 0 AS rows_repaired,
        (SELECT count(*) FROM featured WHERE family NOT IN (SELECT family FROM seed)) AS errors,
        (SELECT count(*) FROM dim_store d JOIN ({READY_METRICS.format('store_id')}) m USING (store_id)
         WHERE d.avg_daily_sales <> a OR d.total_revenue <> t OR d.stockout_rate <> z) AS stores_updated,
        (SELECT count(*) FROM dim_product JOIN ({READY_METRICS.format('family')}) m USING (family) WHERE a <> 0 OR t <> 0 OR z <> 0)
        AS products_updated, 1 AS timed FROM ready""",
    full_reload=f"""SELECT family, {rs('avg_daily_sales', 'total_revenue', 'stockout_rate')}, popularity_rank, 0 AS stale_rows,
        (SELECT count(*) FROM dim_store) AS stores FROM (
        SELECT d.family, coalesce(a, 0) AS avg_daily_sales, coalesce(t, 0) AS total_revenue, coalesce(z, 0) AS stockout_rate,
            {i(f"coalesce(floor({AVG_RANK.format('t')}), 0)", 'popularity_rank')}
        FROM dim_product d LEFT JOIN ({READY_METRICS.format('family')}) m USING (family))""",
    export_subset=f"SELECT {KEY}, {rs('sales')} FROM ready WHERE {DRAWN}",
    concat_subset=f"SELECT year, count(*) AS n FROM ready WHERE {DRAWN} GROUP BY year",
    prediction_sample=f"""SELECT {KEY}, {r('sales', 'actual')}, {r('sales_lag_7d', 'predicted')} FROM analysed
        WHERE year >= 2001 ORDER BY {ROW_DIGEST}, store_id, family, analysed.date LIMIT 5000""",
    flow_alerts=f"""SELECT store_id, family, city, category, alert_level, alert_reason, {i('consecutive_zeros', 'consecutive_zeros')},
        {rs('avg_daily_demand', 'predicted_demand', 'suggested_order')}, {d()} FROM ladder
        WHERE date = (SELECT max(date) FROM analysed)""",
)
