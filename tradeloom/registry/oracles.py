"""The SQL each registered query must equal, over the raw tables only.

Money averages use integer cents, ``(2 * cents + n) // (2 * n) / 100`` (scaled for more digits):
round-half-up without floating point. Other unrounded money is rounded to the digits the query rounds to.
"""

from __future__ import annotations

AS_OF, YEAR = "DATE '2001-07-15'", 2000

_PARTS = {
    "ln": """SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                     ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn
        FROM lineitem) WHERE rn = 1""",
    "lno": "SELECT * FROM ln JOIN orders ON l_orderkey = o_orderkey",
    "fso": """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderdate AS order_date,
        CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
        CAST(dc AS VARCHAR) AS dc_id, CAST(o_custkey AS VARCHAR) AS customer_id,
        o_orderstatus AS order_status, o_orderpriority AS payment_terms,
        o_totalprice AS order_total_amount
        FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS dc FROM ln GROUP BY l_orderkey) m
        ON o_orderkey = m.l_orderkey""",
    "fol": """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line_id,
        CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
        CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS INTEGER) AS ordered_qty_packs,
        CAST(floor(l_quantity * (1 - l_discount)) AS INTEGER) AS confirmed_qty_packs,
        l_extendedprice / l_quantity AS unit_price, l_extendedprice AS line_amount,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lno""",
    "fsh": """SELECT 'S' || l_orderkey || '-' || l_linenumber AS shipment_id,
        CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_suppkey AS VARCHAR) AS dc_id,
        CAST(o_custkey AS VARCHAR) AS customer_id, l_shipdate AS ship_date,
        CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS ship_date_key,
        l_shipdate + to_days(l_linenumber) AS delivery_date,
        l_linestatus AS shipment_status, l_returnflag AS carrier_name FROM lno""",
    "frt": """SELECT 'R' || l_orderkey || '-' || l_linenumber AS return_id,
        CAST(l_orderkey AS VARCHAR) AS original_order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
        CAST(l_partkey AS VARCHAR) AS product_id, l_shipdate AS return_date,
        CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key, o_orderpriority AS reason_code,
        CAST(l_quantity AS INTEGER) AS returned_qty_packs, l_extendedprice AS credit_amount,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lno WHERE l_returnflag = 'R'""",
    "inv": """SELECT l_suppkey || '-' || l_partkey || '-' || strftime(l_shipdate, '%Y%m%d') AS snapshot_id,
        l_shipdate AS snapshot_ts, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key,
        CAST(l_suppkey AS VARCHAR) AS dc_id, CAST(l_partkey AS VARCHAR) AS product_id,
        CAST(sum(l_quantity) AS INTEGER) AS on_hand_packs,
        CAST(sum(floor(l_quantity * l_discount * 10)) AS INTEGER) AS reserved_packs,
        CAST(sum(l_linenumber) AS INTEGER) AS in_transit_packs
        FROM lineitem GROUP BY l_suppkey, l_partkey, l_shipdate""",
    "cus": """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
        c_mktsegment AS customer_type, r_name AS region, c_acctbal AS credit_limit,
        c_acctbal > 5000 AS is_340b_eligible, n_name AS address_country
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "prd": """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_brand AS manufacturer_id,
        p_name AS product_name, p_type AS therapeutic_area,
        string_split(p_name, ' ')[-1] AS dosage_form, p_size AS pack_size,
        p_size > 25 AS cold_chain_required, p_retailprice AS list_price FROM part""",
    "dcs": """SELECT CAST(s_suppkey AS VARCHAR) AS dc_id, s_name AS dc_name, r_name AS region,
        n_name AS address_country FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "days": "SELECT CAST(d AS DATE) AS d FROM range(DATE '1995-01-01', DATE '2003-01-01', INTERVAL 1 DAY) t(d)",
    "cal": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date,
        strftime(d, '%A') AS day_name, CAST(date_trunc('week', d) AS DATE) AS week_start_date,
        CAST(month(d) AS INTEGER) AS month_num, strftime(d, '%B') AS month_name,
        strftime(d, '%Y-%m') AS month_label, CAST(year(d) AS INTEGER) AS year_num,
        dayofweek(d) IN (0, 6) AS is_weekend, CAST(year(d) AS INTEGER) AS fiscal_year,
        'FY' || year(d) AS fiscal_year_label, CAST(month(d) AS INTEGER) AS fiscal_month_num,
        CAST(quarter(d) AS BIGINT) AS fiscal_quarter_num FROM days""",
    # Versions of the event log: rows that differ from the one before, each ended by the next.
    "his": """SELECT user_id, event_type, ts AS start_at,
        lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at
        FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev,
                     row_number() OVER (PARTITION BY user_id ORDER BY ts) AS n FROM events)
        WHERE n = 1 OR prev IS DISTINCT FROM event_type""",
    "patchy": """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '5-LOW' THEN ''
        ELSE CAST(o_orderkey AS VARCHAR) END AS order_id, o_orderstatus AS order_status,
        o_totalprice AS amount FROM orders""",
    "patchy_lines": """SELECT CASE WHEN l_returnflag <> 'A' THEN CAST(l_orderkey AS VARCHAR) END AS order_id,
        CASE WHEN l_linestatus = 'O' THEN ''
             WHEN l_returnflag <> 'N' THEN CAST(l_linenumber AS VARCHAR) END AS line_id FROM lineitem""",
}
_NEEDS = {"lno": ["ln"], "fso": ["ln"], "fol": ["lno"], "fsh": ["lno"], "frt": ["lno"],
          "cal": ["days"]}


def sql(uses: str, body: str) -> str:
    """``body`` with the named parts (and what they need) in front."""
    names: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in names:
            names.append(name)

    for name in uses.split():
        add(name)
    parts = ",\n".join(f"{n} AS ({_PARTS[n]})" for n in names)
    return f"WITH {parts}\n{body.strip()}" if parts else body.strip()


def _half_up(cents: str, n: str, digits: int = 2) -> str:
    more = 10 ** (digits - 2)
    return (f"CASE WHEN {n} > 0 THEN ((2 * {more} * {cents} + {n}) // (2 * {n})) / {100 * more}.0 END")


_CENTS_PER_ORDER = _half_up("sum(cents)", "count(DISTINCT order_id)")
_REVENUE = "round(sum(line_amount), 2)"


def _calendar(first: str, last: str, start: int) -> str:
    """All 38 columns for a fiscal year starting in month ``start``."""
    fm = f"((month(d) - {start} + 12) % 12 + 1)"
    fy = f"(year(d) + {1 if start > 1 else 0} * CASE WHEN month(d) >= {start} THEN 1 ELSE 0 END)"
    fs = (f"make_date(CASE WHEN month(d) >= {start} THEN year(d) ELSE year(d) - 1 END, {start}, 1)")
    q_start, y_start = "date_trunc('quarter', d)", "date_trunc('year', d)"
    q_end = f"CAST({q_start} + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)"
    y_end = f"CAST({y_start} + INTERVAL 12 MONTH - INTERVAL 1 DAY AS DATE)"
    return f"""
    WITH bounds AS (SELECT min(x) AS lo, max(x) AS hi FROM (
        SELECT o_orderdate AS x FROM orders UNION ALL SELECT l_shipdate FROM lineitem)),
    span AS (SELECT CAST(unnest(range({first}, {last}, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date,
      strftime(d, '%A') AS day_name, strftime(d, '%a') AS day_name_short,
      CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week_num,
      CAST(day(d) AS INTEGER) AS day_of_month_num, CAST(dayofyear(d) AS INTEGER) AS day_of_year_num,
      CAST(weekofyear(d) AS INTEGER) AS week_of_year_num,
      CAST(date_trunc('week', d) AS DATE) AS week_start_date,
      CAST(date_trunc('week', d) + INTERVAL 6 DAY AS DATE) AS week_end_date,
      CAST(month(d) AS INTEGER) AS month_num, strftime(d, '%B') AS month_name,
      strftime(d, '%b') AS month_name_short, strftime(d, '%Y-%m') AS month_label,
      CAST(quarter(d) AS INTEGER) AS quarter_num, 'Q' || quarter(d) AS quarter_name,
      CAST(year(d) AS INTEGER) AS year_num,
      CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date,
      CAST({q_start} AS DATE) AS quarter_start_date, {q_end} AS quarter_end_date,
      CAST({y_start} AS DATE) AS year_start_date, {y_end} AS year_end_date,
      dayofweek(d) IN (0, 6) AS is_weekend,
      d = CAST(date_trunc('month', d) AS DATE) AS is_month_start, d = last_day(d) AS is_month_end,
      d = CAST({q_start} AS DATE) AS is_quarter_start, d = {q_end} AS is_quarter_end,
      d = CAST({y_start} AS DATE) AS is_year_start, d = {y_end} AS is_year_end,
      CAST({fm} AS INTEGER) AS fiscal_month_num,
      strftime(make_date(2000, {fm}, 1), '%B') AS fiscal_month_name,
      CAST(({fm} - 1) // 3 + 1 AS BIGINT) AS fiscal_quarter_num,
      'FQ' || CAST(({fm} - 1) // 3 + 1 AS INTEGER) AS fiscal_quarter_name,
      CAST({fy} AS INTEGER) AS fiscal_year, 'FY' || {fy} AS fiscal_year_label,
      {fs} AS fiscal_year_start_date,
      CAST({fs} + INTERVAL 12 MONTH - INTERVAL 1 DAY AS DATE) AS fiscal_year_end_date
    FROM span"""


_WHOLE_YEARS = ("date_trunc('year', lo)", "make_date(year(hi) + 1, 1, 1)")

_GOLD = {
    "kpi_summary": sql("ln", """
        SELECT round((SELECT sum(l_extendedprice) FROM ln), 2) AS total_revenue,
          count(DISTINCT o_orderkey) AS total_orders,
          (SELECT count(DISTINCT c_custkey) FROM customer) AS total_customers,
          """ + _half_up("sum(CAST(round(o_totalprice * 100) AS BIGINT))", "count(*)", 4) + """
          AS avg_order_value FROM orders"""),
    "monthly_revenue": sql("fso fol", f"""
        SELECT date_trunc('month', order_date) AS order_month, {_REVENUE} AS revenue,
          count(DISTINCT order_id) AS order_count
        FROM fol JOIN fso USING (order_id) GROUP BY 1 ORDER BY 1"""),
    "revenue_by_category": sql("fol prd", f"""
        SELECT therapeutic_area, {_REVENUE} AS revenue, count(DISTINCT order_id) AS order_count
        FROM fol JOIN prd USING (product_id) GROUP BY 1"""),
    "revenue_by_customer_type": sql("fso fol cus", f"""
        SELECT customer_type, region, {_REVENUE} AS revenue, count(DISTINCT order_id) AS order_count
        FROM fol JOIN fso USING (order_id) JOIN cus USING (customer_id) GROUP BY 1, 2"""),
    "orders_by_status": """
        SELECT o_orderstatus AS order_status, count(o_orderkey) AS order_count,
          round(sum(o_totalprice), 2) AS revenue,
          round(count(o_orderkey) / (SELECT count(*) FROM orders), 4) AS pct_of_total
        FROM orders GROUP BY 1""",
    "inventory_availability": sql("inv dcs prd", """
        SELECT dc_name, region, therapeutic_area, cold_chain_required,
          CAST(sum(on_hand_packs) AS BIGINT) AS total_on_hand,
          CAST(sum(reserved_packs) AS BIGINT) AS total_reserved,
          CAST(sum(in_transit_packs) AS BIGINT) AS total_in_transit,
          CAST(sum(on_hand_packs - reserved_packs) AS BIGINT) AS total_available
        FROM inv LEFT JOIN dcs USING (dc_id) LEFT JOIN prd USING (product_id)
        GROUP BY 1, 2, 3, 4"""),
    "returns_by_reason": sql("frt", """
        SELECT reason_code, count(return_id) AS return_count,
          CAST(sum(returned_qty_packs) AS BIGINT) AS returned_packs,
          round(sum(credit_amount), 2) AS total_credit,
          round(sum(returned_qty_packs) / (SELECT sum(CAST(l_quantity AS INTEGER)) FROM ln), 4)
            AS return_rate
        FROM frt GROUP BY 1"""),
    "product_revenue": sql("fol prd", f"""
        SELECT product_id, product_name, therapeutic_area, dosage_form, manufacturer_id,
          {_REVENUE} AS revenue, CAST(sum(ordered_qty_packs) AS BIGINT) AS units_sold,
          count(DISTINCT order_id) AS order_count
        FROM fol JOIN prd USING (product_id) GROUP BY 1, 2, 3, 4, 5"""),
}

_ORDER_DAYS = "(SELECT fol.* EXCLUDE (date_key), fso.date_key FROM fol JOIN fso USING (order_id)) JOIN cal USING (date_key)"

_DASHBOARD = {
    "daily_revenue": sql("fso fol cal", f"""
        SELECT calendar_date, day_name, month_num, month_name, year_num, fiscal_year, is_weekend,
          {_REVENUE} AS total_revenue, count(DISTINCT order_id) AS order_count,
          count(*) AS line_item_count, {_half_up("sum(cents)", "count(cents)")} AS avg_line_amount
        FROM {_ORDER_DAYS} GROUP BY 1, 2, 3, 4, 5, 6, 7"""),
    "monthly_revenue_fiscal": sql("fso fol cal", f"""
        SELECT year_num, month_num, month_label, month_name, fiscal_year, fiscal_year_label,
          fiscal_month_num, fiscal_quarter_num, {_REVENUE} AS total_revenue,
          count(DISTINCT order_id) AS order_count, {_CENTS_PER_ORDER} AS avg_order_value,
          CAST(sum(ordered_qty_packs) AS BIGINT) AS units_ordered,
          CAST(sum(confirmed_qty_packs) AS BIGINT) AS units_confirmed,
          round(sum(confirmed_qty_packs) / sum(ordered_qty_packs), 4) AS fulfillment_rate
        FROM {_ORDER_DAYS} GROUP BY 1, 2, 3, 4, 5, 6, 7, 8"""),
    "fiscal_ytd": sql("fso fol cal", f"""
        SELECT fiscal_year, fiscal_year_label, fiscal_month_num, fiscal_quarter_num,
          {_REVENUE} AS ytd_revenue, count(DISTINCT order_id) AS ytd_order_count,
          {_CENTS_PER_ORDER} AS ytd_avg_order_value,
          'FQ' || fiscal_quarter_num AS fiscal_quarter_label
        FROM {_ORDER_DAYS} WHERE calendar_date <= {AS_OF} GROUP BY 1, 2, 3, 4"""),
    "fiscal_ytd_running": sql("fso fol cal", f"""
        SELECT fiscal_year, fiscal_year_label, fiscal_month_num, fiscal_quarter_num,
          CAST(c AS DOUBLE) / 100 AS ytd_revenue, CAST(o AS BIGINT) AS ytd_order_count,
          ((2 * c + o) // (2 * o)) / 100.0 AS ytd_avg_order_value,
          'FQ' || fiscal_quarter_num AS fiscal_quarter_label
        FROM (SELECT *, CAST(sum(cents) OVER w AS BIGINT) AS c, CAST(sum(orders) OVER w AS BIGINT) AS o
              FROM (SELECT fiscal_year, fiscal_year_label, fiscal_month_num, fiscal_quarter_num,
                      sum(cents) AS cents, count(DISTINCT order_id) AS orders
                    FROM {_ORDER_DAYS} WHERE calendar_date <= {AS_OF} GROUP BY 1, 2, 3, 4)
              WINDOW w AS (PARTITION BY fiscal_year ORDER BY fiscal_month_num))"""),
    "inventory_monthly": sql("inv cal", """
        SELECT year_num, month_num, month_label, month_name, fiscal_year,
          round(avg(on_hand_packs), 0) AS avg_on_hand, round(avg(reserved_packs), 0) AS avg_reserved,
          round(avg(in_transit_packs), 0) AS avg_in_transit,
          round(avg(on_hand_packs - reserved_packs), 0) AS avg_available,
          count(DISTINCT product_id) AS unique_products
        FROM inv JOIN cal USING (date_key) GROUP BY 1, 2, 3, 4, 5"""),
    "returns_monthly": sql("frt cal", f"""
        SELECT year_num, month_num, month_label, month_name, fiscal_year, reason_code,
          count(*) AS return_count, CAST(sum(cents) AS DOUBLE) / 100 AS total_credits,
          {_half_up("sum(cents)", "count(cents)")} AS avg_credit
        FROM frt JOIN cal USING (date_key) GROUP BY 1, 2, 3, 4, 5, 6"""),
    "shipment_trends": sql("fsh cal", """
        SELECT year_num, month_num, month_label, month_name, fiscal_year, count(*) AS shipment_count,
          count(DISTINCT order_id) AS order_count, count(DISTINCT customer_id) AS unique_customers
        FROM fsh JOIN cal ON ship_date_key = date_key GROUP BY 1, 2, 3, 4, 5"""),
    "current_month_kpis": sql("fso fol fsh frt cal", f"""
        , today AS (SELECT date_key FROM cal WHERE year_num = year({AS_OF}) AND month_num = month({AS_OF})),
        sold AS (SELECT fol.* FROM fol JOIN fso USING (order_id)
                 WHERE fso.date_key IN (SELECT date_key FROM today))
        SELECT 'Revenue (Current Month)' AS kpi_name, {_REVENUE} AS kpi_value, 'USD' AS kpi_unit FROM sold
        UNION ALL SELECT 'Orders (Current Month)', CAST(count(DISTINCT order_id) AS DOUBLE), 'Count'
          FROM fso WHERE date_key IN (SELECT date_key FROM today)
        UNION ALL SELECT 'Avg Order Value (Current Month)', {_CENTS_PER_ORDER}, 'USD' FROM sold
        UNION ALL SELECT 'Shipments (Current Month)', CAST(count(*) AS DOUBLE), 'Count'
          FROM fsh WHERE ship_date_key IN (SELECT date_key FROM today)
        UNION ALL SELECT 'Returns (Current Month)', CAST(count(*) AS DOUBLE), 'Count'
          FROM frt WHERE date_key IN (SELECT date_key FROM today)""").replace("\n, today", ",\ntoday"),
}


def _ri() -> str:
    checks = [
        ("fct_sales_orders", "dim_customers_current", "customer_id", "fso", "c"),
        ("fct_sales_orders", "dim_distribution_centers_current", "dc_id", "fso", "s"),
        ("fct_sales_order_lines", "dim_products_current", "product_id", "fol", "p"),
        ("fct_inventory_snapshots", "dim_distribution_centers_current", "dc_id", "inv", "s"),
        ("fct_inventory_snapshots", "dim_products_current", "product_id", "inv", "p"),
        ("fct_shipments", "dim_distribution_centers_current", "dc_id", "fsh", "s"),
        ("fct_shipments", "dim_customers_current", "customer_id", "fsh", "c"),
        ("fct_returns", "dim_customers_current", "customer_id", "frt", "c"),
        ("fct_returns", "dim_products_current", "product_id", "frt", "p"),
    ]
    known = {"c": "SELECT CAST(c_custkey AS VARCHAR) AS k FROM customer WHERE c_acctbal >= 0",
             "s": "SELECT CAST(s_suppkey AS VARCHAR) AS k FROM supplier WHERE s_acctbal >= 0",
             "p": "SELECT CAST(p_partkey AS VARCHAR) AS k FROM part WHERE p_size <> 7"}
    each = " UNION ALL ".join(
        f"SELECT '{fact} -> {dim} ({column})' AS check_name, count(*) AS fact_rows, "
        f"CAST(sum(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unmatched_rows "
        f"FROM {part} LEFT JOIN ({known[side]}) ON {column} = k"
        for fact, dim, column, part, side in checks)
    return sql("fso fol inv fsh frt", f"""
        SELECT check_name, fact_rows, unmatched_rows,
          round(CAST(unmatched_rows AS DOUBLE) * 100 / nullif(fact_rows, 0), 4) AS unmatched_pct
        FROM ({each})""")


def _expectations(part: str, table: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS expectation, count(*) AS total_rows, "
        f"count(*) FILTER (NOT coalesce({rule}, false)) AS failed_rows, "
        f"count(*) FILTER (coalesce({rule}, false)) AS passed_rows, '{table}' AS table_name FROM {part}"
        for name, rule in rules.items())


_QUALITY = {
    "expect_or_drop": sql("patchy_lines", """
        SELECT order_id, line_id FROM patchy_lines WHERE order_id IS NOT NULL AND line_id IS NOT NULL"""),
    "expectation_report": sql("patchy patchy_lines", _expectations(
        "patchy", "fct_sales_orders",
        {"valid_order_id_not_null": "order_id IS NOT NULL", "valid_order_id_not_empty": "order_id <> ''"})
        + " UNION ALL " + _expectations(
            "patchy_lines", "fct_sales_order_lines",
            {"valid_order_id_not_null": "order_id IS NOT NULL",
             "valid_line_id_not_null": "line_id IS NOT NULL"})),
    "ri_report": _ri(),
    "inventory_breaches": sql("inv", """
        SELECT * EXCLUDE (snapshot_ts), on_hand_packs - reserved_packs AS available_packs,
          CASE WHEN on_hand_packs - reserved_packs <= 0 THEN 'CRITICAL'
               WHEN on_hand_packs - reserved_packs < 5 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
        FROM inv WHERE on_hand_packs - reserved_packs < 10"""),
}

_KEYS = {
    "dedup_first": sql("ln", """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM ln"""),
    "require_keys": sql("patchy", "SELECT * FROM patchy WHERE order_id IS NOT NULL AND order_id <> ''"),
    "unusual_money": """
        SELECT l_linenumber, count(*) AS amounts,
          l_linenumber = 4 AND bool_or(l_orderkey % 100 = 0) AS is_nan,
          l_linenumber = 5 AND bool_or(l_orderkey % 100 = 0) AS is_infinite,
          CASE WHEN l_linenumber IN (4, 5) AND bool_or(l_orderkey % 100 = 0) THEN NULL
            WHEN l_linenumber = 2 THEN count(*) * CAST(1e15 AS DOUBLE)
            WHEN l_linenumber = 3 THEN count(*) / CAST(131072 AS DOUBLE)
            ELSE round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE), 2) END AS total,
          CASE WHEN l_linenumber IN (4, 5) AND bool_or(l_orderkey % 100 = 0) THEN NULL
            WHEN l_linenumber = 2 THEN CAST(1e15 AS DOUBLE)
            WHEN l_linenumber = 3 THEN 1 / CAST(131072 AS DOUBLE)
            ELSE round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / count(*), 2) END AS mean
        FROM lineitem GROUP BY l_linenumber""",
    "date_key": """
        SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key, count(*) AS line_count
        FROM lineitem GROUP BY 1""",
    "calendar_dim": _calendar(*_WHOLE_YEARS, 1),
    "calendar_dim_fiscal_july": _calendar(*_WHOLE_YEARS, 7),
}

_HISTORY = {
    "scd2_history": sql("his", "SELECT * FROM his"),
    "dim_current": sql("his", "SELECT user_id, event_type FROM his WHERE end_at IS NULL"),
    "scd2_as_of": sql("his", """
        SELECT e.event_id, e.user_id, e.event_type AS sent, h.event_type AS found,
          h.start_at AS valid_from
        FROM events e LEFT JOIN his h ON e.user_id = h.user_id AND e.ts >= h.start_at
          AND (e.ts < h.end_at OR h.end_at IS NULL)"""),
}


def _metric(part: str, key: str, dims: dict[str, str], measures: dict[str, str],
            where: str = "", tail: str = "") -> str:
    """A metric view (fact joined to the calendar) at one grain."""
    columns = ", ".join(f'{e} AS "{n}"' for n, e in {**dims, **measures}.items())
    groups = ", ".join(str(i + 1) for i in range(len(dims)))
    return sql(f"{part} cal", f"""
        SELECT {columns} FROM {part} f LEFT JOIN cal ON f.{key} = cal.date_key
        {"WHERE " + where if where else ""} GROUP BY {groups} {tail}""")


_PER_ORDER = _half_up("sum(cents)", "count(DISTINCT order_id)", 6)
_AVERAGE = _half_up("sum(cents)", "count(cents)", 8)
_LINES = {"Revenue": _REVENUE, "Order Count": "count(DISTINCT order_id)"}
_FULFILLED = "round(sum(confirmed_qty_packs) / nullif(sum(ordered_qty_packs), 0), 6)"
_PAST = f"calendar_date <= {AS_OF}"


def _big(column: str) -> str:
    return f"CAST(sum({column}) AS BIGINT)"


_METRICS = {
    "metric_daily_revenue": _metric("fol", "date_key", {
        "Calendar Date": "calendar_date", "Year": "year_num", "Month": "month_name",
        "Month Num": "month_num", "Week Start": "week_start_date", "Day Name": "day_name",
        "Is Weekend": "is_weekend"}, {
        **_LINES, "Line Item Count": "count(*)", "Average Line Amount": _AVERAGE}),
    "metric_monthly_revenue": _metric("fol", "date_key", {
        "Calendar Year": "year_num", "Calendar Month": "month_num", "Month Label": "month_label",
        "Fiscal Year": "fiscal_year", "Fiscal Year Label": "fiscal_year_label",
        "Fiscal Month": "fiscal_month_num", "Fiscal Quarter": "fiscal_quarter_num"}, {
        **_LINES, "Average Order Value": _PER_ORDER, "Units Ordered": _big("ordered_qty_packs"),
        "Units Confirmed": _big("confirmed_qty_packs"), "Fulfillment Rate": _FULFILLED}),
    "metric_fiscal_ytd": _metric("fol", "date_key", {
        "Fiscal Year": "fiscal_year", "Fiscal Year Label": "fiscal_year_label",
        "Fiscal Month": "fiscal_month_num", "Fiscal Quarter": "fiscal_quarter_num"}, {
        "YTD Revenue": _REVENUE, "YTD Order Count": "count(DISTINCT order_id)",
        "YTD Average Order Value": _PER_ORDER}, _PAST),
    "metric_inventory": _metric("inv", "date_key", {
        "Calendar Date": "calendar_date", "Year Month": "month_label", "Month": "month_name",
        "Fiscal Year": "fiscal_year"}, {
        "Total On Hand": _big("on_hand_packs"), "Total Reserved": _big("reserved_packs"),
        "Total In Transit": _big("in_transit_packs"),
        "Available for Sale": _big("on_hand_packs - reserved_packs"),
        "Product Count": "count(DISTINCT product_id)"}),
    "metric_shipments": _metric("fsh", "ship_date_key", {
        "Ship Date": "calendar_date", "Year Month": "month_label",
        "Fiscal Quarter": "'FQ' || fiscal_quarter_num", "Shipment Status": "shipment_status"}, {
        "Shipment Count": "count(*)", "Order Count": "count(DISTINCT order_id)",
        "Unique Customers": "count(DISTINCT customer_id)"}),
    "metric_returns": _metric("frt", "date_key", {
        "Return Date": "calendar_date", "Year Month": "month_label", "Fiscal Year": "fiscal_year",
        "Return Reason": "reason_code"}, {
        "Return Count": "count(*)", "Return Amount": "round(sum(credit_amount), 2)",
        "Average Return Amount": _AVERAGE,
        "Units Returned": _big("returned_qty_packs")}),
    "mq_daily_trend": _metric("fol", "date_key", {
        "Calendar Date": "calendar_date", "Month": "month_name", "Day Name": "day_name"}, {
        "daily_revenue": _REVENUE, "orders": "count(DISTINCT order_id)", "line_items": "count(*)",
        "avg_line_amount": _AVERAGE},
        f"year(calendar_date) = {YEAR}", "ORDER BY 1 DESC LIMIT 30"),
    "mq_monthly_fiscal": _metric("fol", "date_key", {
        "Month Label": "month_label", "Fiscal Year Label": "fiscal_year_label",
        "Fiscal Quarter": "fiscal_quarter_num"}, {
        "monthly_revenue": _REVENUE, "order_count": "count(DISTINCT order_id)", "aov": _PER_ORDER,
        "fulfillment_pct": _FULFILLED}, "fiscal_year IN (2000, 2001)"),
    "mq_fiscal_ytd_quarter": _metric("fol", "date_key", {
        "Fiscal Year Label": "fiscal_year_label", "Fiscal Quarter": "fiscal_quarter_num"}, {
        "ytd_revenue": _REVENUE, "ytd_orders": "count(DISTINCT order_id)", "ytd_aov": _PER_ORDER},
        f"{_PAST} AND fiscal_year IN (2000, 2001)"),
    "mq_inventory_month": _metric("inv", "date_key", {"Year Month": "month_label"}, {
        "total_on_hand": _big("on_hand_packs"), "total_reserved": _big("reserved_packs"),
        "available": _big("on_hand_packs - reserved_packs"),
        "product_count": "count(DISTINCT product_id)"}, f"fiscal_year = {YEAR}"),
    "mq_shipments_status": _metric("fsh", "ship_date_key", {
        "Year Month": "month_label", "Shipment Status": "shipment_status"}, {
        "shipment_count": "count(*)", "order_count": "count(DISTINCT order_id)",
        "customer_count": "count(DISTINCT customer_id)"}, "fiscal_quarter_num = 1"),
    "mq_returns_reason": _metric("frt", "date_key", {
        "Year Month": "month_label", "Return Reason": "reason_code"}, {
        "return_count": "count(*)", "total_credits": "round(sum(credit_amount), 2)",
        "avg_credit": _AVERAGE}, f"fiscal_year = {YEAR}"),
    "mq_revenue_vs_returns": sql("fol frt cal", f"""
        SELECT period, revenue, orders, "returns", return_credits,
          round(100 * return_credits / nullif(revenue, 0), 2) AS return_pct_of_revenue
        FROM (SELECT month_label AS period, {_REVENUE} AS revenue, count(DISTINCT order_id) AS orders
              FROM fol JOIN cal USING (date_key) WHERE fiscal_year = {YEAR} GROUP BY 1)
        LEFT JOIN (SELECT month_label AS period, count(*) AS "returns",
                     round(sum(credit_amount), 2) AS return_credits
                   FROM frt JOIN cal USING (date_key) WHERE fiscal_year = {YEAR} GROUP BY 1)
        USING (period)"""),
    "mq_latest_ytd_kpi": _metric("fol", "date_key", {
        "fiscal_year_label": "fiscal_year_label", "fiscal_month": "fiscal_month_num"}, {
        "ytd_revenue": _REVENUE, "ytd_orders": "count(DISTINCT order_id)", "ytd_aov": _PER_ORDER},
        _PAST, "ORDER BY 1 DESC, 2 DESC LIMIT 1"),
    "mq_daily_90d": _metric("fol", "date_key", {"calendar_date": "calendar_date"}, {
        "revenue": _REVENUE, "order_count": "count(DISTINCT order_id)"},
        f"calendar_date >= {AS_OF} - 90"),
    "mq_monthly_recent": _metric("fol", "date_key", {
        "month_label": "month_label", "fiscal_quarter": "fiscal_quarter_num"}, {
        "revenue": _REVENUE, "order_count": "count(DISTINCT order_id)",
        "avg_order_value": _PER_ORDER, "fulfillment_rate": _FULFILLED}, "fiscal_year >= 2000"),
    "mq_returns_recent": _metric("frt", "date_key", {
        "year_month": "month_label", "return_reason": "reason_code"}, {
        "return_count": "count(*)", "return_amount": "round(sum(credit_amount), 2)"},
        "fiscal_year >= 2000"),
}


_NO_ADDRESS = ", ".join(f"CAST(NULL AS VARCHAR) AS address_{c}"
                        for c in ("street", "city", "state", "postal_code"))
_RAW_ORDERS = """SELECT {flow} AS flow, order_id, order_date, dc_id, customer_id, order_status,
    order_total_amount, CAST(coalesce(n, 0) AS INTEGER) AS line_count
    FROM fso LEFT JOIN (SELECT order_id AS oid, count(*) AS n FROM fol GROUP BY 1) ON order_id = oid"""


def _key(entity: str, column: str) -> str:
    return f"'{entity}-' || CAST(floor(CAST({column} AS BIGINT) / 500) AS BIGINT)"


def _sizes() -> str:
    documents = [
        ("manufacturers", "(SELECT DISTINCT p_brand FROM part)", "'manufacturers-0'", "1"),
        ("products", "part", _key("products", "p_partkey"), "1"),
        ("distribution_centers", "supplier", _key("distribution_centers", "s_suppkey"), "1"),
        ("customers", "customer", _key("customers", "c_custkey"), "1"),
        ("sales_orders", "orders", _key("sales_orders", "o_orderkey"), "1"),
        ("inventory_snapshots", "inv",
         _key("inventory_snapshots", "product_id") + " || '-' || (CAST(dc_id AS BIGINT) // 100) || '-' || year(snapshot_ts)", "1"),
        ("shipments", "ln", "CAST(NULL AS VARCHAR)", "CAST(l_orderkey AS BIGINT) // 500"),
        ("returns", "frt", _key("returns", "original_order_id"), "1"),
    ]
    return sql("inv ln frt", " UNION ALL ".join(
        f"SELECT document, '{entity}' AS entity, CAST(n AS INTEGER) AS elements "
        f"FROM (SELECT {key} AS document, {chunk} AS chunk, count(*) AS n FROM {table} GROUP BY 1, 2)"
        for entity, table, key, chunk in documents))


_STREAMS = {
    "ingest_landing": _sizes(),
    "rescue_unknown_fields": f"""
        SELECT {_key("customers", "c_custkey")} AS document, 'crm' AS feed,
          CAST(count(*) AS INTEGER) AS row_count, CAST(count(*) AS INTEGER) AS unknown_rows,
          CAST(sum(length(c_mktsegment)) AS INTEGER) AS lengths FROM customer GROUP BY 1""",
    "flatten_customers": sql("cus", f"""
        SELECT customer_id, customer_name, customer_type, region, credit_limit, is_340b_eligible,
          {_NO_ADDRESS}, address_country, {_key("customers", "customer_id")} AS bronze_record_key
        FROM cus"""),
    "flatten_products": sql("prd", f"""
        SELECT *, CAST(NULL AS VARCHAR) AS molecule, CAST(NULL AS VARCHAR) AS strength,
          {_key("products", "product_id")} AS bronze_record_key FROM prd"""),
    "flatten_manufacturers": """
        SELECT DISTINCT p_brand AS manufacturer_id, 'Maker of ' || p_brand AS manufacturer_name,
          'US' AS country, true AS gmp_certified, TIMESTAMP '1995-01-01 00:00:00' AS created_at,
          'manufacturers-0' AS bronze_record_key FROM part""",
    "flatten_distribution_centers": sql("dcs", f"""
        SELECT dc_id, dc_name, region, {_NO_ADDRESS}, address_country,
          'ambient' AS temperature_zones,
          {_key("distribution_centers", "dc_id")} AS bronze_record_key FROM dcs"""),
    "flatten_inventory": sql("inv", f"""
        SELECT *, {_key("inventory_snapshots", "product_id")} || '-' || (CAST(dc_id AS BIGINT) // 100) || '-' || year(snapshot_ts)
          AS bronze_record_key FROM inv"""),
    "flatten_shipments": sql("fsh", """
        SELECT *, CAST(NULL AS VARCHAR) AS tracking_number,
          CAST(NULL AS VARCHAR) AS bronze_record_key FROM fsh"""),
    "flatten_returns": sql("frt", f"""
        SELECT * EXCLUDE (cents), {_key("returns", "original_order_id")} AS bronze_record_key
        FROM frt"""),
    "ingest_order_backfill": sql("fso fol", _RAW_ORDERS.format(flow="'historical'")),
    "orders_fan_in": sql("fso fol", _RAW_ORDERS.format(flow="'live'") + " UNION ALL "
                         + _RAW_ORDERS.format(flow="'historical'")),
    "flatten_orders": sql("fso", f"""
        SELECT *, 'FOB' AS incoterm, 'USD' AS currency,
          {_key("sales_orders", "order_id")} AS bronze_record_key FROM fso"""),
    "flatten_order_lines": sql("fol", f"""
        SELECT * EXCLUDE (cents), confirmed_qty_packs < ordered_qty_packs AS backorder_flag,
          {_key("sales_orders", "order_id")} AS bronze_record_key FROM fol"""),
    "dedup_stream": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "dedup_bounded": """
        SELECT DISTINCT l_orderkey, l_linenumber, CAST(CASE WHEN l_orderkey % 2 = 0 THEN 0 ELSE 30 END AS INTEGER) AS day
        FROM lineitem""",
    "drop_counts": sql("fso", """,
        s AS (SELECT CAST(order_id AS BIGINT) % 5 = 0 AS missing, CAST(order_id AS BIGINT) % 7 = 0 AS blank,
                CAST(order_id AS BIGINT) % 3 = 0 AS undated FROM fso),
        n AS (SELECT count(*) AS orders, count_if(missing) AS missing, count_if(blank AND NOT missing) AS blank,
                count_if(undated) AS undated FROM s)
        SELECT flow, rule, CAST(rows AS BIGINT) AS rows FROM n, LATERAL (VALUES
          ('sales_orders_raw_live', 'rows', orders), ('sales_orders_raw_live', 'order_id_not_null', missing),
          ('sales_orders_raw_live', 'malformed_order_date', undated), ('sales_orders_raw_live', 'late', 0),
          ('sales_orders_raw_live', 'copies', greatest(blank - 1, 0)),
          ('fct_sales_orders', 'rows', orders - missing - greatest(blank - 1, 0)),
          ('fct_sales_orders', 'valid_order_id_not_null', 0), ('fct_sales_orders', 'valid_order_id_not_empty', least(blank, 1)),
          ('fct_sales_orders', 'late', 0), ('fct_sales_orders', 'copies', 0)) v(flow, rule, rows)""".lstrip()),
    "ingest_backfill_shapes": sql("fso", f""",
        k AS (SELECT DISTINCT {_key("sales_orders", "order_id")} AS key, CAST(order_id AS BIGINT) // 500 AS chunk FROM fso)
        SELECT 'order' AS kind, order_id AS name FROM fso
        UNION ALL SELECT '{{"sent":"by hand"}}', key || '-other' FROM k
        UNION ALL SELECT 'broken', key FROM k WHERE chunk % 3 = 2""".lstrip()),
    "scd2_apply": sql("his", "SELECT * FROM his"),
    "scd2_merged": sql("his", "SELECT * FROM his"),
    "run_pipeline": sql("fso fol inv fsh frt", " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, {total} AS total FROM {source}"
        for name, total, source in [
            ("fct_sales_orders", "round(sum(order_total_amount), 2)", "fso"),
            ("fct_sales_order_lines", "round(sum(line_amount), 2)", "fol"),
            ("fct_inventory_snapshots", "CAST(NULL AS DOUBLE)", "inv"),
            ("fct_shipments", "CAST(NULL AS DOUBLE)", "fsh"),
            ("fct_returns", "round(sum(credit_amount), 2)", "frt"),
            ("dim_customers_current", "round(sum(c_acctbal), 2)", "customer"),
            ("dim_products_current", "round(sum(p_retailprice), 2)", "part"),
            ("dim_manufacturers_current", "CAST(NULL AS DOUBLE)", "(SELECT DISTINCT p_brand FROM part)"),
            ("dim_distribution_centers_current", "CAST(NULL AS DOUBLE)", "supplier")])),
}


_HISTORY |= {f"{name}_by_count": _HISTORY[name] for name in ("scd2_history", "scd2_as_of")}
_GOLD["revenue_by_category_skewed"] = _GOLD["revenue_by_category"]
_STREAMS["run_pipeline_bounded"] = _STREAMS["run_pipeline"]


def _rollups() -> dict[str, str]:
    """A report from rollups equals the report from the fact."""
    reports = ("daily_trend", "monthly_fiscal", "inventory_month", "shipments_status", "returns_reason", "revenue_vs_returns")
    return {f"rollup_{name}": _METRICS[f"mq_{name}"] for name in reports} | {
        "rollup_shipment_trends": _DASHBOARD["shipment_trends"],
        "rollup_shipment_quarters": sql("fsh cal", """
            SELECT 'FQ' || fiscal_quarter_num AS quarter, count(*) AS shipments, count(DISTINCT order_id) AS orders,
              count(DISTINCT customer_id) AS customers
            FROM fsh LEFT JOIN cal ON ship_date_key = cal.date_key GROUP BY 1""")}


def oracles() -> dict[str, str]:
    """Query name to SQL."""
    return {**_KEYS, **_GOLD, **_DASHBOARD, **_QUALITY, **_HISTORY, **_METRICS, **_STREAMS, **_rollups()}
