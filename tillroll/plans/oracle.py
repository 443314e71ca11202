"""The same queries in SQL for an independent engine, written without looking at plans."""

from __future__ import annotations

from tillroll import schemas
from tillroll.plans.event_oracle import ORACLE_SQL as EVENT_SQL
from tillroll.operators.quality import BETWEEN, DISTINCT_BETWEEN, EXISTS, RETAIL_SUITE
from tillroll.sources.order_lines import COUNTRIES

RAW = tuple(f'"{name}"' for name in schemas.RAW_COLUMNS)
RAW_LIST = ", ".join(RAW)

_countries = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(COUNTRIES))
_regions = " ".join(
    "WHEN country IN ({}) THEN '{}'".format(", ".join(f"'{c}'" for c in names), group)
    for group, names in schemas.REGION_GROUPS.items()
)

# All rows of the tables are in ``sent``; ``raw`` has some of them twice. The defects go by
# key so that both engines plant them on the same lines; no part leaves rows out by key.
PARTS = {
    "sent": f"""
        SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || l_orderkey AS "Invoice",
               CAST(l_partkey AS VARCHAR) AS "StockCode",
               CASE WHEN l_partkey % 50 = 0 THEN NULL
                    WHEN l_orderkey % 3 = 0 THEN '  ' || p_name || ' '
                    ELSE p_name END AS "Description",
               CASE WHEN l_partkey % 97 = 0 THEN 'x10'
                    WHEN l_partkey % 83 = 0 THEN '10F'
                    WHEN l_partkey % 89 = 0 THEN NULL
                    WHEN l_returnflag = 'R' THEN CAST(-l_quantity AS VARCHAR)
                    ELSE CAST(l_quantity AS VARCHAR) END AS "Quantity",
               CASE WHEN l_orderkey % 101 = 0 THEN 'bad'
                    ELSE strftime(o_orderdate + to_hours(CAST(l_orderkey % 24 AS BIGINT)),
                                  '%Y-%m-%d %H:%M:%S') END AS "InvoiceDate",
               CASE WHEN l_partkey % 40 = 0 THEN '0.0'
                    WHEN l_partkey % 43 = 0 THEN '0x1p3'
                    WHEN l_partkey % 11 = 0 THEN CAST(p_retailprice AS VARCHAR) || '0499'
                    ELSE CAST(p_retailprice AS VARCHAR) END AS "Price",
               CASE WHEN o_custkey % 5 = 0 THEN NULL
                    WHEN o_custkey % 13 = 0 THEN '12d'
                    WHEN o_custkey % 7 = 0 THEN o_custkey + 3000000000 || '.0'
                    ELSE o_custkey || '.0' END AS "Customer ID",
               CASE WHEN n_nationkey = 24 THEN NULL
                    ELSE CASE n_nationkey {_countries} ELSE n_name END END AS "Country",
               l_orderkey
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey""",
    "raw": f"""
        SELECT {RAW_LIST} FROM sent
        UNION ALL
        SELECT {RAW_LIST} FROM sent WHERE l_orderkey % 31 = 0""",
    "typed": """
        SELECT "Invoice", "StockCode", "Description",
               TRY_CAST(trunc(TRY_CAST("Quantity" AS DOUBLE)) AS BIGINT) AS "Quantity",
               try_strptime("InvoiceDate", '%Y-%m-%d %H:%M:%S') AS "InvoiceDate",
               TRY_CAST("Price" AS DOUBLE) AS "Price",
               TRY_CAST(trunc(TRY_CAST("Customer ID" AS DOUBLE)) AS BIGINT)
                   AS "Customer ID",
               "Country"
        FROM raw""",
    "once": "SELECT DISTINCT * FROM typed",
    "complete": """
        SELECT * FROM once
        WHERE "Invoice" IS NOT NULL AND "StockCode" IS NOT NULL
          AND "InvoiceDate" IS NOT NULL AND "Price" IS NOT NULL
          AND "Quantity" IS NOT NULL""",
    "filled": """
        SELECT "Invoice", "StockCode", coalesce("Description", 'Unknown') AS "Description",
               "Quantity", "InvoiceDate", "Price",
               coalesce("Customer ID", 0) AS "Customer ID",
               coalesce("Country", 'Unknown') AS "Country"
        FROM complete""",
    "sales": """
        SELECT * FROM filled
        WHERE "Invoice" NOT LIKE 'C%' AND "Quantity" > 0 AND "Price" >= 0.01""",
    "cleaned": "",
    "dim_customer": """
        SELECT "Customer ID" AS customer_id, min("Country") AS country
        FROM cleaned GROUP BY 1""",
    "dim_product": """
        SELECT "StockCode" AS stock_code, min("Description") AS description
        FROM cleaned GROUP BY 1""",
    "dim_date": """
        SELECT row_number() OVER (ORDER BY full_date) AS date_id,
               full_date,
               CAST(year(full_date) AS INTEGER) AS year,
               CAST(month(full_date) AS INTEGER) AS month,
               CAST(day(full_date) AS INTEGER) AS day,
               CAST(hour(full_date) AS INTEGER) AS hour,
               CAST(dayofweek(full_date) + 1 AS INTEGER) AS weekday,
               dayofweek(full_date) IN (0, 6) AS is_weekend
        FROM (SELECT DISTINCT "InvoiceDate" AS full_date FROM cleaned)""",
    "dim_region": f"""
        SELECT row_number() OVER (ORDER BY country) AS region_id,
               country,
               CASE {_regions} ELSE 'Other' END AS region_group
        FROM (SELECT DISTINCT "Country" AS country FROM cleaned)""",
    "fact_sales": """
        SELECT "Invoice" AS invoice, "Customer ID" AS customer_id,
               "StockCode" AS stock_code, date_id, region_id,
               "Quantity" AS quantity, "Price" AS price, "Revenue" AS revenue
        FROM cleaned
        LEFT JOIN dim_date ON "InvoiceDate" IS NOT DISTINCT FROM full_date
        LEFT JOIN dim_region
          ON cleaned."Country" IS NOT DISTINCT FROM dim_region.country""",
}

DERIVED = """
        SELECT "Invoice", "StockCode", trim(upper("Description"), ' ') AS "Description",
               "Quantity", "InvoiceDate", "Price", "Customer ID", "Country",
               CAST(CAST(sign("Quantity" * "Price") AS HUGEINT) * ((
                        CAST(abs("Quantity") AS HUGEINT)
                        * CAST(round(abs("Price") * 1e8) AS HUGEINT) + 500000) // 1000000)
                    * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(31,2)) AS "Revenue",
               CAST(year("InvoiceDate") AS INTEGER) AS "Year",
               CAST(month("InvoiceDate") AS INTEGER) AS "Month",
               CAST(day("InvoiceDate") AS INTEGER) AS "Day",
               CAST(hour("InvoiceDate") AS INTEGER) AS "Hour",
               CAST(dayofweek("InvoiceDate") + 1 AS INTEGER) AS "Weekday\""""
PARTS["cleaned"] = f"{DERIVED} FROM sales"


def _sql(body: str) -> str:
    """``body`` with the parts before it that it, or another part it needs, reads."""
    needed: list[str] = []
    text = body
    for name in reversed(PARTS):
        if name in text:
            needed.insert(0, name)
            text += PARTS[name]
    if not needed:
        return body
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in needed)
    return f"WITH {parts}\n{body}"


def _percent(part: str, whole: str) -> str:
    return f"round({part} * 100.0::DOUBLE / nullif({whole}, 0), 2)"


def _money(column: str) -> str:
    return f"CAST(sum({column}) AS DECIMAL(38,2))"


def _distinct(column: str) -> str:
    return f"CAST(count(DISTINCT {column}) AS BIGINT)"


_null_count = " + ".join(f"count(*) - count({c})" for c in RAW)

_cleaned_nulls = " + ".join(
    f"count(*) - count({c})"
    for c in (*RAW, *(f'"{n}"' for n in ("Revenue", "Year", "Month", "Day", "Hour", "Weekday")))
)

_distinct_raw = f"(SELECT count(*) FROM (SELECT DISTINCT {RAW_LIST} FROM raw))"


def _distribution(column: str, tallies: str, points: str) -> str:
    return f"""
        SELECT min(v) AS min, max(v) AS max, round(avg(v), 2) AS mean, {tallies}, {points}
        FROM (SELECT TRY_CAST("{column}" AS DOUBLE) AS v FROM raw)"""


def _expectations() -> str:
    rows = []
    for check in RETAIL_SUITE:
        column = f'"{check.column}"'
        elements = unexpected = observed = "CAST(NULL AS BIGINT)"
        if check.kind == EXISTS:
            # The column is read, so the query itself fails if it is not there.
            success = f"count({column}) >= 0"
        elif check.kind == DISTINCT_BETWEEN:
            observed = _distinct(column)
            success = f"count(DISTINCT {column}) BETWEEN {check.low} AND {check.high}"
        else:
            elements = "count(*)"
            bad = f"{column} IS NULL"
            if check.kind == BETWEEN:
                bad = f"{column} < {check.low}"
                if check.high is not None:
                    bad += f" OR {column} > {check.high}"
            unexpected = f"count(*) FILTER (WHERE {bad})"
            success = f"{unexpected} = 0"
        rows.append(
            f"SELECT '{check.kind}' AS expectation, '{check.column}' AS \"column\", "
            f"{elements} AS element_count, {unexpected} AS unexpected_count, "
            f"{observed} AS observed, {success} AS success FROM cleaned"
        )
    return "\nUNION ALL\n".join(rows)


def _integrity() -> str:
    rows = [
        f"SELECT '{rule}({key})' AS \"check\", '{table}' AS \"table\", "
        f"CAST(count(*) - count(DISTINCT {key}) AS BIGINT) AS violations FROM "
        + (table if key != "sale_id" else f"(SELECT row_number() OVER () AS sale_id FROM {table})")
        for rule, table, key in schemas.UNIQUE_KEYS
    ]
    rows += [
        f"SELECT 'foreign_key({key})', 'fact_sales', CAST(count(*) AS BIGINT) "
        f"FROM fact_sales WHERE {key} IS NOT NULL "
        f"AND {key} NOT IN (SELECT {key} FROM {table})"
        for key, table in schemas.FOREIGN_KEYS
    ]
    rows += [
        f"SELECT 'width({column})', '{table}', "
        f"CAST(count(*) FILTER (WHERE length({column}) > {width}) AS BIGINT) FROM {table}"
        for table, widths in schemas.TEXT_WIDTHS.items()
        for column, width in widths.items()
    ]
    return "\nUNION ALL\n".join(rows)


def _steps() -> str:
    tables = ("typed", "once", "complete")
    counts = [f"(SELECT count(*) FROM {name})" for name in tables]
    tests = ("\"Invoice\" NOT LIKE 'C%'", '"Quantity" > 0', '"Price" >= 0.01')
    for n in range(1, len(tests) + 1):
        counts.append(f"(SELECT count(*) FROM complete WHERE {' AND '.join(tests[:n])})")
    names = (
        "remove_duplicates", "drop_incomplete", "drop_cancellations",
        "positive_quantity", "minimum_price",
    )
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS step, {counts[i]} AS rows_in, {counts[i + 1]} AS rows_out"
        for i, name in enumerate(names)
    )


BODIES = {
    "csv_ingest": f"SELECT {RAW_LIST} FROM raw",
    "required_columns": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"column\", true AS present, "
        f'count("{name}") AS rows_with_value FROM raw'
        for name in schemas.RAW_COLUMNS
    ),
    "ingest_summary": f"""
        SELECT count(*) AS total_rows, {len(RAW)} AS total_columns,
               CAST({_null_count} AS BIGINT) AS null_values,
               count(*) - {_distinct_raw} AS duplicate_rows,
               min("InvoiceDate") AS date_min, max("InvoiceDate") AS date_max,
               {_distinct('"Country"')} AS countries
        FROM raw""",
    "profile_shape": f"""
        SELECT count(*) AS total_rows, {len(RAW)} AS total_columns,
               count(*) - {_distinct_raw} AS duplicate_rows,
               {_percent(f'(count(*) - {_distinct_raw})', 'count(*)')} AS duplicate_pct,
               '{",".join(schemas.RAW_COLUMNS)}' AS columns
        FROM raw""",
    "profile_nulls": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"column\", count(*) - count(\"{name}\") AS null_count, "
        + _percent(f'(count(*) - count("{name}"))', "count(*)")
        + " AS null_pct FROM raw"
        for name in schemas.RAW_COLUMNS
    ),
    "profile_cancellations": f"""
        SELECT total_invoices, cancelled_invoices,
               {_percent("cancelled_invoices", "total_invoices")} AS cancellation_rate
        FROM (SELECT count(*) AS total_invoices,
                     count(*) FILTER (WHERE "Invoice" LIKE 'C%') AS cancelled_invoices
              FROM raw)""",
    "profile_quantity": _distribution(
        "Quantity",
        """count(*) FILTER (WHERE v < 0) AS negative,
           count(*) FILTER (WHERE v = 0) AS zero""",
        """median(v) AS median, quantile_cont(v, 0.99) AS p99,
           quantile_cont(v, 0.999) AS p999""",
    ),
    "profile_price": _distribution(
        "Price",
        """count(*) FILTER (WHERE v <= 0) AS zero_or_neg,
           count(*) FILTER (WHERE v < 0.01) AS below_001""",
        "quantile_cont(v, 0.99) AS p99",
    ),
    "profile_scope": f"""
        SELECT min(try_strptime("InvoiceDate", '%Y-%m-%d %H:%M:%S')) AS date_min,
               max(try_strptime("InvoiceDate", '%Y-%m-%d %H:%M:%S')) AS date_max,
               {_distinct('"Customer ID"')} AS unique_customers,
               {_distinct('"StockCode"')} AS unique_products,
               {_distinct('"Country"')} AS unique_countries,
               count(*) FILTER (WHERE "InvoiceDate" IS NOT NULL AND
                 try_strptime("InvoiceDate", '%Y-%m-%d %H:%M:%S') IS NULL) AS unreadable_dates,
               count(*) FILTER (WHERE "Customer ID" IS NOT NULL AND
                 TRY_CAST("Customer ID" AS DOUBLE) IS NULL) AS unreadable_customers
        FROM raw""",
    "top_countries": """
        SELECT CAST(row_number() OVER (ORDER BY cnt DESC, country) AS INTEGER) AS rank,
               country, cnt
        FROM (SELECT "Country" AS country, count(*) AS cnt FROM raw
              WHERE "Country" IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)""",
    "fix_types": "SELECT * FROM typed",
    "dedup": "SELECT * FROM once",
    "drop_nulls": """
        SELECT * FROM typed
        WHERE "Invoice" IS NOT NULL AND "StockCode" IS NOT NULL
          AND "InvoiceDate" IS NOT NULL AND "Price" IS NOT NULL
          AND "Quantity" IS NOT NULL""",
    "fill_nulls": """
        SELECT "Invoice", "StockCode", coalesce("Description", 'Unknown') AS "Description",
               "Quantity", "InvoiceDate", "Price",
               coalesce("Customer ID", 0) AS "Customer ID",
               coalesce("Country", 'Unknown') AS "Country"
        FROM typed""",
    "filter_bad_data": """
        SELECT * FROM typed
        WHERE "Invoice" NOT LIKE 'C%' AND "Quantity" > 0 AND "Price" >= 0.01""",
    "derived_columns": f"{DERIVED} FROM typed",
    "step_counts": _steps(),
    "cleaned": "SELECT * FROM cleaned",
    "monthly": f"""
        SELECT "Year", "Month", {_money('"Revenue"')} AS "MonthlyRevenue",
               {_distinct('"Invoice"')} AS "TotalOrders",
               {_distinct('"Customer ID"')} AS "UniqueCustomers"
        FROM cleaned GROUP BY 1, 2""",
    "top_products": f"""
        SELECT "StockCode", "Description", {_money('"Revenue"')} AS "TotalRevenue",
               CAST(sum("Quantity") AS BIGINT) AS "TotalQuantity"
        FROM cleaned GROUP BY 1, 2
        ORDER BY "TotalRevenue" DESC, "StockCode", "Description" LIMIT 20""",
    "by_country": f"""
        SELECT "Country", {_money('"Revenue"')} AS "TotalRevenue",
               {_distinct('"Customer ID"')} AS "UniqueCustomers",
               {_distinct('"Invoice"')} AS "TotalOrders"
        FROM cleaned GROUP BY 1""",
    "rank_products": f"""
        SELECT *, rank() OVER (PARTITION BY "Country" ORDER BY "TotalRevenue" DESC)
                    AS "RevenueRank"
        FROM (SELECT "StockCode", "Description", "Country",
                     {_money('"Revenue"')} AS "TotalRevenue"
              FROM cleaned GROUP BY 1, 2, 3)""",
    "precheck": f"""
        SELECT count(*) AS total_rows,
               CAST({_cleaned_nulls} AS BIGINT) AS null_values,
               count(*) FILTER (WHERE "Quantity" < 0) AS negative_quantity,
               count(*) FILTER (WHERE "Price" < 0) AS negative_price,
               count(*) FILTER (WHERE "Revenue" <= 0) AS zero_revenue
        FROM cleaned""",
    "expectations": _expectations(),
    "revenue_integrity": """
        SELECT count(*) FILTER (WHERE bad) AS mismatches,
               count(*) FILTER (WHERE bad) = 0 AS passed
        FROM (SELECT "Revenue" IS NULL OR abs("Revenue"
                     - round(CAST("Quantity" AS DECIMAL(19,0)) * CAST("Price" AS DECIMAL(18,8)), 2))
                     > 0.01 AS bad FROM cleaned)""",
    "validation_summary": f"""
        SELECT count(*) AS evaluated, count(*) FILTER (WHERE success) AS successful,
               bool_and(success) AS all_passed
        FROM ({_expectations()})""",
    **{name: f"SELECT * FROM {name}" for name in PARTS if name.startswith("dim_")},
    "fact_sales": "SELECT * FROM fact_sales",
    "star_integrity": _integrity(),
    "verify_load": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {name}"
        for name in schemas.STAR_SCHEMAS
    ),
    "export_monthly": f"""
        SELECT year, month, {_money("revenue")} AS monthly_revenue,
               {_distinct("invoice")} AS total_orders,
               {_distinct("customer_id")} AS unique_customers,
               make_date(year, month, 1) AS month_year
        FROM fact_sales JOIN dim_date USING (date_id) GROUP BY year, month""",
    "export_top_products": f"""
        SELECT stock_code, description, {_money("revenue")} AS total_revenue,
               CAST(sum(quantity) AS BIGINT) AS total_quantity,
               {_distinct("invoice")} AS total_orders
        FROM fact_sales JOIN dim_product USING (stock_code)
        GROUP BY stock_code, description
        ORDER BY total_revenue DESC, stock_code LIMIT 20""",
    "export_by_country": f"""
        SELECT country, region_group, {_money("revenue")} AS total_revenue,
               {_distinct("customer_id")} AS unique_customers,
               {_distinct("invoice")} AS total_orders
        FROM fact_sales JOIN dim_region USING (region_id)
        GROUP BY country, region_group""",
}

_LATER = """
    later AS (
        SELECT * REPLACE (
            CASE WHEN CAST("StockCode" AS BIGINT) % 19 = 0 THEN "Quantity" + 1
                 ELSE "Quantity" END AS "Quantity",
            CASE WHEN CAST("StockCode" AS BIGINT) % 23 <> 0 THEN "Description" END
                AS "Description")
        FROM cleaned WHERE CAST("StockCode" AS BIGINT) % 17 <> 0),
    second AS (
        SELECT * FROM later
        UNION ALL SELECT * FROM later WHERE CAST("StockCode" AS BIGINT) % 29 = 0
        UNION ALL SELECT * REPLACE ('N' || "Invoice" AS "Invoice") FROM later
                  WHERE CAST("StockCode" AS BIGINT) % 31 = 0)"""

_VALUES = (
    "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country", "Revenue",
    "Year", "Month", "Day", "Hour", "Weekday",
)


def _with(body: str, *parts: str) -> str:
    """``body`` over the cleaned lines and further parts that read them."""
    head = _sql("SELECT 1 FROM cleaned")
    return head[: head.rindex(")") + 1] + "".join(f",{part}" for part in parts) + body


def _load_changes_sql() -> str:
    differs = ", ".join(
        f"""CASE WHEN any_value("{c}") FILTER (WHERE load = 1) IS DISTINCT FROM
             any_value("{c}") FILTER (WHERE load = 2) THEN '{c}' END"""
        for c in _VALUES
    )
    row = ", ".join(f'"{c}"' for c in _VALUES)
    return _with(
        f"""
    SELECT "Invoice", "StockCode",
           CASE WHEN b = 0 THEN 'added' WHEN a = 0 THEN 'removed' ELSE 'changed' END AS status,
           b AS rows_before, a AS rows_after,
           CASE WHEN a = 1 AND b = 1 THEN named END AS changed_columns
    FROM (
        SELECT "Invoice", "StockCode", count(*) FILTER (WHERE load = 1) AS b,
               count(*) FILTER (WHERE load = 2) AS a,
               list_sort(list(({row})) FILTER (WHERE load = 1)) AS rows_b,
               list_sort(list(({row})) FILTER (WHERE load = 2)) AS rows_a,
               concat_ws(',', {differs}) AS named
        FROM both_loads GROUP BY 1, 2)
    WHERE rows_b IS DISTINCT FROM rows_a""",
        _LATER,
        """
    both_loads AS (
        SELECT 1 AS load, * FROM cleaned UNION ALL SELECT 2 AS load, * FROM second)""",
    )


def _load_summary_sql() -> str:
    kinds = {
        "added": "a - b", "removed": "b - a", "kept": "least(a, b)", "repeated": "a - 1",
    }
    columns = ", ".join(f'"{c}"' for c in ("Invoice", "StockCode", *_VALUES))
    body = "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS status, CAST(sum(greatest({n}, 0)) AS BIGINT) AS rows,
            count(*) FILTER (WHERE {n} > 0) AS different FROM counted"""
        for name, n in kinds.items()
    )
    return _with(
        f"\n{body}",
        _LATER,
        f"""
    counted AS (
        SELECT count(*) FILTER (WHERE load = 1) AS b, count(*) FILTER (WHERE load = 2) AS a
        FROM (SELECT 1 AS load, * FROM cleaned UNION ALL SELECT 2, * FROM second)
        GROUP BY {columns})""",
    )


def _by_sets(keys: tuple[str, ...], sets: str) -> str:
    named = ", ".join(f'"{k}"' for k in keys)
    return f"""
        SELECT {named}, GROUPING({named}) AS level, {_money('"Revenue"')} AS revenue,
               {_distinct('"Invoice"')} AS orders, {_distinct('"Customer ID"')} AS customers
        FROM (SELECT *, CASE {_regions.replace("country IN", '"Country" IN')} ELSE 'Other' END
                AS "Region" FROM cleaned)
        GROUP BY {sets}"""


BODIES |= {
    "sales_rollup": _by_sets(
        ("Region", "Country", "Year", "Month"), 'ROLLUP ("Region", "Country", "Year", "Month")'
    ),
    "sales_cube": _by_sets(("Region", "Year", "Weekday"), 'CUBE ("Region", "Year", "Weekday")'),
    "sales_grouping_sets": _by_sets(
        ("Country", "Year", "Month", "Hour"),
        'GROUPING SETS (("Country", "Year"), ("Year", "Month"), ("Hour"))',
    ),
}
_DAYS = f"""
    by_day AS (
        SELECT "Customer ID" AS customer_id, CAST("InvoiceDate" AS DATE) AS day,
               {_money('"Revenue"')} AS revenue
        FROM cleaned GROUP BY 1, 2),
    since AS (
        SELECT *, CAST(date_diff('day', lag(day) OVER (PARTITION BY customer_id ORDER BY day), day)
                    AS INTEGER) AS days_since FROM by_day),
    days AS (
        SELECT customer_id, day, revenue, days_since,
               CAST(sum(revenue) OVER (PARTITION BY customer_id ORDER BY day
                 RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW) AS DECIMAL(38,2))
                 AS rolling_revenue,
               CAST(sum(CASE WHEN days_since <= 90 THEN 0 ELSE 1 END)
                 OVER (PARTITION BY customer_id ORDER BY day) AS BIGINT) AS run
        FROM since)"""
_REGION = f"CASE {_regions.replace('country IN', '"Country" IN')} ELSE 'Other' END"
LOADS = {
    "customer_days": _with(" SELECT * FROM days", _DAYS),
    "activity_runs": _with(
        """
        SELECT customer_id, run, min(day) AS first_day, max(day) AS last_day,
               count(*) AS active_days, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue,
               arg_min(coalesce(days_since, -1), day) AS first_pause
        FROM days GROUP BY 1, 2""",
        _DAYS,
    ),
    "pivot_region_months": _with(
        " SELECT \"Year\", \"Month\", "
        + ", ".join(
            f"CAST(coalesce(sum(\"Revenue\") FILTER (WHERE {_REGION} = '{name}'), 0)"
            f" AS DECIMAL(38,2)) AS \"{name}\""
            for name in (*schemas.REGION_GROUPS, schemas.OTHER_REGION)
        )
        + " FROM cleaned GROUP BY 1, 2"
    ),
}
LOADS["activity_runs"] = (
    "SELECT * EXCLUDE (first_pause), nullif(first_pause, -1) AS pause_before FROM ("
    + LOADS["activity_runs"]
    + ")"
)
LOADS |= {"load_changes": _load_changes_sql(), "load_change_summary": _load_summary_sql()}

ORACLE_SQL = {**{name: _sql(body) for name, body in BODIES.items()}, **LOADS, **EVENT_SQL}
