"""DuckDB statements that compute every registered query independently.

The statements state results over the raw test tables (views ``region``, ``nation``,
``customer``, ``part``, ``orders``, ``lineitem``). Target tables are stated
without any dimension or key table: ``shopper``, ``goods``, ``bought`` and ``item`` are raw rows with their
ranks, ``sold`` is their natural combination, and a surrogate key is the rank of the raw columns that order it.
The integrity statements rebuild the source mapping of ``starloom.sources.tpch``. Output
columns carry the same names and types as the Spark queries.

DuckDB notes: decimal / integer gives DOUBLE, so percentages are scaled with
``* 0.01``.
"""

from __future__ import annotations

from starloom.schemas import LOAD_ORDER, TARGET_TABLES
from starloom.sinks.digest import HEX_DIGITS, NULL_TEXT, SEPARATOR, column_groups

LINE_ORDER = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
              "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")

_SOURCE = f"""
src_country AS (
  SELECT CAST(r_regionkey AS BIGINT) AS country_id, r_name AS country_name,
         upper(substr(r_name, 1, 2)) AS country_code
  FROM region),
src_state AS (
  SELECT CAST(n_nationkey AS BIGINT) AS state_id, n_name AS state_name,
         lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_code,
         CAST(n_regionkey AS BIGINT) AS country_id
  FROM nation),
src_city AS (
  SELECT row_number() OVER (ORDER BY state_id, city_name) AS city_id, city_name, state_id
  FROM (SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS state_id, c_mktsegment AS city_name
        FROM customer) t),
src_address AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS address_id,
         lpad(CAST(c.c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code, ci.city_id
  FROM customer c
  JOIN src_city ci ON ci.state_id = c.c_nationkey AND ci.city_name = c.c_mktsegment),
src_customer AS (
  SELECT CAST(c_custkey AS BIGINT) AS customer_id,
         split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         CAST(NULL AS VARCHAR) AS phone,
         CASE WHEN c_custkey % 10 <> 0
              THEN make_date(CAST(1950 + c_custkey % 60 AS BIGINT),
                             CAST(1 + c_custkey % 12 AS BIGINT),
                             CAST(1 + c_custkey % 28 AS BIGINT)) END AS date_of_birth,
         CAST(c_custkey AS BIGINT) AS address_id
  FROM customer),
src_category AS (
  SELECT row_number() OVER (ORDER BY category_name) AS category_id, category_name
  FROM (SELECT DISTINCT p_type AS category_name FROM part) t),
src_brand AS (
  SELECT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS brand_id, p_brand AS brand_name,
         CAST(split_part(p_brand, '#', 2) AS BIGINT) % 5 AS country_id
  FROM (SELECT DISTINCT p_brand FROM part) t),
src_status AS (
  SELECT * FROM (VALUES (1, 'Active'), (2, 'Seasonal'), (3, 'Discontinued'))
         AS t(status_id, status_name)),
src_uom AS (
  SELECT * FROM (VALUES (1, 'EA', 'Each'), (2, 'BX', 'Box')) AS t(uom_id, uom_code, uom_desc)),
src_product AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
         p_name AS product_name, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS brand_id,
         cat.category_id,
         CASE WHEN p_size <= 40 THEN 1 WHEN p_size <= 45 THEN 2 ELSE 3 END AS status_id,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CASE WHEN p_size <= 25 THEN 1 ELSE 2 END AS uom_id,
         CAST(p_size AS DECIMAL(8,3)) AS weight_kg, CAST(NULL AS SMALLINT) AS warranty_months,
         CAST(NULL AS DATE) AS introduced_date
  FROM part JOIN src_category cat ON cat.category_name = p_type),
src_order AS (
  SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS order_status
  FROM orders),
src_line_raw AS (
  SELECT row_number() OVER (ORDER BY {LINE_ORDER}) AS order_line_id,
         CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_partkey AS BIGINT) AS product_id,
         CAST(l_quantity AS SMALLINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
         CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_pct,
         CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS ship_date
  FROM lineitem),
src_line AS (
  SELECT order_line_id, order_id, product_id, quantity, unit_price, discount_pct,
         CAST(round(unit_price * quantity - unit_price * quantity * discount_pct * 0.01, 2)
              AS DECIMAL(10,2)) AS line_total,
         ship_date
  FROM src_line_raw)"""

_RAW = f"""
shopper AS (
  SELECT c_custkey, c_name, c_mktsegment AS town, n_name AS province, r_name AS land,
         lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS province_code, upper(left(r_name, 2)) AS land_code,
         row_number() OVER (ORDER BY c_custkey) AS shopper_rank,
         dense_rank() OVER (ORDER BY r_name, n_name, c_mktsegment) AS place_rank
  FROM customer, nation, region WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey),
goods AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, r_name AS maker,
         CASE WHEN p_size > 45 THEN 'Discontinued' WHEN p_size > 40 THEN 'Seasonal' ELSE 'Active' END AS state_of_sale,
         CASE WHEN p_size > 25 THEN 'BX' ELSE 'EA' END AS sold_by,
         row_number() OVER (ORDER BY p_partkey) AS goods_rank
  FROM part, region WHERE r_regionkey = CAST(split_part(p_brand, '#', 2) AS BIGINT) % 5),
bought AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS bought_on,
         dense_rank() OVER (ORDER BY o_orderstatus) AS status_rank
  FROM orders),
item AS (
  SELECT l_orderkey, l_partkey, CAST(l_quantity AS SMALLINT) AS pieces,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS price, CAST(l_discount * 100 AS DECIMAL(5,2)) AS percent,
         CASE l_linestatus WHEN 'F' THEN CAST(l_shipdate AS DATE) END AS sent_on,
         row_number() OVER (ORDER BY {LINE_ORDER}) AS item_rank
  FROM lineitem),
sold AS (
  SELECT *, price * pieces AS worth, price * pieces * percent * 0.01 AS rebate,
         CAST(round(price * pieces - price * pieces * percent * 0.01, 2) AS DECIMAL(10,2)) AS paid
  FROM item JOIN bought ON l_orderkey = o_orderkey JOIN shopper ON o_custkey = c_custkey
       JOIN goods ON l_partkey = p_partkey)"""


def _day_key(day: str) -> str:
    """A day as the integer year, month, day."""
    return f"CAST(10000 * year({day}) + 100 * month({day}) + day({day}) AS INTEGER)"


def _select(columns: dict[str, str], rest: str) -> str:
    return "SELECT " + ",\n       ".join(f"{e} AS {name}" for name, e in columns.items()) + f"\n{rest}"


def _null(kind: str) -> str:
    return f"CAST(NULL AS {kind})"


_VERSION = {"effective_from": "DATE '2022-01-01'", "effective_to": _null("DATE"), "is_current": "CAST(1 AS SMALLINT)"}

_BIRTH = """CASE WHEN c_custkey % 10 > 0 THEN make_date(CAST(1950 + c_custkey % 60 AS BIGINT),
         CAST(1 + c_custkey % 12 AS BIGINT), CAST(1 + c_custkey % 28 AS BIGINT)) END"""

_PLACE = {"city": "town", "state": "province", "state_code": "province_code", "country": "land", "country_code": "land_code"}

_CUSTOMERS = _select({
    "customer_key": "shopper_rank", "customer_id": "CAST(c_custkey AS BIGINT)",
    "first_name": "split_part(c_name, '#', 1)", "last_name": "split_part(c_name, '#', 2)",
    "full_name": "replace(c_name, '#', ' ')", "email": "replace(lower(c_name), '#', '.') || '@example.com'",
    "phone": _null("VARCHAR"), "date_of_birth": "born",
    # years of birth by the age reached in 2024
    "age_band": "CASE WHEN year(born) > 1999 THEN '18-24' WHEN year(born) > 1989 THEN '25-34' WHEN year(born) > 1979 THEN '35-44' "
                "WHEN year(born) > 1969 THEN '45-54' ELSE '55+' END",
    **_PLACE, "postal_code": "right('0000' || CAST(c_custkey % 100000 AS VARCHAR), 5)", **_VERSION},
    f"FROM (SELECT *, {_BIRTH} AS born FROM shopper)")

_PRODUCTS = _select({
    "product_key": "goods_rank", "product_id": "CAST(p_partkey AS BIGINT)", "sku": "concat('SKU-', p_partkey)",
    "product_name": "p_name", "brand": "p_brand", "brand_country": "maker", "category": "p_type",
    "product_status": "state_of_sale", "unit_of_measure": "sold_by",
    "current_unit_price": "CAST(p_retailprice AS DECIMAL(10,2))", "weight_kg": "CAST(p_size AS DECIMAL(8,3))",
    "warranty_months": _null("SMALLINT"), "introduced_date": _null("DATE"), **_VERSION}, "FROM goods")

_GEOGRAPHY = _select({"geography_key": "place_rank", **_PLACE}, "FROM shopper GROUP BY ALL")

_STATUSES = "SELECT DISTINCT status_rank AS order_status_key, o_orderstatus AS order_status FROM bought"

_FACT = _select({
    "sales_key": "row_number() OVER (ORDER BY item_rank)", "order_line_id": "item_rank",
    "order_id": "CAST(o_orderkey AS BIGINT)", "order_date_key": _day_key("bought_on"), "ship_date_key": _day_key("sent_on"),
    "customer_key": "shopper_rank", "product_key": "goods_rank", "geography_key": "place_rank", "order_status_key": "status_rank",
    "quantity": "pieces", "unit_price": "price", "discount_pct": "percent",
    "discount_amount": "CAST(round(rebate, 2) AS DECIMAL(10,2))", "gross_sales_amount": "CAST(worth AS DECIMAL(10,2))",
    "net_sales_amount": "paid", "cost_amount": _null("DECIMAL(10,2)"), "gross_margin_amount": _null("DECIMAL(10,2)"),
    "days_to_ship": "CAST(sent_on - bought_on AS SMALLINT)"}, "FROM sold")


def _by_month(grain: dict[str, str]) -> str:
    """Sums of each month's first day and ``grain``: lines, pieces and money, the latter rounded once."""
    return _select({**grain, "month": "CAST(date_trunc('month', bought_on) AS DATE)", "lines": "count(*)", "units": "sum(pieces)",
                    "full_money": "round(sum(worth), 2)", "off_money": "round(sum(rebate), 2)", "net_money": "sum(paid)"},
                   "FROM sold GROUP BY ALL")


def _so_far(measure: str, grain: dict[str, str], kind: str) -> str:
    return f"CAST(sum({measure}) OVER (PARTITION BY {', '.join(grain)}, year(month) ORDER BY month) AS {kind})"


def _snapshot(grain: dict[str, str], count_t: str, money_t: str) -> str:
    return _select({
        "snapshot_key": f"row_number() OVER (ORDER BY {', '.join(grain)}, month)", "snapshot_date_key": _day_key("last_day(month)"),
        **{name: name for name in grain},
        "order_count": f"CAST(lines AS {count_t})", "quantity_sold": f"CAST(units AS {count_t})",
        "gross_sales_amount": f"CAST(full_money AS {money_t})", "discount_amount": f"CAST(off_money AS {money_t})",
        "net_sales_amount": f"CAST(net_money AS {money_t})", "gross_margin_amount": _null(money_t),
        "ytd_order_count": _so_far("lines", grain, count_t), "ytd_quantity_sold": _so_far("units", grain, count_t),
        "ytd_net_sales": _so_far("net_money", grain, money_t)}, f"FROM ({_by_month(grain)})")


_KEY_GRAIN = {"customer_key": "shopper_rank", "product_key": "goods_rank", "geography_key": "place_rank"}
_SNAPSHOT = _snapshot(_KEY_GRAIN, "INTEGER", "DECIMAL(12,2)")


def _report(first: str = "", last: str = "") -> str:
    """Every sold line with its names; of a calendar from ``first`` to ``last``, days outside are unknown and such orders left out."""
    within = f"BETWEEN DATE '{first}' AND DATE '{last}'"
    return _select({
        "sales_key": "sales_rank", "order_id": "CAST(o_orderkey AS BIGINT)", "order_line_id": "item_rank", "order_date": "bought_on",
        "ship_date": f"CASE WHEN sent_on {within} THEN sent_on END" if first else "sent_on",
        "days_to_ship": "CAST(sent_on - bought_on AS SMALLINT)", "customer_name": "replace(c_name, '#', ' ')",
        "customer_city": "town", "customer_state": "province", "customer_country": "land",
        "product_name": "p_name", "brand": "p_brand", "category": "p_type",
        "ship_city": "town", "ship_state": "province", "ship_country": "land", "order_status": "o_orderstatus",
        "quantity": "pieces", "unit_price": "price", "discount_pct": "percent",
        "discount_amount": "CAST(round(rebate, 2) AS DECIMAL(10,2))", "gross_sales_amount": "CAST(worth AS DECIMAL(10,2))",
        "net_sales_amount": "paid"},
        f"FROM (SELECT *, row_number() OVER (ORDER BY item_rank) AS sales_rank FROM sold) {f'WHERE bought_on {within}' if first else ''}")


_DAYS = """
span AS (
  SELECT min(d) AS first, max(d) AS last
  FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem)),
days AS (
  SELECT CAST(make_date(year(first), 1, 1) + CAST(k AS INTEGER) AS DATE) AS d
  FROM span, range(0, date_diff('day', make_date(year(first), 1, 1), make_date(year(last), 12, 31)) + 1) AS r(k))"""

_CALENDAR = _select({
    "date_key": _day_key("d"), "full_date": "d", **{
        name: f"CAST({e} AS {kind})" if kind else e for name, kind, e in (
            ("day_of_week", "SMALLINT", "isodow(d)"), ("day_name", "", "dayname(d)"), ("day_of_month", "SMALLINT", "day(d)"),
            ("day_of_year", "SMALLINT", "dayofyear(d)"), ("week_of_year", "SMALLINT", "strftime(d, '%W')"),
            ("month_number", "SMALLINT", "month(d)"), ("month_name", "", "monthname(d)"), ("month_short", "", "left(monthname(d), 3)"),
            ("quarter_number", "SMALLINT", "quarter(d)"), ("quarter_name", "", "concat('Q', quarter(d))"),
            ("year_number", "SMALLINT", "year(d)"), ("is_weekend", "SMALLINT", "isodow(d) > 5"), ("is_holiday", "SMALLINT", "0"),
            ("fiscal_year", "SMALLINT", "year(d)"), ("fiscal_quarter", "SMALLINT", "quarter(d)"), ("fiscal_month", "SMALLINT", "month(d)"))}},
    "FROM days")

#: The statement of each target table, over ``_RAW`` and ``_DAYS``.
_TARGET = {"dim_date": _CALENDAR, "dim_customer": _CUSTOMERS, "dim_product": _PRODUCTS, "dim_geography": _GEOGRAPHY,
           "dim_order_status": _STATUSES, "fact_sales": _FACT, "fact_sales_monthly_snapshot": _SNAPSHOT}


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


#: All target tables by name.
_STAR = (_RAW, _DAYS, *(f"\n{name} AS ({statement})" for name, statement in _TARGET.items()))


def _digest_sql() -> str:
    """Rows and digests as ``starloom.sinks.digest`` defines them."""
    def digest(cols: list[str]) -> str:
        parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_TEXT}')" for c in cols)
        text = f"concat_ws(chr({ord(SEPARATOR)}), {parts})"
        return f"CAST(coalesce(sum(CAST('0x' || left(md5({text}), {HEX_DIGITS}) AS BIGINT)), 0) AS VARCHAR)"

    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, "
        + ", ".join(f"{digest(cols)} AS {group}" for group, cols in column_groups(table).items())
        + f", true AS as_written FROM {name}" for name, table in TARGET_TABLES.items())


_PROFILE_COLS = {
    "dim_customer": [
        ("customer_key", 1, None), ("customer_id", 1, None), ("first_name", 1, 100),
        ("last_name", 1, 100), ("full_name", 1, 200), ("email", 1, 255), ("phone", 0, 30),
        ("date_of_birth", 0, None), ("age_band", 0, 20), ("city", 1, 100), ("state", 1, 100),
        ("state_code", 1, 2), ("country", 1, 100), ("country_code", 1, 2),
        ("postal_code", 1, 20), ("effective_from", 1, None), ("effective_to", 0, None),
        ("is_current", 1, None)],
    "dim_product": [
        ("product_key", 1, None), ("product_id", 1, None), ("sku", 1, 50),
        ("product_name", 1, 200), ("brand", 1, 100), ("brand_country", 1, 100),
        ("category", 1, 100), ("product_status", 1, 50), ("unit_of_measure", 1, 20),
        ("current_unit_price", 1, None), ("weight_kg", 0, None), ("warranty_months", 0, None),
        ("introduced_date", 0, None), ("effective_from", 1, None), ("effective_to", 0, None),
        ("is_current", 1, None)],
}


_PROFILE_COLS |= {
    "dim_date": [
        ("date_key", 1, None), ("full_date", 1, None), ("day_of_week", 1, None), ("day_name", 1, 10),
        ("day_of_month", 1, None), ("day_of_year", 1, None), ("week_of_year", 1, None),
        ("month_number", 1, None), ("month_name", 1, 10), ("month_short", 1, 3),
        ("quarter_number", 1, None), ("quarter_name", 1, 2), ("year_number", 1, None),
        ("is_weekend", 1, None), ("is_holiday", 1, None), ("fiscal_year", 1, None),
        ("fiscal_quarter", 1, None), ("fiscal_month", 1, None)],
    "dim_geography": [
        ("geography_key", 1, None), ("city", 1, 100), ("state", 1, 100), ("state_code", 1, 2),
        ("country", 1, 100), ("country_code", 1, 2)],
    "dim_order_status": [("order_status_key", 1, None), ("order_status", 1, 20)],
    "fact_sales": [
        ("sales_key", 1, None), ("order_line_id", 1, None), ("order_id", 1, None),
        ("order_date_key", 1, None), ("ship_date_key", 0, None), ("customer_key", 1, None),
        ("product_key", 1, None), ("geography_key", 1, None), ("order_status_key", 1, None),
        ("quantity", 1, None), ("unit_price", 1, None), ("discount_pct", 1, None),
        ("discount_amount", 1, None), ("gross_sales_amount", 1, None), ("net_sales_amount", 1, None),
        ("cost_amount", 0, None), ("gross_margin_amount", 0, None), ("days_to_ship", 0, None)],
    "fact_sales_monthly_snapshot": [
        ("snapshot_key", 1, None), ("snapshot_date_key", 1, None), ("customer_key", 1, None),
        ("product_key", 1, None), ("geography_key", 1, None), ("order_count", 1, None),
        ("quantity_sold", 1, None), ("gross_sales_amount", 1, None), ("discount_amount", 1, None),
        ("net_sales_amount", 1, None), ("gross_margin_amount", 0, None), ("ytd_order_count", 1, None),
        ("ytd_quantity_sold", 1, None), ("ytd_net_sales", 1, None)],
}

# Keys of the source model: table, its statement above, primary key, unique keys.
_SOURCE_KEYS = [
    ("country", "src_country", "country_id", ["country_code"]),
    ("state", "src_state", "state_id", []),
    ("city", "src_city", "city_id", []),
    ("address", "src_address", "address_id", []),
    ("customer", "src_customer", "customer_id", ["email"]),
    ("product_category", "src_category", "category_id", ["category_name"]),
    ("brand", "src_brand", "brand_id", ["brand_name"]),
    ("unit_of_measure", "src_uom", "uom_id", ["uom_code"]),
    ("product_status", "src_status", "status_id", ["status_name"]),
    ("product", "src_product", "product_id", ["sku"]),
    ("sales_order", "src_order", "order_id", []),
    ("sales_order_line", "src_line", "order_line_id", []),
]


def _source_integrity_sql() -> str:
    names = {cte: name for name, cte, _, _ in _SOURCE_KEYS}
    parts = [f"SELECT '{name}({key})' AS constraint_name, '{kind}' AS kind, CAST(count(*) AS BIGINT) AS violations "
             f"FROM (SELECT {key} FROM {cte} GROUP BY {key} HAVING count(*) > 1) d"
             for name, cte, primary, unique in _SOURCE_KEYS
             for kind, key in [("primary", primary), *(("unique", u) for u in unique)]]
    parts += [f"SELECT '{names[child]}({fk}) -> {names[parent]}', 'foreign', CAST(count(*) AS BIGINT) FROM {child} c "
              f"WHERE c.{fk} IS NOT NULL AND c.{fk} NOT IN (SELECT {ppk} FROM {parent})"
              for _, child, _, fk, parent, ppk, where in _ORPHAN_CHECKS if not where]
    return "\nUNION ALL\n".join(parts)


def _profile_sql(table: str) -> str:
    parts = []
    for col, nn, width in _PROFILE_COLS[table]:
        if width is None:
            w_over, w_max, w_decl = "CAST(0 AS BIGINT)", "CAST(NULL AS INTEGER)", \
                "CAST(NULL AS INTEGER)"
        else:
            w_over = f"CAST(count(*) FILTER (WHERE length({col}) > {width}) AS BIGINT)"
            w_max = f"CAST(max(length({col})) AS INTEGER)"
            w_decl = f"CAST({width} AS INTEGER)"
        parts.append(
            f"SELECT '{table}' AS table_name, '{col}' AS column_name, "
            f"{nn} AS declared_not_null, "
            f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS null_count, "
            f"{w_decl} AS declared_width, {w_over} AS over_width_count, "
            f"{w_max} AS max_length FROM {table}")
    return "\nUNION ALL\n".join(parts)


_ORPHAN_CHECKS = [
    ("sales_order_line.order_id", "src_line", "order_line_id", "order_id", "src_order",
     "order_id", ""),
    ("sales_order_line.product_id", "src_line", "order_line_id", "product_id", "src_product",
     "product_id", ""),
    ("sales_order.customer_id", "src_order", "order_id", "customer_id", "src_customer",
     "customer_id", ""),
    ("customer.address_id", "src_customer", "customer_id", "address_id", "src_address",
     "address_id", ""),
    ("address.city_id", "src_address", "address_id", "city_id", "src_city", "city_id", ""),
    ("city.state_id", "src_city", "city_id", "state_id", "src_state", "state_id", ""),
    ("state.country_id", "src_state", "state_id", "country_id", "src_country", "country_id", ""),
    ("product.category_id", "src_product", "product_id", "category_id", "src_category",
     "category_id", ""),
    ("product.status_id", "src_product", "product_id", "status_id", "src_status",
     "status_id", ""),
    ("product.uom_id", "src_product", "product_id", "uom_id", "src_uom", "uom_id", ""),
    ("product.brand_id", "src_product", "product_id", "brand_id", "src_brand", "brand_id", ""),
    ("brand.country_id", "src_brand", "brand_id", "country_id", "src_country", "country_id",
     ""),
    ("sales_order_line.order_id->fulfilled", "src_line", "order_line_id", "order_id",
     "src_order", "order_id", "WHERE p.order_status = 'F'"),
]


def _orphans_sql() -> str:
    parts = []
    for name, child, cpk, fk, parent, ppk, where in _ORPHAN_CHECKS:
        parts.append(
            f"SELECT '{name}' AS constraint_name, CAST(c.{cpk} AS BIGINT) AS child_key, "
            f"CAST(c.{fk} AS BIGINT) AS fk_value FROM {child} c "
            f"WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p {where} {'AND' if where else 'WHERE'} "
            f"p.{ppk} = c.{fk})")
    return "\nUNION ALL\n".join(parts)


def _integrity_sql() -> str:
    parts = []
    for name, t in TARGET_TABLES.items():
        keys = ([("primary", t.primary_key)] if t.primary_key else []) + \
            [("unique", u) for u in t.unique]
        for kind, cols in keys:
            c = ", ".join(cols)
            parts.append(
                f"SELECT '{name}({c})' AS constraint_name, '{kind}' AS kind, "
                f"CAST(count(*) AS BIGINT) AS violations FROM "
                f"(SELECT {c} FROM {name} GROUP BY {c} HAVING count(*) > 1) d")
        for cols, parent, pcols in t.foreign_keys:
            c = ", ".join(cols)
            present = " AND ".join(f"x.{k} IS NOT NULL" for k in cols)
            match = " AND ".join(f"p.{pk} = x.{k}" for k, pk in zip(cols, pcols))
            parts.append(
                f"SELECT '{name}({c}) -> {parent}', 'foreign', CAST(count(*) AS BIGINT) "
                f"FROM {name} x WHERE {present} AND NOT EXISTS "
                f"(SELECT 1 FROM {parent} p WHERE {match})")
    return "\nUNION ALL\n".join(parts)


ORACLE_SQL: dict[str, str] = {
    "calendar_dim": _with(_DAYS) + _CALENDAR,
    "geography_dim": _with(_RAW) + _GEOGRAPHY,
    "customer_dim": _with(_RAW) + _CUSTOMERS,
    "product_dim": _with(_RAW) + _PRODUCTS,
    "order_status_dim": _with(_RAW) + _STATUSES,
    "surrogate_key_large": (
        f"SELECT {LINE_ORDER}, row_number() OVER (ORDER BY {LINE_ORDER}) AS order_line_id "
        "FROM lineitem"),
    "line_measures": _with(_RAW) + _select({
        "order_line_id": "item_rank", "order_date_key": _day_key("bought_on"), "ship_date_key": _day_key("sent_on"),
        "gross_sales_amount": "CAST(worth AS DECIMAL(10,2))", "discount_amount": "CAST(round(rebate, 2) AS DECIMAL(10,2))",
        "net_sales_amount": "paid", "days_to_ship": "CAST(sent_on - bought_on AS SMALLINT)"}, "FROM sold"),
    "current_key_lookup": _with(_RAW) + _select({
        "order_line_id": "item_rank", "product_id": "CAST(l_partkey AS BIGINT)", "product_key": "goods_rank",
        "current_unit_price": "CAST(p_retailprice AS DECIMAL(10,2))"}, "FROM item JOIN goods ON l_partkey = p_partkey"),
    "sales_fact": _with(_RAW) + _FACT,
    "monthly_snapshot": _with(_RAW) + _SNAPSHOT,
    "monthly_snapshot_brand": _with(_RAW) + _snapshot({"brand": "p_brand", "state": "province"}, "BIGINT", "DECIMAL(18,2)"),
    "running_ytd": _with(_RAW) + _select({
        "state": "state", "year_number": "CAST(year(month) AS INTEGER)", "month_number": "CAST(month(month) AS INTEGER)",
        "order_count": "CAST(lines AS BIGINT)", "quantity_sold": "CAST(units AS BIGINT)",
        "net_sales_amount": "CAST(net_money AS DECIMAL(18,2))",
        "ytd_order_count": _so_far("lines", {"state": ""}, "BIGINT"), "ytd_quantity_sold": _so_far("units", {"state": ""}, "BIGINT"),
        "ytd_net_sales": _so_far("net_money", {"state": ""}, "DECIMAL(18,2)")}, f"FROM ({_by_month({'state': 'province'})})"),
    "sales_report": _with(_RAW) + _report() + " ORDER BY order_id, order_line_id LIMIT 100",
    "sales_report_by_files": _with(_RAW) + _report() + " ORDER BY order_id, order_line_id LIMIT 100",
    "ship_date_left_join": _with(_RAW) + _report(),
    "sales_report_narrow_calendar": (_with(_RAW) + _report("1997-01-01", "1998-12-31")
                                     + " ORDER BY order_id, order_line_id LIMIT 100"),
    "geography_key_duplicates": _with(_RAW) + f"""
  SELECT city, state_code, country_code, CAST(count(*) AS BIGINT) AS row_count
  FROM ({_GEOGRAPHY}) GROUP BY city, state_code, country_code HAVING count(*) > 1""",
    "source_integrity": _with(_SOURCE) + _source_integrity_sql(),
    "pk_violations": """
  SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS row_count
  FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "fk_orphans": _with(_SOURCE) + _orphans_sql(),
    "not_null_and_width": _with(*_STAR) + _profile_sql("dim_customer")
    + "\nUNION ALL\n" + _profile_sql("dim_product"),
    "target_not_null": _with(*_STAR) + "\nUNION ALL\n".join(map(_profile_sql, (
        "dim_date", "dim_geography", "dim_order_status", "fact_sales", "fact_sales_monthly_snapshot"))),
    "star_integrity": _with(*_STAR) + _integrity_sql(),
    "full_refresh_report": _with(*_STAR) + "\nUNION ALL\n".join(
        f"SELECT {k} AS load_order, '{name}' AS table_name, count(*) AS rows_written FROM {name}"
        for k, name in enumerate(LOAD_ORDER, 1)),
    "written_star_digest": _with(*_STAR) + _digest_sql(),
    "snapshot_reconcile": _with(_RAW) + f"""
  SELECT CAST(year(bought_on) AS INTEGER) AS year_number, CAST(month(bought_on) AS INTEGER) AS month_number,
         CAST(sum(paid) AS DECIMAL(18,2)) AS fact_net_sales, CAST(sum(paid) AS DECIMAL(18,2)) AS snapshot_net_sales,
         count(*) AS fact_lines, count(*) AS snapshot_lines
  FROM sold GROUP BY ALL""",
}
