"""Adapter from the TPC-H-style test tables to the retail source model.

Mapping (every table is derived from the given tables, so its size follows
theirs):

* country  <- region: id = r_regionkey, name = r_name,
  code = first two letters of r_name, upper case.
* state    <- nation: id = n_nationkey, name = n_name,
  code = n_nationkey as two digits, country = n_regionkey.
* city     <- one city per (nation, market segment) that has customers;
  name = c_mktsegment, so equal city names occur in different states.
* address  <- customer: id = c_custkey, postal code = c_custkey mod 100000
  as five digits, city of the customer's nation and segment.
* customer <- customer: first/last name = the parts of c_name around '#',
  e-mail from c_name, no phone, birth date from a rule on c_custkey.
* brand    <- distinct p_brand: id = number after '#', country = id mod 5.
* product_category <- distinct p_type.
* product_status   <- banded p_size.
* unit_of_measure  <- banded p_size (each / box).
* product  <- part: unit price = p_retailprice, weight = p_size.
* sales_order      <- orders (order date = o_orderdate).
* sales_order_line <- lineitem: order_line_id = dense rank over all lineitem
  columns (``(l_orderkey, l_linenumber)`` is not unique in the test data),
  unit price = l_extendedprice, discount in percent = l_discount * 100,
  ship date on the line, NULL while the line is open (l_linestatus 'O').
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.money import discount_amount, gross_amount
from starloom.operators.keys import dense_key
from starloom.sources.readers import read_table
from starloom.sinks.staging import stage
from starloom.sources.retail import RetailSource

TPCH_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")

# Fixed values of the test-data mapping.
# Product status by part size: size <= 40 Active, <= 45 Seasonal, else Discontinued.
STATUS_BANDS = ((1, "Active", 40), (2, "Seasonal", 45), (3, "Discontinued", None))
# Unit of measure by part size: size <= 25 is sold each (1, EA, Each), larger by the box (2, BX, Box).
UNIT_BANDS = ((1, "EA", "Each", 25), (2, "BX", "Box", None))
EMAIL_DOMAIN = "@example.com"
# Lineitem columns that together identify a line (whole rows are distinct).
LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
              "l_shipdate")


def birth_date(custkey: F.Column) -> F.Column:
    """Synthetic birth date: NULL for every tenth customer, else spread over 1950-2009."""
    return F.when(
        custkey % 10 != 0,
        F.make_date((1950 + custkey % 60).cast("int"), (1 + custkey % 12).cast("int"),
                    (1 + custkey % 28).cast("int")))


def retail_from_tpch(spark: SparkSession, sf_dir: str, *, numbered_lines: bool = True) -> RetailSource:
    t = {n: read_table(spark, sf_dir, n) for n in TPCH_TABLES}
    return retail_from_frames(spark, **t, numbered_lines=numbered_lines)


def retail_from_frames(spark: SparkSession, region: DataFrame, nation: DataFrame,
                       customer: DataFrame, part: DataFrame, orders: DataFrame,
                       lineitem: DataFrame, *, numbered_lines: bool = True) -> RetailSource:
    """The source model; ``numbered_lines=False`` where only the lines' number is counted."""
    country = region.select(
        F.col("r_regionkey").cast("long").alias("country_id"),
        F.col("r_name").alias("country_name"),
        F.upper(F.substring("r_name", 1, 2)).alias("country_code"))
    state = nation.select(
        F.col("n_nationkey").cast("long").alias("state_id"),
        F.col("n_name").alias("state_name"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("state_code"),
        F.col("n_regionkey").cast("long").alias("country_id"))

    # Cities: one per nation x market segment present.
    city_names = customer.select(F.col("c_nationkey").cast("long").alias("state_id"),
                                 F.col("c_mktsegment").alias("city_name")).distinct()
    city = dense_key(stage(city_names, "cities"), ["state_id", "city_name"], "city_id").select(
        "city_id", "city_name", "state_id")

    address = customer.join(
        city, (F.col("c_nationkey") == F.col("state_id"))
        & (F.col("c_mktsegment") == F.col("city_name"))).select(
        F.col("c_custkey").cast("long").alias("address_id"),
        F.concat(F.lit("Street "), F.col("c_custkey").cast("string")).alias("street_line1"),
        F.lit(None).cast("string").alias("street_line2"),
        F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("postal_code"),
        "city_id")

    cust = customer.select(
        F.col("c_custkey").cast("long").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))),
                 F.lit(EMAIL_DOMAIN)).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        birth_date(F.col("c_custkey")).alias("date_of_birth"),
        F.col("c_custkey").cast("long").alias("address_id"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"))

    category = dense_key(stage(part.select(F.col("p_type").alias("category_name")).distinct(), "categories"),
                         ["category_name"], "category_id").select("category_id", "category_name")
    brand = part.select("p_brand").distinct().select(
        F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("long").alias("brand_id"),
        F.col("p_brand").alias("brand_name"),
        (F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("long") % 5).alias("country_id"))
    uom = spark.createDataFrame([(i, c, d) for i, c, d, _ in UNIT_BANDS],
                                "uom_id long, uom_code string, uom_desc string")
    uom_id = F.when(F.col("p_size") <= UNIT_BANDS[0][3], F.lit(UNIT_BANDS[0][0])).otherwise(
        F.lit(UNIT_BANDS[1][0]))
    status = spark.createDataFrame([(i, n) for i, n, _ in STATUS_BANDS],
                                   "status_id long, status_name string")
    status_id = F.lit(STATUS_BANDS[-1][0])
    for sid, _, upper in reversed(STATUS_BANDS[:-1]):
        status_id = F.when(F.col("p_size") <= upper, F.lit(sid)).otherwise(status_id)

    product = part.join(category, F.col("p_type") == F.col("category_name")).select(
        F.col("p_partkey").cast("long").alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("long").alias("brand_id"),
        "category_id",
        status_id.cast("long").alias("status_id"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        uom_id.cast("long").alias("uom_id"),
        F.col("p_size").cast("decimal(8,3)").alias("weight_kg"),
        F.lit(None).cast("smallint").alias("warranty_months"),
        F.lit(None).cast("date").alias("introduced_date"))

    sales_order = orders.select(
        F.col("o_orderkey").cast("long").alias("order_id"),
        F.col("o_custkey").cast("long").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"))

    return RetailSource(country=country, state=state, city=city, address=address,
                        customer=cust, product_category=category, brand=brand,
                        unit_of_measure=uom, product_status=status, product=product,
                        sales_order=sales_order,
                        # Built on first use: the line key counts and samples the lines.
                        sales_order_line=lambda: order_lines_from_lineitem(lineitem, numbered=numbered_lines))


def order_lines_from_lineitem(lineitem: DataFrame, *, numbered: bool = True) -> DataFrame:
    """Order lines with a dense ``order_line_id`` over the full lineitem order.

    Rollups only count lines; with ``numbered=False`` the id is made of the
    order and line number, and nothing is sorted.
    """
    rows = lineitem.select(*LINE_ORDER)
    if numbered:
        keyed = dense_key(rows, list(LINE_ORDER), "order_line_id")
    else:
        keyed = rows.withColumn("order_line_id", F.col("l_orderkey").cast("long") * 8 + F.col("l_linenumber"))
    unit_price = F.col("l_extendedprice").cast("decimal(10,2)")
    quantity = F.col("l_quantity").cast("smallint")
    pct = (F.col("l_discount") * 100).cast("decimal(5,2)")
    line_total = F.round(gross_amount(unit_price, quantity)
                         - discount_amount(unit_price, quantity, pct), 2)
    return keyed.select(
        "order_line_id",
        F.col("l_orderkey").cast("long").alias("order_id"),
        F.col("l_partkey").cast("long").alias("product_id"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        pct.alias("discount_pct"),
        line_total.cast("decimal(10,2)").alias("line_total"),
        F.when(F.col("l_linestatus") == "F", F.to_date("l_shipdate")).alias("ship_date"))
