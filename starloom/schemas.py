"""Table definitions of the source (OLTP) model and the target star schema.

Each table is a ``StructType`` plus constraint metadata (primary and unique
keys, foreign keys, declared character widths). Spark does not enforce keys,
so the metadata feeds the integrity checks in ``starloom.operators.checks``.

Names, types, widths and keys of the tables are fixed values of the model.
Identifier and surrogate-key columns are ``LongType``: at the scale this
library targets (hundreds of billions of order lines) 32-bit keys overflow.
Every other column keeps the width declared by the model.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.bounds import keep_rows

KEY = T.LongType()
SMALL = T.ShortType()
INT = T.IntegerType()
STR = T.StringType()
DATE = T.DateType()
MONEY = T.DecimalType(10, 2)
MONEY_SUM = T.DecimalType(12, 2)
PCT = T.DecimalType(5, 2)
WEIGHT = T.DecimalType(8, 3)


@dataclass(frozen=True)
class Table:
    """Schema plus declared constraints of one table."""

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    # (columns, parent table, parent columns)
    foreign_keys: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    # declared VARCHAR/CHAR widths
    widths: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def _struct(*cols: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


# ---------------------------------------------------------------------------
# Source model (normalised retail schema)
# ---------------------------------------------------------------------------

COUNTRY = Table(
    "country",
    _struct(("country_id", KEY, False), ("country_name", STR, False),
            ("country_code", STR, False)),
    primary_key=("country_id",), unique=(("country_code",),),
    widths={"country_name": 100, "country_code": 2},
)
STATE = Table(
    "state",
    _struct(("state_id", KEY, False), ("state_name", STR, False),
            ("state_code", STR, False), ("country_id", KEY, False)),
    primary_key=("state_id",),
    foreign_keys=((("country_id",), "country", ("country_id",)),),
    widths={"state_name": 100, "state_code": 2},
)
CITY = Table(
    "city",
    _struct(("city_id", KEY, False), ("city_name", STR, False), ("state_id", KEY, False)),
    primary_key=("city_id",),
    foreign_keys=((("state_id",), "state", ("state_id",)),),
    widths={"city_name": 100},
)
ADDRESS = Table(
    "address",
    _struct(("address_id", KEY, False), ("street_line1", STR, False),
            ("street_line2", STR, True), ("postal_code", STR, False),
            ("city_id", KEY, False)),
    primary_key=("address_id",),
    foreign_keys=((("city_id",), "city", ("city_id",)),),
    widths={"street_line1": 200, "street_line2": 200, "postal_code": 20},
)
CUSTOMER = Table(
    "customer",
    _struct(("customer_id", KEY, False), ("first_name", STR, False),
            ("last_name", STR, False), ("email", STR, False), ("phone", STR, True),
            ("date_of_birth", DATE, True), ("address_id", KEY, False),
            ("created_at", T.TimestampNTZType(), False)),
    primary_key=("customer_id",), unique=(("email",),),
    foreign_keys=((("address_id",), "address", ("address_id",)),),
    widths={"first_name": 100, "last_name": 100, "email": 255, "phone": 30},
)
PRODUCT_CATEGORY = Table(
    "product_category",
    _struct(("category_id", KEY, False), ("category_name", STR, False)),
    primary_key=("category_id",), unique=(("category_name",),),
    widths={"category_name": 100},
)
BRAND = Table(
    "brand",
    _struct(("brand_id", KEY, False), ("brand_name", STR, False), ("country_id", KEY, False)),
    primary_key=("brand_id",), unique=(("brand_name",),),
    foreign_keys=((("country_id",), "country", ("country_id",)),),
    widths={"brand_name": 100},
)
UNIT_OF_MEASURE = Table(
    "unit_of_measure",
    _struct(("uom_id", KEY, False), ("uom_code", STR, False), ("uom_desc", STR, False)),
    primary_key=("uom_id",), unique=(("uom_code",),),
    widths={"uom_code": 20, "uom_desc": 100},
)
PRODUCT_STATUS = Table(
    "product_status",
    _struct(("status_id", KEY, False), ("status_name", STR, False)),
    primary_key=("status_id",), unique=(("status_name",),),
    widths={"status_name": 50},
)
PRODUCT = Table(
    "product",
    _struct(("product_id", KEY, False), ("sku", STR, False), ("product_name", STR, False),
            ("brand_id", KEY, False), ("category_id", KEY, False), ("status_id", KEY, False),
            ("unit_price", MONEY, False), ("uom_id", KEY, False), ("weight_kg", WEIGHT, True),
            ("warranty_months", SMALL, True), ("introduced_date", DATE, True)),
    primary_key=("product_id",), unique=(("sku",),),
    foreign_keys=(
        (("brand_id",), "brand", ("brand_id",)),
        (("category_id",), "product_category", ("category_id",)),
        (("status_id",), "product_status", ("status_id",)),
        (("uom_id",), "unit_of_measure", ("uom_id",)),
    ),
    widths={"sku": 50, "product_name": 200},
)
SALES_ORDER = Table(
    "sales_order",
    _struct(("order_id", KEY, False), ("customer_id", KEY, False), ("order_date", DATE, False),
            ("ship_date", DATE, True), ("order_status", STR, False)),
    primary_key=("order_id",),
    foreign_keys=((("customer_id",), "customer", ("customer_id",)),),
    widths={"order_status": 20},
)
SALES_ORDER_LINE = Table(
    "sales_order_line",
    _struct(("order_line_id", KEY, False), ("order_id", KEY, False), ("product_id", KEY, False),
            ("quantity", SMALL, False), ("unit_price", MONEY, False), ("discount_pct", PCT, False),
            ("line_total", MONEY, False)),
    primary_key=("order_line_id",),
    foreign_keys=(
        (("order_id",), "sales_order", ("order_id",)),
        (("product_id",), "product", ("product_id",)),
    ),
)

# Names, order, types, widths and keys of all tables here are fixed by the data model.
SOURCE_TABLES = {t.name: t for t in (
    COUNTRY, STATE, CITY, ADDRESS, CUSTOMER, PRODUCT_CATEGORY, BRAND, UNIT_OF_MEASURE,
    PRODUCT_STATUS, PRODUCT, SALES_ORDER, SALES_ORDER_LINE)}

# ---------------------------------------------------------------------------
# Target star schema
# ---------------------------------------------------------------------------

DIM_DATE = Table(
    "dim_date",
    _struct(("date_key", INT, False), ("full_date", DATE, False),
            ("day_of_week", SMALL, False), ("day_name", STR, False),
            ("day_of_month", SMALL, False), ("day_of_year", SMALL, False),
            ("week_of_year", SMALL, False), ("month_number", SMALL, False),
            ("month_name", STR, False), ("month_short", STR, False),
            ("quarter_number", SMALL, False), ("quarter_name", STR, False),
            ("year_number", SMALL, False), ("is_weekend", SMALL, False),
            ("is_holiday", SMALL, False), ("fiscal_year", SMALL, False),
            ("fiscal_quarter", SMALL, False), ("fiscal_month", SMALL, False)),
    primary_key=("date_key",), unique=(("full_date",),),
    widths={"day_name": 10, "month_name": 10, "month_short": 3, "quarter_name": 2},
)
_SCD = (("effective_from", DATE, False), ("effective_to", DATE, True), ("is_current", SMALL, False))
DIM_CUSTOMER = Table(
    "dim_customer",
    _struct(("customer_key", KEY, False), ("customer_id", KEY, False),
            ("first_name", STR, False), ("last_name", STR, False), ("full_name", STR, False),
            ("email", STR, False), ("phone", STR, True), ("date_of_birth", DATE, True),
            ("age_band", STR, True), ("city", STR, False), ("state", STR, False),
            ("state_code", STR, False), ("country", STR, False), ("country_code", STR, False),
            ("postal_code", STR, False), *_SCD),
    primary_key=("customer_key",),
    widths={"first_name": 100, "last_name": 100, "full_name": 200, "email": 255,
            "phone": 30, "age_band": 20, "city": 100, "state": 100, "state_code": 2,
            "country": 100, "country_code": 2, "postal_code": 20},
)
DIM_PRODUCT = Table(
    "dim_product",
    _struct(("product_key", KEY, False), ("product_id", KEY, False), ("sku", STR, False),
            ("product_name", STR, False), ("brand", STR, False), ("brand_country", STR, False),
            ("category", STR, False), ("product_status", STR, False),
            ("unit_of_measure", STR, False), ("current_unit_price", MONEY, False),
            ("weight_kg", WEIGHT, True), ("warranty_months", SMALL, True),
            ("introduced_date", DATE, True), *_SCD),
    primary_key=("product_key",),
    widths={"sku": 50, "product_name": 200, "brand": 100, "brand_country": 100,
            "category": 100, "product_status": 50, "unit_of_measure": 20},
)
DIM_GEOGRAPHY = Table(
    "dim_geography",
    _struct(("geography_key", KEY, False), ("city", STR, False), ("state", STR, False),
            ("state_code", STR, False), ("country", STR, False), ("country_code", STR, False)),
    primary_key=("geography_key",),
    widths={"city": 100, "state": 100, "state_code": 2, "country": 100, "country_code": 2},
)
DIM_ORDER_STATUS = Table(
    "dim_order_status",
    _struct(("order_status_key", KEY, False), ("order_status", STR, False)),
    primary_key=("order_status_key",), unique=(("order_status",),),
    widths={"order_status": 20},
)
FACT_SALES = Table(
    "fact_sales",
    _struct(("sales_key", KEY, False), ("order_line_id", KEY, False), ("order_id", KEY, False),
            ("order_date_key", INT, False), ("ship_date_key", INT, True),
            ("customer_key", KEY, False), ("product_key", KEY, False),
            ("geography_key", KEY, False), ("order_status_key", KEY, False),
            ("quantity", SMALL, False), ("unit_price", MONEY, False),
            ("discount_pct", PCT, False), ("discount_amount", MONEY, False),
            ("gross_sales_amount", MONEY, False), ("net_sales_amount", MONEY, False),
            ("cost_amount", MONEY, True), ("gross_margin_amount", MONEY, True),
            ("days_to_ship", SMALL, True)),
    primary_key=("sales_key",),
    foreign_keys=(
        (("order_date_key",), "dim_date", ("date_key",)),
        (("ship_date_key",), "dim_date", ("date_key",)),
        (("customer_key",), "dim_customer", ("customer_key",)),
        (("product_key",), "dim_product", ("product_key",)),
        (("geography_key",), "dim_geography", ("geography_key",)),
        (("order_status_key",), "dim_order_status", ("order_status_key",)),
    ),
)
FACT_SALES_MONTHLY_SNAPSHOT = Table(
    "fact_sales_monthly_snapshot",
    _struct(("snapshot_key", KEY, False), ("snapshot_date_key", INT, False),
            ("customer_key", KEY, False), ("product_key", KEY, False),
            ("geography_key", KEY, False), ("order_count", INT, False),
            ("quantity_sold", INT, False), ("gross_sales_amount", MONEY_SUM, False),
            ("discount_amount", MONEY_SUM, False), ("net_sales_amount", MONEY_SUM, False),
            ("gross_margin_amount", MONEY_SUM, True), ("ytd_order_count", INT, False),
            ("ytd_quantity_sold", INT, False), ("ytd_net_sales", MONEY_SUM, False)),
    primary_key=("snapshot_key",),
    foreign_keys=(
        (("snapshot_date_key",), "dim_date", ("date_key",)),
        (("customer_key",), "dim_customer", ("customer_key",)),
        (("product_key",), "dim_product", ("product_key",)),
        (("geography_key",), "dim_geography", ("geography_key",)),
    ),
)

TARGET_TABLES = {t.name: t for t in (
    DIM_DATE, DIM_CUSTOMER, DIM_PRODUCT, DIM_GEOGRAPHY, DIM_ORDER_STATUS, FACT_SALES,
    FACT_SALES_MONTHLY_SNAPSHOT)}

# Load order of a full refresh: dimensions, then the line fact, then the snapshot.
LOAD_ORDER = ("dim_date", "dim_customer", "dim_product", "dim_geography",
              "dim_order_status", "fact_sales", "fact_sales_monthly_snapshot")


def typed_null(data_type: T.DataType) -> Column:
    """A NULL literal of a concrete type (an untyped NULL becomes ``void``)."""
    return F.lit(None).cast(data_type)


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Select the table's columns by name, in declared order, cast to declared types.

    Writers such as ``insertInto`` are positional, so every frame goes through
    here before it is written. Casts run under the session's ANSI setting, so a
    value that does not fit raises instead of being truncated.
    """
    missing = [c for c in table.columns if c not in df.columns]
    if missing:
        raise ValueError(f"{table.name}: missing columns {missing}")
    out = df.select([F.col(f.name).cast(f.dataType).alias(f.name)
                     for f in table.schema.fields])
    return keep_rows(df, out)   # a projection keeps the row count


def create_table_sql(table: Table, qualified_name: str, location: str | None = None,
                     fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> str:
    """``CREATE TABLE`` statement for ``table`` (Spark SQL, external when ``location``).

    Character columns are declared ``STRING``: a declared width is checked by
    ``operators.checks.column_profile`` and reported, not enforced on write
    (an over-wide value must not fail the load). NOT NULL is kept in the DDL.
    """
    cols = ",\n  ".join(
        f"{f.name} {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}"
        for f in table.schema.fields)
    parts = f"\nPARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    where = f"\nLOCATION '{location}'" if location else ""
    return f"CREATE TABLE {qualified_name} (\n  {cols}\n) USING {fmt}{parts}{where}"


def create_view_sql(table: Table, qualified_name: str, folder: str, manifests: str) -> str:
    """``CREATE VIEW`` statement: the table's rows of the run that the newest manifest names."""
    cols = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString().upper()}) AS {f.name}" for f in table.schema.fields)
    current = f"SELECT max_by(run_id, version) FROM json.`{manifests}`"
    return f"CREATE OR REPLACE VIEW {qualified_name} AS SELECT {cols} FROM parquet.`{folder}` WHERE run_id = ({current})"
