"""Registered queries over the test tables.

Each query takes ``(spark, sf_dir)``, reads the TPC-H-style tables through
the adapter in ``starloom.sources.tpch`` and returns a DataFrame. Column
names match the DuckDB statements in ``starloom.oracle``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.checks import (
    column_profile,
    declared_key_violations,
    duplicate_keys,
    orphan_rows,
)
from starloom.operators.keys import dense_key, resolve_key
from starloom.sinks.manifest import current_manifest
from starloom.sinks.ranges import FileRanges, file_ranges
from starloom.sinks.staging import stage, stage_counted, staging_path
from starloom.sinks.writer import write_table
from starloom.operators.running import running_totals
from starloom.plans.calendar import calendar_covering, calendar_dimension
from starloom.plans.dimensions import (
    customer_dimension,
    geography_dimension,
    order_status_dimension,
    product_dimension,
)
from starloom.plans.facts import GEOGRAPHY_NATURAL_KEY, keyed_lines, line_measures, sales_fact
from starloom.plans.refresh import full_refresh, run_digests
from starloom.plans.report import REPORT_ORDER, sales_report
from starloom.plans.snapshot import monthly_aggregate, monthly_snapshot, sales_monthly_snapshot
from starloom.schemas import DIM_CUSTOMER, DIM_PRODUCT, LOAD_ORDER, SOURCE_TABLES, TARGET_TABLES
from starloom.sources.readers import read_table
from starloom.sources.retail import RetailSource
from starloom.sources.tpch import LINE_ORDER, retail_from_tpch

# Fixed values for the test data: ages are computed as of this day.
AS_OF = dt.date(2024, 12, 31)
# Fixed values for the test data: a calendar that covers part of the order dates.
NARROW_YEARS = (dt.date(1997, 1, 1), dt.date(1998, 12, 31))

Query = Callable[[SparkSession, str], DataFrame]


class Model:
    """Source tables and dimensions for one ``sf_dir``, built lazily as plans."""

    def __init__(self, spark: SparkSession, sf_dir: str, *, numbered_lines: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.numbered_lines = numbered_lines
        self.src: RetailSource = retail_from_tpch(spark, sf_dir, numbered_lines=numbered_lines)
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @property
    def dim_date(self) -> DataFrame:
        def build():
            dates = (self.raw("orders").select(F.to_date("o_orderdate").alias("d"))
                     .unionByName(self.raw("lineitem").select(F.to_date("l_shipdate").alias("d"))))
            return calendar_covering(F.col("d"), source=dates)
        return self._get("dim_date", build)

    @property
    def dim_customer(self) -> DataFrame:
        return self._get("dim_customer", lambda: customer_dimension(self.src, AS_OF))

    @property
    def dim_product(self) -> DataFrame:
        return self._get("dim_product", lambda: product_dimension(self.src))

    @property
    def dim_geography(self) -> DataFrame:
        return self._get("dim_geography", lambda: geography_dimension(self.src))

    @property
    def dim_order_status(self) -> DataFrame:
        return self._get("dim_order_status", lambda: order_status_dimension(self.src))

    def loaded(self, name: str) -> DataFrame:
        """A target table as later steps read it: written once, with its rows counted."""
        plan = {"fact_sales": "fact", "fact_sales_monthly_snapshot": "snapshot"}.get(name, name)
        return self._get(f"loaded {name}", lambda: stage_counted(getattr(self, plan), name))

    @property
    def dims(self) -> tuple[DataFrame, ...]:
        """The five dimensions, loaded, in the order of the report's arguments."""
        return tuple(self.loaded(n) for n in ("dim_date", "dim_customer", "dim_product", "dim_geography", "dim_order_status"))

    @property
    def lines(self) -> DataFrame:
        def build():
            lines = keyed_lines(self.src, *(self.loaded(n) for n in ("dim_customer", "dim_product", "dim_geography")))
            # Fact and snapshot both read numbered lines, so they are staged once;
            # a rollup alone reads its lines once.
            return stage(lines, "keyed_lines") if self.numbered_lines else lines
        return self._get("lines", build)

    @property
    def fact(self) -> DataFrame:
        return self._get("fact", lambda: sales_fact(self.lines, self.loaded("dim_order_status")))

    @property
    def snapshot(self) -> DataFrame:
        return self._get("snapshot", lambda: sales_monthly_snapshot(self.lines))


def calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1: calendar over the whole years spanned by order and ship dates."""
    return Model(spark, sf_dir).dim_date


def geography_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Model(spark, sf_dir).dim_geography


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Model(spark, sf_dir).dim_customer


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Model(spark, sf_dir).dim_product


def order_status_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Model(spark, sf_dir).dim_order_status


def surrogate_key_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2: dense 1..N over every lineitem row in full-row order."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    return dense_key(lineitem.select(*LINE_ORDER), list(LINE_ORDER), "order_line_id")


def line_measures_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U10: per-line date keys and measures (order lines joined to their orders)."""
    src = Model(spark, sf_dir).src
    lines = src.sales_order_line.join(
        src.sales_order.select("order_id", "order_date"), "order_id", "inner")
    return line_measures(lines).select(
        "order_line_id", "order_date_key", "ship_date_key", "gross_sales_amount",
        "discount_amount", "net_sales_amount", "days_to_ship")


def current_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U9: resolve product keys on a dimension that also holds expired versions.

    Every discontinued product gets an earlier, expired version (negative key,
    price 10 % higher, is_current = 0); the lookup must ignore those rows.
    """
    m = Model(spark, sf_dir)
    dim = m.loaded("dim_product")
    expired = dim.where(F.col("product_status") == "Discontinued").select(
        *[(-F.col(c)).alias(c) if c == "product_key"
          else F.round(F.col(c) * 1.1, 2).cast("decimal(10,2)").alias(c)
          if c == "current_unit_price"
          else F.lit(dt.date(2021, 12, 31)).alias(c) if c == "effective_to"
          else F.lit(0).cast("smallint").alias(c) if c == "is_current"
          else F.col(c)
          for c in dim.columns])
    versioned = dim.unionByName(expired)
    lines = m.src.sales_order_line.select("order_line_id", "product_id")
    return resolve_key(lines, versioned, [("product_id", "product_id")], "product_key",
                       keep=["current_unit_price"])


def sales_fact_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Model(spark, sf_dir).fact


def monthly_snapshot_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Model(spark, sf_dir, numbered_lines=False).snapshot


def _lines_with_brand_state(m: Model) -> DataFrame:
    lines = resolve_key(m.lines, m.loaded("dim_product"), [("product_key", "product_key")], "brand")
    return resolve_key(lines, m.loaded("dim_geography"), [("geography_key", "geography_key")], "state",
                       small=True)


def monthly_snapshot_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U12 at a coarse grain: brand x state x month, with widened measure types."""
    m = Model(spark, sf_dir, numbered_lines=False)
    return monthly_snapshot(_lines_with_brand_state(m), ["brand", "state"],
                            key_name="snapshot_key", count_type=T.LongType(),
                            money_type=T.DecimalType(18, 2))


def running_ytd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U13: monthly line counts, quantity and net per state with year-to-date sums."""
    m = Model(spark, sf_dir, numbered_lines=False)
    lines = resolve_key(m.lines, m.loaded("dim_geography"), [("geography_key", "geography_key")],
                        "state", small=True)
    monthly = monthly_aggregate(lines, ["state"])
    ytd = running_totals(monthly, ["state", "year_number"], "month_number", {
        "ytd_order_count": "order_count",
        "ytd_quantity_sold": "quantity_sold",
        "ytd_net_sales": "net_sales_amount",
    })
    return ytd.select(
        "state", F.col("year_number").cast("int"), F.col("month_number").cast("int"),
        F.col("order_count").cast("long"), F.col("quantity_sold").cast("long"),
        F.col("net_sales_amount").cast("decimal(18,2)"),
        F.col("ytd_order_count").cast("long"), F.col("ytd_quantity_sold").cast("long"),
        F.col("ytd_net_sales").cast("decimal(18,2)"))


def sales_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U14: the first 100 report lines by order and line id (flagship)."""
    m = Model(spark, sf_dir)
    return sales_report(m.fact, *m.dims, n=100)


def sales_report_by_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: the same lines from the written fact, of which only the first files by order and line id are opened."""
    m = Model(spark, sf_dir)
    path = staging_path(spark, "fact_sales")
    write_table(m.fact, TARGET_TABLES["fact_sales"], path)
    fact = spark.read.parquet(path)
    ranges = stage(file_ranges(fact, REPORT_ORDER, path.rsplit("/", 1)[-1]), "fact-ranges")
    files = FileRanges(ranges, REPORT_ORDER, lambda names: spark.read.parquet(*[f"{path}/{n}" for n in names]))
    return sales_report(fact, *m.dims, n=100, files=files)


def ship_date_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10: the whole report, every line; unshipped lines keep a NULL ship date."""
    m = Model(spark, sf_dir)
    return sales_report(m.fact, *m.dims, n=None, ordered=False)


def sales_report_narrow_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U14 over a fixed calendar of some middle years: the inner join drops all other lines."""
    m = Model(spark, sf_dir)
    years = calendar_dimension(spark, *NARROW_YEARS)
    return sales_report(m.fact, years, *m.dims[1:], n=100)


def geography_key_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9 guard: (city, state_code, country_code) values that several geography rows share.

    The bridge looks geography up by these columns, which are no declared key.
    """
    dim = Model(spark, sf_dir).dim_geography
    return duplicate_keys(dim, [c for _, c in GEOGRAPHY_NATURAL_KEY]).select(
        "city", "state_code", "country_code", F.col("row_count").cast("long"))


def source_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + I2 on the source: every declared primary, unique and foreign key of the 12 tables."""
    src = Model(spark, sf_dir).src.tables()
    # The adapter derives these tables; written once, each scan of a check reads columns only.
    tables = {name: stage(df, name) for name, df in src.items()}
    return declared_key_violations(tables, SOURCE_TABLES)


def target_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 + I4: NULL and width profile of the calendar, geography, status, fact and snapshot tables."""
    m = Model(spark, sf_dir)
    out = None
    for name, df in (("dim_date", m.dim_date), ("dim_geography", m.dim_geography),
                     ("dim_order_status", m.dim_order_status), ("fact_sales", m.fact),
                     ("fact_sales_monthly_snapshot", m.snapshot)):
        rows = column_profile(df, TARGET_TABLES[name])
        out = rows if out is None else out.unionByName(rows)
    return out


def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1: (l_orderkey, l_linenumber) values that occur more than once."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    return duplicate_keys(lineitem, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", F.col("row_count").cast("long"))


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2: foreign keys of the source model without a parent row.

    Checks every source foreign key, plus order lines against the fulfilled
    orders only (status 'F'), which reports the lines of open and pending orders.
    """
    src = Model(spark, sf_dir).src
    t = src.tables()
    # Numbered once and narrow for the three checks on it.
    t["sales_order_line"] = stage(t["sales_order_line"].select("order_line_id", "order_id", "product_id"), "line-keys")
    checks = [
        ("sales_order_line.order_id", "sales_order_line", "order_line_id", "order_id",
         t["sales_order"], "order_id"),
        ("sales_order_line.product_id", "sales_order_line", "order_line_id", "product_id",
         t["product"], "product_id"),
        ("sales_order.customer_id", "sales_order", "order_id", "customer_id",
         t["customer"], "customer_id"),
        ("customer.address_id", "customer", "customer_id", "address_id",
         t["address"], "address_id"),
        ("address.city_id", "address", "address_id", "city_id", t["city"], "city_id"),
        ("city.state_id", "city", "city_id", "state_id", t["state"], "state_id"),
        ("state.country_id", "state", "state_id", "country_id", t["country"], "country_id"),
        ("product.category_id", "product", "product_id", "category_id",
         t["product_category"], "category_id"),
        ("product.status_id", "product", "product_id", "status_id", t["product_status"],
         "status_id"),
        ("product.uom_id", "product", "product_id", "uom_id", t["unit_of_measure"], "uom_id"),
        ("product.brand_id", "product", "product_id", "brand_id", t["brand"], "brand_id"),
        ("brand.country_id", "brand", "brand_id", "country_id", t["country"], "country_id"),
        ("sales_order_line.order_id->fulfilled", "sales_order_line", "order_line_id",
         "order_id", t["sales_order"].where(F.col("order_status") == "F"), "order_id"),
    ]
    out = None
    for name, child, child_pk, fk, parent, pk in checks:
        rows = orphan_rows(t[child], parent, [fk], [pk], keep=[child_pk]).select(
            F.lit(name).alias("constraint_name"),
            F.col(child_pk).cast("long").alias("child_key"),
            F.col(fk).cast("long").alias("fk_value"))
        out = rows if out is None else out.unionByName(rows)
    return out


def not_null_and_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 + I4: per-column NULL and width profile of the customer and product dimensions."""
    m = Model(spark, sf_dir)
    return column_profile(m.dim_customer, DIM_CUSTOMER).unionByName(
        column_profile(m.dim_product, DIM_PRODUCT))


def snapshot_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly net sales and line counts from the fact and from the snapshot, side by side."""
    m = Model(spark, sf_dir)
    fact_month = (m.fact.groupBy((F.col("order_date_key") / 100).cast("int").alias("ym"))
                  .agg(F.sum("net_sales_amount").alias("fact_net_sales"),
                       F.count(F.lit(1)).alias("fact_lines")))
    snap_month = (m.snapshot.groupBy((F.col("snapshot_date_key") / 100).cast("int")
                                     .alias("ym"))
                  .agg(F.sum("net_sales_amount").alias("snapshot_net_sales"),
                       F.sum("order_count").alias("snapshot_lines")))
    return fact_month.join(snap_month, "ym", "full").select(
        (F.col("ym") / 100).cast("int").alias("year_number"),
        (F.col("ym") % 100).cast("int").alias("month_number"),
        F.col("fact_net_sales").cast("decimal(18,2)"),
        F.col("snapshot_net_sales").cast("decimal(18,2)"),
        F.col("fact_lines").cast("long"),
        F.col("snapshot_lines").cast("long"))


def star_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + I2 on the built star: every declared primary, unique and foreign key."""
    m = Model(spark, sf_dir)
    return declared_key_violations({name: m.loaded(name) for name in LOAD_ORDER}, TARGET_TABLES)


def full_refresh_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U15: full refresh of all seven tables into a new run folder; rows written per table.

    The run goes to a fresh folder under ``spark.checkpoint.dir``.
    """
    m = Model(spark, sf_dir)
    report = full_refresh(spark, m.src, staging_path(spark, "refresh"), as_of=AS_OF)
    return report.select("load_order", "table_name", "rows_written")


def written_star_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + S2: rows and digests of all seven tables as read back from a published run.

    ``as_written``: whether they equal what the writes themselves saw.
    """
    target = staging_path(spark, "refresh")
    full_refresh(spark, Model(spark, sf_dir).src, target, as_of=AS_OF)
    found = run_digests(spark, target, current_manifest(spark, target))
    return found.select("table_name", "row_count", *[F.col(c).cast("string").alias(c) for c in ("keys_digest", "rows_digest")],
                        "as_written")


QUERIES: dict[str, Query] = {
    "calendar_dim": calendar_dim,
    "geography_dim": geography_dim,
    "customer_dim": customer_dim,
    "product_dim": product_dim,
    "order_status_dim": order_status_dim,
    "surrogate_key_large": surrogate_key_large,
    "line_measures": line_measures_q,
    "current_key_lookup": current_key_lookup,
    "sales_fact": sales_fact_q,
    "monthly_snapshot": monthly_snapshot_q,
    "monthly_snapshot_brand": monthly_snapshot_brand,
    "running_ytd": running_ytd,
    "sales_report": sales_report_q,
    "sales_report_by_files": sales_report_by_files,
    "ship_date_left_join": ship_date_left_join,
    "sales_report_narrow_calendar": sales_report_narrow_calendar,
    "geography_key_duplicates": geography_key_duplicates,
    "source_integrity": source_integrity,
    "target_not_null": target_not_null,
    "pk_violations": pk_violations,
    "fk_orphans": fk_orphans,
    "not_null_and_width": not_null_and_width,
    "snapshot_reconcile": snapshot_reconcile,
    "full_refresh_report": full_refresh_report,
    "written_star_digest": written_star_digest,
    "star_integrity": star_integrity,
}

__all__ = ["QUERIES", "Model", "AS_OF"]
