"""Customer, product, geography and order-status dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import calendar_year_boundaries
from starloom.functions.text import join_names
from starloom.operators.flatten import Lookup, flatten
from starloom.operators.keys import dense_key
from starloom.operators.versioning import initial_version
from starloom.sinks.staging import stage
from starloom.schemas import (
    DIM_CUSTOMER,
    DIM_GEOGRAPHY,
    DIM_ORDER_STATUS,
    DIM_PRODUCT,
    conform,
)
from starloom.sources.retail import RetailSource

# The first version of every dimension row starts on this date.
FIRST_VERSION_FROM = dt.date(2022, 1, 1)
# Age bands by boundary-counted age, upper limits exclusive; older is 55+.
AGE_BANDS = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"))
OLDEST_BAND = "55+"


def age_band(date_of_birth: F.Column, as_of: dt.date | F.Column) -> F.Column:
    """Age band from the calendar-year difference between birth and ``as_of``.

    A NULL birth date compares false everywhere and lands in the oldest band;
    ages under 18 land in the youngest.
    """
    ref = F.lit(as_of) if isinstance(as_of, (dt.date, str)) else as_of
    age = calendar_year_boundaries(date_of_birth, ref)
    band = F.when(age < AGE_BANDS[0][0], AGE_BANDS[0][1])
    for limit, label in AGE_BANDS[1:]:
        band = band.when(age < limit, label)
    return band.otherwise(OLDEST_BAND)


def _address_hops(src: RetailSource) -> list[Lookup]:
    """address -> city -> state -> country, starting from ``_city_id``."""
    return [
        Lookup(src.city, "_city_id", "city_id", {"city_name": "city", "state_id": "_state_id"},
               small=True),
        Lookup(src.state, "_state_id", "state_id",
               {"state_name": "state", "state_code": "state_code", "country_id": "_country_id"},
               small=True),
        Lookup(src.country, "_country_id", "country_id",
               {"country_name": "country", "country_code": "country_code"}, small=True),
    ]


def customer_dimension(src: RetailSource, as_of: dt.date, *,
                       effective_from: dt.date = FIRST_VERSION_FROM) -> DataFrame:
    """``dim_customer``: customers flattened through address, city, state, country.

    ``customer_key`` numbers customers 1..N by ``customer_id``. The customer
    table is counted only to size the key's sketch.
    """
    base = src.customer.select("customer_id", "first_name", "last_name", "email", "phone",
                               "date_of_birth", "address_id")
    flat = flatten(base, [
        Lookup(src.address, "address_id", "address_id",
               {"postal_code": "postal_code", "city_id": "_city_id"}),
        *_address_hops(src),
    ])
    shaped = flat.select(
        "customer_id", "first_name", "last_name",
        join_names("first_name", "last_name").alias("full_name"),
        "email", "phone", "date_of_birth",
        age_band(F.col("date_of_birth"), as_of).alias("age_band"),
        "city", "state", "state_code", "country", "country_code", "postal_code")
    keyed = dense_key(shaped, ["customer_id"], "customer_key", size_of=src.customer)
    return conform(initial_version(keyed, effective_from), DIM_CUSTOMER)


def product_dimension(src: RetailSource, *, effective_from: dt.date = FIRST_VERSION_FROM) -> DataFrame:
    """``dim_product``: products flattened through brand (and its country),
    category, status and unit of measure; ``product_key`` by ``product_id``."""
    base = src.product.select("product_id", "sku", "product_name", "brand_id", "category_id",
                              "status_id", "uom_id", "unit_price", "weight_kg",
                              "warranty_months", "introduced_date")
    flat = flatten(base, [
        Lookup(src.brand, "brand_id", "brand_id",
               {"brand_name": "brand", "country_id": "_brand_country_id"}, small=True),
        Lookup(src.country, "_brand_country_id", "country_id",
               {"country_name": "brand_country"}, small=True),
        Lookup(src.product_category, "category_id", "category_id",
               {"category_name": "category"}, small=True),
        Lookup(src.product_status, "status_id", "status_id", {"status_name": "product_status"},
               small=True),
        Lookup(src.unit_of_measure, "uom_id", "uom_id", {"uom_code": "unit_of_measure"},
               small=True),
    ])
    shaped = flat.select(
        "product_id", "sku", "product_name", "brand", "brand_country", "category",
        "product_status", "unit_of_measure",
        F.col("unit_price").alias("current_unit_price"),
        "weight_kg", "warranty_months", "introduced_date")
    keyed = dense_key(shaped, ["product_id"], "product_key", size_of=src.product)
    return conform(initial_version(keyed, effective_from), DIM_PRODUCT)


def geography_dimension(src: RetailSource) -> DataFrame:
    """``dim_geography``: one row per city, keyed by country, state, city name.

    ``city_id`` breaks ties between equally named cities of one state so the
    key is deterministic.
    """
    base = src.city.select("city_id", F.col("city_name").alias("city"),
                           F.col("state_id").alias("_state_id"))
    flat = flatten(base, _address_hops(src)[1:])
    keyed = dense_key(flat, ["country", "state", "city", "city_id"], "geography_key", size_of=src.city)
    return conform(keyed, DIM_GEOGRAPHY)


def order_status_dimension(src: RetailSource) -> DataFrame:
    """``dim_order_status``: the distinct order statuses, keyed alphabetically.

    The distinct runs as a partial aggregate per task, so only a handful of
    values cross the shuffle whatever the order count. They are staged, so the
    orders are scanned once for all steps of the key.
    """
    statuses = stage(src.sales_order.select("order_status").distinct(), "order-statuses")
    return conform(dense_key(statuses, ["order_status"], "order_status_key"), DIM_ORDER_STATUS)
