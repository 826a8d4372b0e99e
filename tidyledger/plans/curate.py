"""Builders of the curated star schema. Bad keys stay visible; unparseable values become NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyledger.functions import numbers, wide
from tidyledger.functions.contact import is_active, normalize_email
from tidyledger.functions.geography import standardize_geo_columns, standardize_state
from tidyledger.functions.numbers import MONEY, times, to_decimal, to_money, to_whole
from tidyledger.functions.text import full_name
from tidyledger.functions.timestamps import parse_date
from tidyledger.operators.dedup import key_winners, mark_soft_duplicates
from tidyledger.rules.staging import Staging
from tidyledger.rules.violations import prices
from tidyledger.schemas import CURATED, conform


def _customer_group() -> Column:
    """customer_id as a never-NULL key: distinct ids stay distinct and NULL gets a value of its own."""
    id_ = F.col("customer_id")
    return F.when(id_.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), id_))


def dim_customer(stg: Staging) -> DataFrame:
    """First row per customer_id, later same-person rows flagged, geography and email standardised.

    Winners come out partitioned by the key the flag is joined on, so whole rows move once.
    """
    winners = key_winners(stg.customers.withColumn("_group", _customer_group()), ["_group"])
    flagged = mark_soft_duplicates(winners, ["first_name", "last_name", "phone"], row_id="_group")
    geo = standardize_geo_columns(flagged, "country", "state")
    out = geo.select(
        F.col("customer_id").alias("customer_key"),
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        normalize_email(F.col("email")).alias("email"),
        "phone",
        F.col("country").alias("standard_country"),
        F.col("state").alias("standard_state"),
        parse_date(F.col("signup_date")).alias("signup_date"),
        "loyalty_tier",
        "duplicate_resolution_flag",
    )
    return conform(out, CURATED["dim_customer"])


def dim_product(stg: Staging) -> DataFrame:
    """All products, typed."""
    out = stg.products.select(
        F.col("product_id").alias("product_key"),
        "product_name",
        "category",
        numbers.money(F.col("unit_price")).alias("unit_price"),
        is_active(F.col("active_flag")).alias("active_flag"),
    )
    return conform(out, CURATED["dim_product"])


def fact_order(stg: Staging) -> DataFrame:
    """Orders without identical repeats; colliding ids and unknown references are kept.

    The calculated amount and the variance are NULL unless every number they need is valid.
    """
    typed = stg.kept_orders.select(
        "order_id",
        "customer_id",
        "product_id",
        parse_date(F.col("order_ts")).alias("order_date"),
        to_whole(F.col("quantity")).alias("whole"),
        numbers.large_whole(F.col("quantity")).alias("large"),
        "order_status",
        standardize_state(F.col("shipping_state")).alias("shipping_state"),
        to_decimal(F.col("order_total")).alias("gross"),
        numbers.money(F.col("order_total")).alias("gross_money"),
        F.when(numbers.is_beyond(F.col("order_total")), numbers.limbs(F.col("order_total"))).alias("gross_limbs"),
    )
    priced = typed.join(prices(stg.products).select("product_id", "unit_price"), "product_id", "left")
    price, gross = F.col("unit_price"), F.col("gross")
    calculated = times(F.col("whole"), to_decimal(price))
    beyond = numbers.is_beyond(price) | F.col("large").isNotNull()
    product = wide.times(F.coalesce("large", "whole"), numbers.limbs(price))
    variance = wide.minus(F.coalesce(F.col("gross_limbs"), wide.from_working(gross)), product)
    out = priced.select(
        F.col("order_id").alias("order_key"),
        F.col("customer_id").alias("customer_key"),
        F.col("product_id").alias("product_key"),
        "order_date",
        F.col("whole").try_cast("int").alias("quantity"),
        "order_status",
        "shipping_state",
        F.col("gross_money").alias("gross_order_amount"),
        F.when(beyond, wide.cents(product, MONEY)).otherwise(to_money(calculated)).alias("calculated_order_amount"),
        F.when(beyond | F.col("gross_limbs").isNotNull(), wide.cents(variance, MONEY))
        .otherwise(to_money(gross - calculated))
        .alias("order_amount_variance"),
    )
    return conform(out, CURATED["fact_order"])


def order_keys(stg: Staging) -> DataFrame:
    """The rows of ``fact_order`` with their keys alone, for questions that need no amounts: no price is looked up."""
    return stg.kept_orders.select(F.col("order_id").alias("order_key"), F.col("customer_id").alias("customer_key"))


def fact_payment(stg: Staging) -> DataFrame:
    """All payments, typed; orphans are kept."""
    out = stg.payments.select(
        F.col("payment_id").alias("payment_key"),
        F.col("order_id").alias("order_key"),
        parse_date(F.col("payment_ts")).alias("payment_date"),
        "payment_method",
        "payment_status",
        numbers.money(F.col("amount")).alias("payment_amount"),
    )
    return conform(out, CURATED["fact_payment"])


def fact_customer_issue(stg: Staging) -> DataFrame:
    """All tickets; an unparseable creation time is NULL."""
    out = stg.support_tickets.select(
        "ticket_id",
        F.col("customer_id").alias("customer_key"),
        parse_date(F.col("created_ts")).alias("created_date"),
        "channel",
        F.col("category").alias("issue_category"),
        "sentiment",
        "description",
    )
    return conform(out, CURATED["fact_customer_issue"])


BUILDERS = {
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "fact_order": fact_order,
    "fact_payment": fact_payment,
    "fact_customer_issue": fact_customer_issue,
}


def curated(stg: Staging) -> dict[str, DataFrame]:
    return {name: build(stg) for name, build in BUILDERS.items()}
