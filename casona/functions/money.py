"""Currency and price expressions (exact decimals, half-up rounding)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casona import refdata
from casona.functions.text import as_col
from casona.session import small_table

MONEY = "decimal(14,2)"


def rate_table(spark, rates: dict[str, float] | None = None) -> DataFrame:
    """Units per USD as a table (currency, rate)."""
    rows = sorted((rates or refdata.FALLBACK_RATES).items())
    return small_table(spark, rows, "currency string, rate double").select(
        "currency", F.col("rate").cast("decimal(14,6)").alias("rate")
    )


def usd_amount(amount, currency, rate) -> Column:
    """USD as is, no currency means USD, else divide by the rate; unknown or zero rate gives null."""
    amount, currency, rate = as_col(amount).cast(MONEY), as_col(currency), as_col(rate)
    converted = F.when(rate != 0, F.round(amount / rate, 2))
    return F.when(currency.isNull() | (currency == "USD"), amount).otherwise(converted).cast(MONEY)


def price_per_sqm(price_usd, interior_sqm) -> Column:
    sqm = as_col(interior_sqm).cast("decimal(10,2)")
    return F.when(sqm > 0, F.round(as_col(price_usd).cast(MONEY) / sqm, 2)).cast("decimal(12,2)")
