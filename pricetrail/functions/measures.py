"""Price, token and date arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names and the rounding the results use.
PER_MILLION = "per_1M_tokens"
PER_THOUSAND = "per_1K_tokens"
PRICE_DIGITS = 6
DENSITY_DIGITS = 3


def per_million(price: Column, unit: Column) -> Column:
    return F.when(unit == PER_MILLION, price).when(unit == PER_THOUSAND, price * 1000)


def per_thousand(price: Column, unit: Column) -> Column:
    return F.when(unit == PER_MILLION, F.round(price / 1000, PRICE_DIGITS)).when(
        unit == PER_THOUSAND, price
    )


def thousand_to_million(price: Column) -> Column:
    return F.round(price * 1000, PRICE_DIGITS)


def density(tokens: Column, chars: Column) -> Column:
    """Tokens per thousand characters; null without tokens or characters."""
    return F.round(tokens / (F.nullif(chars.cast("double"), F.lit(0.0)) / 1000), DENSITY_DIGITS)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage at ``digits`` decimals; null when ``whole`` is zero.

    It is taken as a number of 15 decimals, as a cast of the double to DECIMAL(38, 15)
    has them, and halves go away from zero. What is too large for that has no decimals.
    """
    share = part / F.nullif(whole, F.lit(0.0)) * 100
    scaled = (share * F.lit(1e15)).try_cast("decimal(38,0)")
    return F.coalesce(F.round(F.round(scaled, digits - 15).cast("double") / F.lit(1e15), digits), F.round(share, digits))


def usd_value(tokens_in: Column, tokens_out: Column, in_price: Column, out_price: Column) -> Column:
    return tokens_in / F.lit(1e6) * in_price + tokens_out / F.lit(1e6) * out_price


def implied_per_million(tokens_in: Column, tokens_out: Column, usd: Column) -> Column:
    total = tokens_in + tokens_out
    return F.when(total > 0, usd * (F.lit(1e6) / total))


def hit_cap(tokens_out: Column, cap: Column) -> Column:
    """Whether the output reached its cap; unknown output did not."""
    return F.coalesce(tokens_out >= cap, F.lit(False))


def days_between(start: Column, end: Column) -> Column:
    """Whole days, never below zero; null when either end is missing."""
    days = F.date_diff(end, start)
    return F.when(days.isNotNull(), F.greatest(F.lit(0), days))


def age_hours(then: Column, now: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(then)) / F.lit(3.6e9)


def parse_scraped_at(c: Column) -> Column:
    """ISO time with zone; a missing one means now."""
    return F.coalesce(F.to_timestamp(F.nullif(c, F.lit(""))), F.current_timestamp())


def clamp(c: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def or_else(first: Column, second: Column) -> Column:
    """First non-empty of two text columns, else the empty string."""
    empty = F.lit("")
    return F.coalesce(F.nullif(first, empty), F.nullif(second, empty), empty)
