"""Presentation strings as column expressions: labels, day/hour, decimal-comma numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed


def _literal_map(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def humanize_type(value: Column) -> Column:
    """Label of a transaction type; unknown codes become title case."""
    known = _literal_map(fixed.TRANSACTION_TYPE_LABELS)[F.upper(F.trim(value))]
    return F.coalesce(known, F.initcap(F.replace(value, F.lit("_"), F.lit(" "))))


def step_to_day_hour(step: Column) -> Column:
    """Hour counter -> day number and hour of day."""
    hours = F.floor(step.try_cast("double")).cast("long") - 1
    day = F.floor(hours / 24).cast("long") + 1
    text = F.format_string("Hari ke-%d, %02d:00", day, F.pmod(hours, F.lit(24)))
    return F.when(hours.isNull(), "-").otherwise(text)


def _or_dash(number: Column, text: Column) -> Column:
    return F.when(number.isNull(), "-").otherwise(text)


_SPLIT = float(2**27 + 1)


def _units(v: Column, decimals: int) -> Column:
    """A non-negative number in units of the last shown decimal, halves to even.

    Whether a number is exactly half-way is decided on its binary value: the product's
    rounding error is recovered by splitting the number into two short halves.
    """
    scale = F.lit(float(10**decimals))
    product = v * scale
    scaled = v * F.lit(_SPLIT)
    high = scaled - (scaled - v)
    error = (high * scale - product) + (v - high) * scale
    below = F.floor(product)
    half = F.when(error > 0, below + 1).when(error < 0, below).otherwise(below + below % 2)
    return F.when(product - below == 0.5, half).otherwise(F.rint(product).cast("long"))


def _decimal(v: Column, decimals: int, grouping: str = "") -> Column:
    """Fixed-point text with a decimal point, optionally with thousands commas."""
    units, base = _units(F.abs(v), decimals), 10**decimals
    whole = F.format_string(f"%{grouping}d", F.floor(units / F.lit(base)))
    shown = whole if decimals == 0 else F.concat(whole, F.lit("."), F.lpad((units % base).cast("string"), decimals, "0"))
    return F.concat(F.when(v < 0, "-").otherwise(""), shown)


def format_pct(value: Column, decimals: int = 2) -> Column:
    v = value.try_cast("double")
    return _or_dash(v, F.concat(F.translate(_decimal(v * 100, decimals), ".", ","), F.lit("%")))


def format_int(value: Column) -> Column:
    v = value.try_cast("double")
    return _or_dash(v, F.translate(_decimal(v, 0, ","), ",", "."))


def format_rupiah(value: Column, decimals: int = 0) -> Column:
    v = value.try_cast("double")
    return _or_dash(v, F.concat(F.lit("Rp"), F.translate(_decimal(v, decimals, ","), ",.", ".,")))


def format_multiplier(value: Column) -> Column:
    v = value.try_cast("double")
    return _or_dash(v, F.concat(F.translate(_decimal(v, 1, ","), ".", ","), F.lit("x")))


def humanize_items(joined: Column) -> Column:
    """Comma-joined items -> their labels joined by DAN; a dash for no items."""
    items = F.filter(F.transform(F.split(joined, ","), lambda i: F.trim(i)), lambda i: i != "")
    labels = _literal_map(fixed.ITEM_LABELS)
    named = F.transform(items, lambda i: F.coalesce(labels[i], F.replace(i, F.lit("_"), F.lit(" "))))
    return F.when(F.size(named) > 0, F.array_join(named, " DAN ")).otherwise("-")
