"""Exact sums and means over double columns, range checks and number texts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapemill.schemas import PRICE_LIMIT, PRICE_TYPE, VOLUME_TYPE

# Digits that a price keeps until its mean is rounded, once.
_FINE_PRICE = "decimal(28,18)"


def exact_volume(qty: Column) -> Column:
    """Sum of quantities, each as the decimal number that the JVM writes its double as.

    The result does not depend on row order. It fails loudly (ANSI mode, which `configure` pins) where it
    no longer fits the table.
    """
    return F.sum(qty.cast(VOLUME_TYPE)).cast(VOLUME_TYPE)


def exact_mean_price(price: Column) -> Column:
    """Mean of prices at eighteen decimal places, rounded half up to the table's eight at the end."""
    return F.avg(price.cast(_FINE_PRICE)).cast(PRICE_TYPE)


def table_price(price: Column) -> Column:
    """A price as the table holds it; by way of the same digits as the mean, so that it lies on the right side."""
    return price.cast(_FINE_PRICE).cast(PRICE_TYPE)


def usable_price(price: Column) -> Column:
    """Finite and within the table's price type. NaN sorts above every number, so it fails too."""
    return F.coalesce(F.abs(price) < F.lit(PRICE_LIMIT), F.lit(False))


def usable_qty(qty: Column) -> Column:
    """Finite and within the table's volume type."""
    return qty.try_cast(VOLUME_TYPE).isNotNull()


def grouped_text(value: Column, digits: int) -> Column:
    """1234.5 -> "1,234.50"; exact ties round to even, a missing value reads "nan"."""
    return F.coalesce(F.format_number(value, digits), F.lit("nan"))


def percent_text(value: Column) -> Column:
    """1.234 -> "1.23%", without a thousands separator."""
    text = F.call_function("format_number", value, F.lit("0.00"))
    return F.concat(F.coalesce(text, F.lit("nan")), F.lit("%"))
