"""The table contract: column types, no nulls, one row per key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.functions import instant
from tapemill.functions.temporal import Now
from tapemill.schemas import BAR_SCHEMA, KEYS


ANY_NULL = " OR ".join(f"{name} IS NULL" for name in BAR_SCHEMA.fieldNames())
VIOLATION = "row_cnt > 1 OR null_row_cnt > 0"


class ContractError(ValueError):
    """Rows that a bar table must not hold."""


def conform_bars(bars: DataFrame, now: Now = None) -> DataFrame:
    """Columns in table order and type; decimals round half up. `updated_at` defaults to the clock."""
    if "updated_at" not in bars.columns:
        bars = bars.withColumn("updated_at", instant(now))
    return bars.select([F.col(field.name).cast(field.dataType).alias(field.name) for field in BAR_SCHEMA])


def key_counts(bars: DataFrame, *extra: str) -> DataFrame:
    """Per key (and `extra` columns): its rows, and those of them with a null in any column."""
    has_null = F.expr(ANY_NULL)
    return bars.groupBy(*extra, *KEYS).agg(
        F.count(F.lit(1)).alias("row_cnt"), F.count_if(has_null).alias("null_row_cnt")
    )


def contract_violations(bars: DataFrame) -> DataFrame:
    """Keys that occur more than once or come with a null in any column."""
    return key_counts(bars).where(VIOLATION)


def check_contract(bars: DataFrame) -> None:
    """Raise with a few offending keys, if there are any."""
    sample = contract_violations(bars).limit(5).collect()
    if sample:
        raise ContractError("rows break the table contract: " + "; ".join(str(row.asDict()) for row in sample))
