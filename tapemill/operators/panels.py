"""Monitoring frames over the minute table: trailing panels, their figures and the chart feeds.

Every function takes the minute table, the clock and optionally one symbol. Without a symbol it answers for
all symbols in one job, one group per symbol.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapemill.functions import display_time, grouped_text, minute_label, percent_text, since
from tapemill.functions.temporal import DISPLAY_ZONE, Now
from tapemill.operators.timerange import from_time

# Panel lengths, rows of the recent panel, rows of the rolling window, axis padding.
HOUR_PANEL = "1 HOUR"
RECENT_PANEL = "10 MINUTES"
RECENT_ROWS = 10
ROLLING_ROWS = 5
AXIS_LOW, AXIS_HIGH = 0.999, 1.001


def _trailing(bars: DataFrame, now: Now, length: str, symbol: str | None) -> DataFrame:
    panel = from_time(bars, since(now, length))
    return panel if symbol is None else panel.where(F.col("symbol") == symbol)


def panel_1h(bars: DataFrame, now: Now = None, symbol: str | None = None) -> DataFrame:
    """Minutes of the last hour in time order."""
    return _trailing(bars, now, HOUR_PANEL, symbol).orderBy("window_start_ts", "symbol")


def panel_recent(bars: DataFrame, now: Now = None, symbol: str | None = None) -> DataFrame:
    """The latest ten minutes present in the last ten minutes, newest first (ten per symbol)."""
    panel = _trailing(bars, now, RECENT_PANEL, symbol)
    newest = F.col("window_start_ts").desc()
    if symbol is not None:
        return panel.orderBy(newest).limit(RECENT_ROWS)
    ranked = panel.withColumn("rank", F.row_number().over(Window.partitionBy("symbol").orderBy(newest)))
    return ranked.where(F.col("rank") <= RECENT_ROWS).drop("rank").orderBy(newest, "symbol")


def recent_total(bars: DataFrame, now: Now = None, symbol: str | None = None) -> DataFrame:
    return panel_recent(bars, now, symbol).groupBy("symbol").agg(F.sum("trade_cnt").alias("recent_rows"))


def _per_symbol(panel: DataFrame, symbol: str | None, *figures: Column) -> DataFrame:
    """Per-symbol figures; a named symbol always gives one row, also from an empty panel."""
    if symbol is None:
        return panel.groupBy("symbol").agg(*figures)
    return panel.agg(*figures).select(F.lit(symbol).alias("symbol"), "*")


def hour_figures(bars: DataFrame, now: Now = None, symbol: str | None = None) -> DataFrame:
    """All figures of the last hour from one aggregate; the frames below take theirs from it.

    Mean of the minute means, its lowest and highest value, highest and lowest price, trades, sample deviation
    of the minute means, and (max - min) / mean in percent (null at mean 0). Empty: nulls and 0 trades.
    """
    mean = F.col("price_avg").cast("double")
    figures = _per_symbol(
        _trailing(bars, now, HOUR_PANEL, symbol),
        symbol,
        F.avg(mean).alias("avg_price"),
        F.max("price_max").alias("max_price"),
        F.min("price_min").alias("min_price"),
        F.coalesce(F.sum("trade_cnt"), F.lit(0)).alias("trade_count"),
        F.stddev_samp(mean).alias("std_dev"),
        (F.min(mean) * AXIS_LOW).alias("y_min"),
        (F.max(mean) * AXIS_HIGH).alias("y_max"),
    )
    spread = (F.col("max_price") - F.col("min_price")).cast("double")
    return figures.withColumn("vol_rate", F.try_divide(spread, "avg_price") * 100)


def kpis_1h(bars: DataFrame, now: Now = None, symbol: str | None = None) -> DataFrame:
    """Mean of the minute means, highest and lowest price, trades."""
    return kpis(hour_figures(bars, now, symbol))


def kpis(figures: DataFrame) -> DataFrame:
    return figures.select("symbol", "avg_price", "max_price", "min_price", "trade_count")


def volatility_1h(bars: DataFrame, now: Now = None, symbol: str | None = None) -> DataFrame:
    """Sample deviation of the minute means, and (max - min) / mean in percent."""
    return volatility(hour_figures(bars, now, symbol))


def volatility(figures: DataFrame) -> DataFrame:
    return figures.select("symbol", "std_dev", "vol_rate")


def axis_range_1h(bars: DataFrame, now: Now = None, symbol: str | None = None) -> DataFrame:
    return axis_range(hour_figures(bars, now, symbol))


def axis_range(figures: DataFrame) -> DataFrame:
    return figures.select("symbol", "y_min", "y_max")


def kpi_text(bars: DataFrame, now: Now = None, symbol: str | None = None) -> DataFrame:
    """The figures as shown, e.g. "1,234.50", "1,234", "1.23%"."""
    return figure_texts(hour_figures(bars, now, symbol))


def figure_texts(figures: DataFrame) -> DataFrame:
    prices = [
        grouped_text(F.col(name).cast("double"), 2).alias(name) for name in ("avg_price", "max_price", "min_price")
    ]
    return figures.select(
        "symbol",
        *prices,
        grouped_text(F.col("trade_count"), 0).alias("trade_count"),
        grouped_text(F.col("std_dev"), 2).alias("std_dev"),
        percent_text(F.col("vol_rate")).alias("vol_rate"),
    )


def _rolling(partition: list[str], rows: int) -> Column:
    frame = Window.partitionBy(*partition).orderBy("window_start_ts").rowsBetween(1 - rows, 0)
    mean = F.col("price_avg").cast("double")
    return F.when(F.count(mean).over(frame) >= rows, F.stddev_samp(mean).over(frame))


def rolling_std(
    bars: DataFrame, now: Now = None, symbol: str | None = None, rows: int = ROLLING_ROWS
) -> DataFrame:
    """Sample deviation over the last five minutes present; null until there are five.

    The panel bounds a symbol's group to the minutes of one hour. Use `rolling_std_history` for more.
    """
    panel = _trailing(bars, now, HOUR_PANEL, symbol)
    rolled = panel.select("symbol", "window_start_ts", _rolling(["symbol"], rows).alias("rolling_std"))
    return rolled.orderBy("window_start_ts", "symbol")


def rolling_std_history(bars: DataFrame, rows: int = ROLLING_ROWS, chunk: str = "day") -> DataFrame:
    """`rolling_std` over a whole table, without putting a symbol's history into one sort.

    Each symbol is cut into days. A day needs the `rows - 1` rows before it, which lie in the tails of at
    most `rows - 1` earlier days, so only those tails are ordered per symbol; the rows themselves are
    partitioned by symbol and day.
    """
    need = rows - 1
    minutes = bars.select(
        "symbol", "window_start_ts", "price_avg", F.date_trunc(chunk, "window_start_ts").alias("chunk")
    )
    newest_first = Window.partitionBy("symbol", "chunk").orderBy(F.col("window_start_ts").desc())
    tails = (
        minutes.withColumn("rank", F.row_number().over(newest_first))
        .where(F.col("rank") <= need)
        .groupBy("symbol", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("window_start_ts", "price_avg"))).alias("tail"))
    )
    earlier = Window.partitionBy("symbol").orderBy("chunk").rowsBetween(-need, -1)
    before = tails.select("symbol", "chunk", F.flatten(F.collect_list("tail").over(earlier)).alias("before"))
    last = F.slice("before", F.greatest(F.size("before") - F.lit(need - 1), F.lit(1)), F.lit(need))
    borrowed = before.select("symbol", "chunk", F.inline(last)).withColumn("borrowed", F.lit(True))
    framed = minutes.withColumn("borrowed", F.lit(False)).unionByName(borrowed)
    rolled = framed.select(
        "symbol", "window_start_ts", "borrowed", _rolling(["symbol", "chunk"], rows).alias("rolling_std")
    )
    return rolled.where(~F.col("borrowed")).drop("borrowed")


def minute_counts(
    bars: DataFrame, now: Now = None, symbol: str | None = None, zone: str = "UTC"
) -> DataFrame:
    """Bar chart feed: HH:MM label and trades per minute of the recent panel."""
    recent = panel_recent(bars, now, symbol)
    return recent.select("symbol", minute_label(F.col("window_start_ts"), zone).alias("minute"), "trade_cnt")


def _series(bars: DataFrame, now: Now, symbol: str | None, measure: str, zone: str) -> DataFrame:
    shown = display_time(F.col("window_start_ts"), zone).alias("window_start_ts")
    return panel_1h(bars, now, symbol).select("symbol", shown, measure)


def price_series(
    bars: DataFrame, now: Now = None, symbol: str | None = None, zone: str = DISPLAY_ZONE
) -> DataFrame:
    return _series(bars, now, symbol, "price_avg", zone)


def volume_series(
    bars: DataFrame, now: Now = None, symbol: str | None = None, zone: str = DISPLAY_ZONE
) -> DataFrame:
    return _series(bars, now, symbol, "volume_sum", zone)
