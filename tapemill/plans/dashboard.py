"""All monitoring frames of one refresh."""

from pyspark.sql import DataFrame

from tapemill.functions.temporal import Now
from tapemill.operators import panels
from tapemill.operators.quality import ingest_status


def build_dashboard(bars: DataFrame, now: Now = None, symbol: str | None = None) -> dict[str, DataFrame]:
    """Lazy frames by name; nothing runs until one is used."""
    frames = {
        "panel_1h": panels.panel_1h,
        "panel_recent": panels.panel_recent,
        "ingest_status": ingest_status,
        "minute_counts": panels.minute_counts,
        "rolling_std": panels.rolling_std,
        "price_series": panels.price_series,
        "volume_series": panels.volume_series,
    }
    figures = panels.hour_figures(bars, now, symbol)
    return {name: frame(bars, now, symbol) for name, frame in frames.items()} | {
        "kpis_1h": panels.kpis(figures),
        "kpi_text": panels.figure_texts(figures),
        "volatility_1h": panels.volatility(figures),
        "axis_range_1h": panels.axis_range(figures),
    }
