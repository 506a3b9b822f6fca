from tapemill.plans.dashboard import build_dashboard
from tapemill.plans.hourly import run_hourly

__all__ = ["build_dashboard", "run_hourly"]
