"""Trade aggregation on Spark: raw exchange messages in, minute and hour tables and monitoring frames out."""

from tapemill.session import build_session, configure, work_dir

__all__ = ["build_session", "configure", "work_dir"]
