"""Sector tick analytics on Spark: ingest, models, quality checks and streams."""

from tickloom.asof import AsOf
from tickloom.session import build_session, use_session_defaults

__all__ = ["AsOf", "build_session", "use_session_defaults"]
