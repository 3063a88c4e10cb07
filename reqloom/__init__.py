"""Request-log analytics on Spark: normalisation, dashboard metrics, quality, consistency and drift."""

from reqloom.session import build_session

__all__ = ["build_session"]
