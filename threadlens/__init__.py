"""Analytics for discussion posts on Spark: ingest, text features, stance scoring, tests and models."""

from threadlens.session import build_session, configure

__all__ = ["build_session", "configure"]
