"""Listening analytics on Spark DataFrames, batch and streaming."""

from playtide.session import build_session

__all__ = ["build_session"]
