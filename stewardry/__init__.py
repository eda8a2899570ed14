"""Governed data-use analytics on Spark."""

from stewardry.session import build_session

__all__ = ["build_session"]
