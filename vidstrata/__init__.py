"""Medallion analytics for video-platform data, written as plain PySpark jobs."""

from vidstrata.session import build_session, tune

__all__ = ["build_session", "tune"]
