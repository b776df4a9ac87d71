"""Build and audit labelled text corpora with Spark DataFrames."""

from lexloom.session import build_session

__all__ = ["build_session"]
