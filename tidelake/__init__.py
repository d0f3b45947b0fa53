"""Snapshot-versioned lakehouse tables as Spark DataFrames."""

from tidelake.operators.scan import scan

__all__ = ["scan"]
__version__ = "0.1.0"
