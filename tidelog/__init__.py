"""Change-data-capture operators on Spark DataFrames and Structured Streaming."""

from tidelog.spec import TableSpec

__all__ = ["TableSpec"]
