"""nestmart: catalog CSV files with nested text columns -> snowflake warehouse,
built on Spark's DataFrame, SQL and Structured Streaming APIs."""

__version__ = "0.1.0"
