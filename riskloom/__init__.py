"""Credit-risk analytics as Spark table and stream operators (DataFrame in, DataFrame out)."""

__version__ = "0.1.0"
