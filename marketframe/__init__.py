"""Market, macro-economic and company-fundamentals analytics on Spark DataFrames."""

__version__ = "0.1.0"
