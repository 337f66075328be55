"""starload: star-schema load, quality checks and metrics on Spark DataFrames."""

__version__ = "0.1.0"
