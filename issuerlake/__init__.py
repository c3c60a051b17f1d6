"""Corporate-credit data on Spark: DataFrames in, DataFrames out."""

__version__ = "0.1.0"
