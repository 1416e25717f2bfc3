"""dwkit: dimensional warehouse building and querying on Spark DataFrames."""

__version__ = "0.1.0"
