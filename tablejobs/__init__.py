"""tablejobs: batch table jobs on Spark DataFrames and Spark SQL."""

__version__ = "0.1.0"
