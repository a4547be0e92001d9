"""corpusloom: corpus preparation, sampling and instruction-data operators on Spark DataFrames."""

__version__ = "0.1.0"
