"""sluice: a layered (bronze / silver / gold) sales lakehouse on Spark DataFrames."""

__version__ = "0.1.0"
