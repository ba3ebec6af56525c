"""stockweave: supply-chain lakehouse models and planning operators as Spark DataFrames."""

__version__ = "0.1.0"
