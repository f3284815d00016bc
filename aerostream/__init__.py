"""aerostream — flight-status and text-stream analytics on Spark DataFrames."""

__version__ = "0.1.0"
