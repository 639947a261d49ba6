"""terrazone: area-weighted analytics on gridded and tabular data, as Spark DataFrame operators."""

__version__ = "0.1.0"
