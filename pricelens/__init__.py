"""pricelens: price-intelligence operators as composable Spark DataFrame functions."""

__version__ = "0.1.0"
