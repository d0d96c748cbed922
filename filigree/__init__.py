"""Registry analytics on Spark: typed tables, graph frames and text-corpus operators."""

__version__ = "0.1.0"
