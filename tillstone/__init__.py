"""tillstone: Spark operators for point-of-sale exports, from landing files to daily summaries."""

__version__ = "0.1.0"
