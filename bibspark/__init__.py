"""bibspark: a Spark-first engine for bibliographic records and text corpora."""

__version__ = "0.1.0"
