"""tidemark: market-data analytics, quality checks and document tools as Spark DataFrame operators."""

__version__ = "0.1.0"
