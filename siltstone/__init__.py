"""siltstone: a Spark-first engine for curating text corpora."""

__version__ = "0.1.0"
