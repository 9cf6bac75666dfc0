"""quire: a PySpark-native engine for building and querying citation-preserving text corpora."""

__version__ = "0.1.0"
