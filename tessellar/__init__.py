"""Spark-native analytics over large file corpora: crawl indexes, tool runs, reports and texts."""

__version__ = "0.1.0"
