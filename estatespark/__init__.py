"""estatespark: a Spark-native sales analytics library.

Ingests headerless yearly sales files, filters and decodes them, enriches each sale from a
lookup table, builds a star schema (one fact, three dimensions with MD5 surrogate keys) and
answers investment questions on it, with data-quality checks as Spark queries.
"""

from .config import FIXTURE, LONDON, Config

__all__ = ["Config", "FIXTURE", "LONDON"]
