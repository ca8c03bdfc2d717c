"""Customer-retention analytics as Spark DataFrame transformations."""

from tidemark.settings import Settings

__all__ = ["Settings"]
