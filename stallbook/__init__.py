"""Stallbook: multi-branch retail stock and finance analytics as PySpark jobs."""

from stallbook.config import RetailConfig

__all__ = ["RetailConfig"]
