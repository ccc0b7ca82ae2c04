"""Importing this package fills the registry."""

from ebbtide.catalog.registry import QUERIES
from ebbtide.catalog import eda, evaluation, features, models, monitoring, quality, sources  # noqa: F401

__all__ = ["QUERIES"]
