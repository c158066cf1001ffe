"""Catalogue of travel experiences, built from captured pages with Spark."""

from excursio.settings import Settings

__all__ = ["Settings"]
