"""Registered queries and their SQL twins."""

from . import modelling, reshaping, rowstats, segments, selection, sources, spectra, streams, summaries, testing, trees  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
