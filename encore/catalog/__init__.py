"""Importing this package registers every query."""

from encore.catalog import (  # noqa: F401
    cells,
    joins,
    learning,
    linking,
    prepared,
    profiles,
    reports,
    scoring,
    sources,
    statistics,
    streams,
    studies,
    texts,
)
from encore.catalog.base import ORACLES, QUERIES  # noqa: F401
