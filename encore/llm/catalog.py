"""Importing this module registers every query of the package."""

from encore.llm import (  # noqa: F401
    extract,
    jaccard,
    language,
    line_dedup,
    packing,
    pieces,
    quality,
    rules,
    runs,
    search,
    simhash,
    suffixes,
    turns,
)
from encore.llm.base import ORACLES, QUERIES  # noqa: F401
