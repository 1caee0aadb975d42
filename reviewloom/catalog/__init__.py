"""All registered queries."""

from . import (  # noqa: F401
    aggregates,
    business,
    evaluation,
    filters,
    joins,
    keywords,
    ml,
    ranking,
    streams,
    text,
    timeseries,
)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
