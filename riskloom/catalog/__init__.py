"""Registered queries: each runs an operator over whole tables, most with an equivalent SQL text."""

from riskloom.catalog import behaviour, cleaning, decisions, evaluation, models, relational, sources, splits, streams
from riskloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "behaviour", "cleaning", "decisions", "evaluation", "models", "relational",
           "sources", "splits", "streams"]
