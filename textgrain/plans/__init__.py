"""Registered queries and the SQL each one is checked against."""

from textgrain.plans import model_queries, text_queries, vector_queries  # noqa: F401
from textgrain.plans.registry import ORACLES, QUERIES  # noqa: F401
