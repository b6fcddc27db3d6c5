"""Registered queries over the test tables, each with its SQL twin where one exists."""

from affinia.plans import (  # noqa: F401
    interaction_queries, source_queries, stream_queries, text_queries, vector_queries,
)
from affinia.plans.registry import ORACLES, QUERIES  # noqa: F401
