"""All registered queries."""

from . import (  # noqa: F401
    metric_queries, rule_queries, source_queries, stream_queries, text_queries,
    validation_queries,
)
from .registry import ORACLES, QUERIES  # noqa: F401
