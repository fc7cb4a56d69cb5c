"""All registered queries."""

from evgraph.catalog import answers, documents, forecast, graph, identity, ownership
from evgraph.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "answers", "documents", "forecast", "graph", "identity", "ownership"]
