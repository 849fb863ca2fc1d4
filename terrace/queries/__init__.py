"""Registered queries over the given tables, each with an independent SQL answer where SQL can say it."""

from terrace.queries import access, audit, cost, federation, identity, ingest, sharing, streams, workspaces  # noqa: F401
from terrace.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
