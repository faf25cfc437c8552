"""All registered queries and their SQL counterparts."""

from tidemark.queries import (  # noqa: F401  (imported for registration)
    discovery,
    entities,
    exports,
    files,
    jobs,
    keyed,
    live,
    payloads,
    rollups,
    serving,
)
from tidemark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
