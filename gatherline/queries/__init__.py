"""All registered queries of the engine itself."""

from gatherline.queries import fields, intake, listings, matching, relations, rules  # noqa: F401
from gatherline.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
