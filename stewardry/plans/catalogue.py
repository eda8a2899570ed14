"""Importing this module registers every query."""

from stewardry.plans import q_audit, q_authorize, q_enforce, q_gate, q_resolve, q_stream, q_validate  # noqa: F401
from stewardry.plans.registry import QUERIES, oracles  # noqa: F401
