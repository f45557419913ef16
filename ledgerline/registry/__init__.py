"""Registered queries and their SQL twins."""

from ledgerline.registry.book import ORACLES, QUERIES
from ledgerline.registry import q_archive, q_finance, q_register, q_state  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
