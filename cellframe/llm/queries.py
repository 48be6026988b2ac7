"""Registers the queries of all operators and gives them to the driver contract."""

from cellframe.llm import bpe, crosstok, decontaminate, html, langid, lm, merkle, neardup, packing, quality, substring, suffix, urls  # noqa: F401
from cellframe.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
