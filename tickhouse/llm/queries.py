"""Imports every query module of this subpackage, which registers them."""

from tickhouse.llm import op01, op02, op03, op04, op05, op06, op07, op08, op09, op10, op11, op12, op13  # noqa: F401
from tickhouse.llm.registry import ORACLE, QUERIES  # noqa: F401
