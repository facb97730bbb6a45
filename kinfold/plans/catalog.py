"""Imports every module that registers queries."""

from kinfold.plans import families, formats, neighbours, quantities, sequences, terms, trees  # noqa: F401
from kinfold.plans.registry import ORACLES, QUERIES  # noqa: F401
