"""Imports every module that registers a dealt operator."""

from kinfold.llm import (  # noqa: F401
    html, katz, langid, packing, quality, repair, rules, secrets, simhash, tiling, toxicity, urls, whitening,
)
from kinfold.llm.registry import ORACLES, QUERIES  # noqa: F401
