"""Registered queries, each with its SQL equivalent where SQL can express it."""

from .registry import ORACLE, QUERIES  # noqa: F401
from . import cleaning, features, modelling, profiling, reshaping, scoring, vectors  # noqa: F401
