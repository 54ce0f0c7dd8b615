"""Queries over the test tables that exercise every operator, each with its SQL twin."""

from ridgepole.checks import cleaning, dictionaries, fixed_width, jobs, storage, unions
from ridgepole.checks.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "cleaning", "dictionaries", "fixed_width", "jobs", "storage", "unions"]
