"""Spark-native preparation of public mortgage releases.

Everything is a ``DataFrame -> DataFrame`` (or ``Column -> Column``) function, so
each piece composes with ``df.transform`` and is planned by Catalyst.  The classes
re-exported here bundle the pieces into the end-to-end jobs.
"""

from ridgepole.config import DataPaths, LoadOptions
from ridgepole.plans.bank_data import BankData
from ridgepole.plans.limits import LoanLimits
from ridgepole.plans.loan_files import LoanFiles
from ridgepole.plans.medallion import Layer, LayerPaths, Medallion
from ridgepole.sources.sinks import write_hive

__all__ = [
    "BankData",
    "DataPaths",
    "Layer",
    "LayerPaths",
    "LoadOptions",
    "LoanFiles",
    "LoanLimits",
    "Medallion",
    "write_hive",
]
