"""Workforce shift performance and payroll export on Spark DataFrames."""

from shiftledger.settings import Settings

__all__ = ["Settings"]
