"""Collections of named tables on Spark: load, profile, relate, ask, answer."""

from tableloom.analyzer import Analyzer, create_analyzer

__all__ = ["Analyzer", "create_analyzer"]
