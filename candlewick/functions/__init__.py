"""Column-level functions: numeric rules, classifiers, time and key helpers."""

from candlewick.functions import classify, numeric, temporal

__all__ = ["classify", "numeric", "temporal"]
