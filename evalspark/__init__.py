"""evalspark: grouped decision data on PySpark - prepare, audit, score, rank, reconcile, fit."""

__version__ = "0.1.0"
