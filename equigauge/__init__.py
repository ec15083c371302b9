"""Audits of decision tables on Spark: fairness, privacy, data quality and performance."""

__version__ = "0.1.0"
