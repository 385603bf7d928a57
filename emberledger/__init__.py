"""emberledger: activity-accounting operators on Spark DataFrames.

Activity records and meter readings of any size become emissions ledgers:
factor lookups, derived loss records, allocation and downscaling of
totals, consumption models, sector assembly and reports -- all as Spark
SQL expressions, joins, aggregates and windows.
"""

from emberledger.session import get_session

__all__ = ["get_session"]
