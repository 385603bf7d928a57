"""Compositions of the operators: sector ledgers, the full run, report tables, and the
acceptance queries on the test tables with their DuckDB oracle."""
