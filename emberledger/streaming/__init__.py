"""Structured Streaming form of the meter ledger."""
