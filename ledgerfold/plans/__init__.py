"""Whole runs over a ledger, and the queries over a star-schema test set."""
