"""Readers: snapshot files, stored tables, prepared files, code lists and the ledger."""
