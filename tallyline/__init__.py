"""Ledger, order, seller and basket analytics as Spark plans."""
