"""Readers, sinks and the ledger view over the order tables."""
