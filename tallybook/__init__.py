"""Tallybook: visit-event ledgers and their reports, as Spark jobs."""
