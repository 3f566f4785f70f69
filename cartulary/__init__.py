"""Reconciliation and enrichment of large file inventories on Spark."""
