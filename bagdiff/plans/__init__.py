"""Pipelines (E1-E3) and the contract queries."""
