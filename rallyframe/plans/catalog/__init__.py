"""Registered queries, one module per area."""
