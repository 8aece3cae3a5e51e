"""Outputs: catalog tables, relational tables, shared scratch tables."""
