"""Queries over the given tables that exercise the gate, each with its SQL."""
