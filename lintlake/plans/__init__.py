"""Operator chains, and the registered queries over the shared tables."""
