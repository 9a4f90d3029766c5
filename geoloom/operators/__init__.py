"""Relational, merge, spatial and graph operators."""
