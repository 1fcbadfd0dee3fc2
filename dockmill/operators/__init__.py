"""Relational, similarity, matching and batching operators."""
