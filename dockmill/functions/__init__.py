"""Scalar functions as Column builders, and text parsers."""
