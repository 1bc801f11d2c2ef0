"""Queries of the reference's operators."""
