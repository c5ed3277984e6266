"""Datasets composed from the operators."""
