"""Operators for large training-data pipelines; nothing else in textloom imports this subpackage."""
