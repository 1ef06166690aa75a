"""Operators for large-scale training-data pipelines.

Self-contained: nothing outside this folder imports it, and it imports nothing
else of the library, so that the folder can be removed as a whole.
"""
