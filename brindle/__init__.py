"""Spark-first analytics operators."""
