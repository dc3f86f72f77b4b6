"""Structured extraction from transfer-receipt images as Spark DataFrame operators."""
