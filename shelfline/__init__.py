"""Listing analytics expressed as Spark DataFrame operators."""
