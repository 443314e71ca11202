"""Retail invoice-line analytics written as Spark DataFrame transformations."""
