"""Spark operators for layered (bronze, silver, gold) lakehouse tables."""
