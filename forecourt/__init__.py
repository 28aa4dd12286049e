"""Inventory metrics for vehicle listings, written as Spark DataFrame operators."""
