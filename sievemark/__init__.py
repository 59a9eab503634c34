"""Cleaning, auditing, profiling and daily-impact analysis of large fact tables, as Spark DataFrame operators."""
