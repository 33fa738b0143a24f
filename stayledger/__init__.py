"""Spark-native landing, cleaning, star-schema and KPI operators for monthly operational extracts."""
