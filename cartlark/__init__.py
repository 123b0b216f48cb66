"""Retail behaviour events on Spark: ETL, analytics, streaming and recommendation."""
