"""Layered retail analytics on Spark: landing, bronze, silver, gold and KPIs."""
