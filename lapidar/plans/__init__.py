"""Operators bound to the retail tables: silver, dimensions, fact, KPIs, jobs."""
