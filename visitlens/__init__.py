"""User-behaviour analytics as PySpark DataFrame jobs."""
