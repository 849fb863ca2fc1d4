"""Governed-warehouse operators written as plain PySpark DataFrame jobs."""
