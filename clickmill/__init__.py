"""Clickstream analytics on PySpark: DataFrame operators, jobs and streams."""
