"""Spark-native operators and jobs for company data, keyed tables and click streams."""
