"""Retail lakehouse operators and pipeline on the Spark DataFrame API."""
