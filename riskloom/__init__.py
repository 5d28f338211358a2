"""Payments-risk lakehouse operators for Apache Spark."""
