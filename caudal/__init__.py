"""Retail-banking lakehouse and credit-risk jobs on Spark."""
