"""Millrace: DataFrame-to-DataFrame building blocks for analytics and data loading on Spark."""
