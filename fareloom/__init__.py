"""Ride-operations analytics expressed as Spark DataFrame jobs."""
