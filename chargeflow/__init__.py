"""Charging analytics for electric-vehicle fleets as PySpark DataFrame jobs."""
