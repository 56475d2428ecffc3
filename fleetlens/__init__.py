"""Sensor-recording analytics, expressed as Spark plans."""
