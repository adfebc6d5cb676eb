"""Meterline: trip and event analytics written with the public Spark API."""
