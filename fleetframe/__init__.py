"""Telemetry lakehouse engine for a fleet, written as Spark DataFrame jobs."""
