"""Spark event-log corpus building, checking and diagnosis as DataFrame jobs."""
