"""Spark jobs that learn, rebuild and study event and network-flow tables."""
