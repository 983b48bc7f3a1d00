"""Trajectory analytics and per-trip weight estimation as Spark DataFrame operators."""
