"""Readers, sinks and the stand-in views over the test tables."""
