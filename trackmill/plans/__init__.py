"""Composite flows, the query catalogue and its SQL oracles."""
