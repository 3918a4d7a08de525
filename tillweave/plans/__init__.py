"""Staging, identity, dimensions, facts and the full run."""
