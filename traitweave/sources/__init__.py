"""Participant tables in, results out."""
