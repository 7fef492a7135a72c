"""Sinks of the document analytics engine."""
