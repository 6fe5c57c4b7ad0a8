"""Behaviour analytics on Spark: event and text operators as DataFrame functions."""

__version__ = "0.1.0"
