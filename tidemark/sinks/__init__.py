"""Sinks: console, broker topics, and several tagged outputs of one stream."""
