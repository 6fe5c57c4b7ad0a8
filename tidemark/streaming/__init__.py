"""Streaming forms.

Word counts, window counts and window means are the batch operators: they take a stream as they
take a table. Here are event time, and the operators that need keyed state: running counts per
record, patterns, gates and the first rows of a window.

A stream ends only windows and waits the watermark has passed. What a bounded input leaves open is
finished from its checkpoint by `flush`.
"""
