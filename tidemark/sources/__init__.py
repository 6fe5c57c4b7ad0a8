"""Sources: text lines, record parsers, in-memory rows, socket and broker streams."""
