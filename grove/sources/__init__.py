"""Text and table sources and sinks."""
