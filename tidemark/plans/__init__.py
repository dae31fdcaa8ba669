"""Jobs composed from operators, sources and sinks."""
