"""End-to-end loads composed of the sources, operators and sinks."""
