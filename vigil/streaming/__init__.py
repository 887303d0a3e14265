"""vigil.streaming."""
