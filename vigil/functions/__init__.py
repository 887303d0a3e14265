"""vigil.functions."""
