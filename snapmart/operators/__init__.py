"""Frame-in, frame-out operators."""
