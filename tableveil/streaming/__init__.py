"""Jobs over streams."""
