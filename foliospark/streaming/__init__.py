"""Live sources read as streams."""
