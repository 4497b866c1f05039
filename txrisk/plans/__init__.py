"""End-to-end stages and the registered query catalog."""
