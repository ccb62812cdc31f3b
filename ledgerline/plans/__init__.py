"""Composite jobs, derived inputs and the registered query catalog."""
