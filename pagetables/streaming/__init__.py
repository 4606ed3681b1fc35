"""Documents as they arrive."""
