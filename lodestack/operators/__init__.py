"""DataFrame operators, one module for each field of work."""
