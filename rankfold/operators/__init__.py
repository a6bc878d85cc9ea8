"""DataFrame operators of the rating engine."""
