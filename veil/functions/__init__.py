"""Column functions. Each takes and returns ``Column``; none needs a session."""
