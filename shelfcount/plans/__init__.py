"""Reports and lookups put together from the operators."""
