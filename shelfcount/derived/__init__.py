"""Library-shaped tables derived from the star-schema test tables, with queries over them."""
