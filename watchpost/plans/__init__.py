"""How models are put together: the star schema, its declared checks, the rebuild."""
