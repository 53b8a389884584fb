"""Products: silver cleaning, gold facts, dimensions, views, catalog, pipeline."""
