"""DataFrame-to-DataFrame operators of the catalog pipeline."""
