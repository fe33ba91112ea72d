"""Column-to-Column functions: text cleaning, value parsers, JSON and arrays."""
