"""Column functions: names, ids, markers, keys and classes."""
