"""Where chunks come from and where batches go."""
