"""DataFrame operators: lines, walks, positions, checkpoints, batches, delivery, metrics, audit."""
