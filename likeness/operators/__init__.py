"""DataFrame operators: segments, matches, labels, aggregates, samples."""
