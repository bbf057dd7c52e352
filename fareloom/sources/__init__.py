"""Table schemas, readers, writers and the ride views over the supplied tables."""
