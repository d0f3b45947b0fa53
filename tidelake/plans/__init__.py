"""What to read: predicates, file pruning, grouping of files by how they are read."""
