"""Sources: JSON lines and documents, id lists, tables with byte-order marks, tar shards."""
