"""Training-data operators: token counts, near-duplicate and substring
removal, BPE, sharding, quality rules and classifier, nearest neighbours and
packing. Nothing else in the library imports this subpackage."""
