"""Training-data operators: filtering, deduplication, packing, archives and binary token files."""
