"""Training-data operators: deduplication, scanning, packing, sharding and materialisation of text corpora."""
