"""Training-data operators: filtering, deduplication, scoring, sharding, mixing and tokenising of text corpora."""
