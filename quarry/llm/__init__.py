"""Training-data operators: extraction, archives, near-duplicates, scoring,
packing, tokenising, vector search and privacy, each as Spark jobs."""
