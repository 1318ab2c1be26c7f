"""Training-data operators: line and document dedup, search, secrets, quality,
toxicity, tokenising, packing, archives and chat formatting."""
