"""Training-data operators: tokenizing, filtering, deduplication, packing and chat formatting."""
