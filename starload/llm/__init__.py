"""Training-data operators: duplicates, tokens, packing, quality, pages, URLs, vectors, benchmark leaks."""
