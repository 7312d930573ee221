"""Training-data operators: search, archives, deduplication, tokens, sharding, quality, chat, packing."""
