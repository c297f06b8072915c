"""Training-data operators (deduplication, search, filtering, tokenising); nothing else in the library imports this."""
