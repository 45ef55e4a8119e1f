"""Training-data operators: deduplication, filtering, tokens, archives and transcripts."""
