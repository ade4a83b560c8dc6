"""Training-data preparation: deduplication, decontamination, filters, tokens, chat text and sharding."""
