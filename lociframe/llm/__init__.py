"""Training-data operators: packing, tokenised output, deduplication, mixing, filtering and redaction."""
