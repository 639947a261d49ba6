"""Training-data operators: token counts, near-duplicates, sharding, quality, archives, mixing, personal data, toxicity, segmentation."""
