"""Training-data operators: packing, near-duplicates, sharding, secrets, fixity, tokenizers, fingerprints, toxicity and chat."""
