"""Training-data operators: sharding, near-duplicates, packing, span removal, chat, mixing, quality, licences, fingerprints, rules."""
