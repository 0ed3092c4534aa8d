"""Training-data operators: packing, near-duplicates, classifiers, search, scans, mixing, chat."""
