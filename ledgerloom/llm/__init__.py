"""Training-data operators: packing, archives, decontamination, deduplication, scans, search, extraction, language ID."""
