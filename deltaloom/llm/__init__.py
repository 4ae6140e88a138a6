"""Training-data operators: quality, near duplicates, mixing, substrings, packing, search, PII, scoring, licences."""
