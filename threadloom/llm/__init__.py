"""Training-data operators: mixing, decontamination, token output, PII, toxicity, nearest neighbours,
URL filters, WARC, substring dedup and SimHash near-dedup. Nothing else in the library imports this package."""
