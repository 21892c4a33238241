"""Training-data operators: sharding, toxicity, licences, WARC, token files,
URL filtering, embedding and MinHash near-dedup, decontamination, packing.
Nothing else in the library imports this subpackage."""
