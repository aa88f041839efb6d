"""Training-data operators: dedup, extraction, decontamination, token output,
fingerprints, segmentation sampling, licences, WARC and toxicity.

Nothing else in the library imports this subpackage."""
