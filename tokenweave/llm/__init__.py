"""Training-data operators: fingerprints, personal data, quality, language model,
chat formatting, decontamination, mixing, suffix dedup, WARC, SimHash, prefix trie, language and dataset manifest.

Nothing else in the package imports this subpackage.
"""
