"""Operators for a training-data pipeline. Nothing outside this subpackage imports it.

Thirteen numbered operators, each in its own module, plus their registered queries in ``queries.py``:

1 ``multi_index``      nearest neighbours by an inverted multi-index
2 ``simhash``          near-duplicates by tiled exact SimHash comparison
3 ``multiset_hash``    homomorphic document fingerprints
4 ``suffix_dedup``     repeated windows by a depth-limited radix sort
5 ``license_scan``     licence templates by Dice coefficient
6 ``word_bpe``         batched numpy BPE encoding and decoding
7 ``toxicity``         TF-IDF neighbours over a block-max index
8 ``feistel_shards``   reproducible shuffle and sharding
9 ``length_packing``   optimal length buckets and token-budget batches
10 ``lm_difference``   cross-entropy difference of two n-gram models
11 ``lexical_search``  ranked search by an Aho-Corasick scan of the documents
12 ``repetition``      quality rules from a suffix array of each text's words
13 ``merkle_manifest`` Merkle manifest and proofs by descent of its records
"""
