"""Training-data operators: token output, BPE, PII, deduplication,
fingerprints, licence scans, nearest neighbours, toxicity, packing, Merkle
manifests, secret scans and conversation tries.

Every operator takes DataFrames and returns DataFrames; nothing outside this
subpackage imports it.
"""
