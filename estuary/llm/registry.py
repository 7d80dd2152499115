"""The operators' registered queries and, where SQL can say it, their SQL."""

from __future__ import annotations

from estuary.llm.bpe import op2_bpe
from estuary.llm.fingerprints import op6_fingerprints
from estuary.llm.licenses import OP7_SQL, op7_license_scan
from estuary.llm.merkle import OP11_SQL, op11_merkle_manifest
from estuary.llm.near_dedup import OP4_SQL, op4_minhash_dedup
from estuary.llm.neighbours import OP8_SQL, op8_learned_partitions
from estuary.llm.packing import op10_packing
from estuary.llm.pii import op3_pii
from estuary.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from estuary.llm.secret_scan import op12_secret_scan
from estuary.llm.suffix_dedup import op5_suffix_dedup
from estuary.llm.token_output import op1_token_output
from estuary.llm.toxicity import op9_toxicity

QUERIES = {
    "op1_token_output": op1_token_output,
    "op2_bpe": op2_bpe,
    "op3_pii": op3_pii,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_fingerprints": op6_fingerprints,
    "op7_license_scan": op7_license_scan,
    "op8_learned_partitions": op8_learned_partitions,
    "op9_toxicity": op9_toxicity,
    "op10_packing": op10_packing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_secret_scan": op12_secret_scan,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op4_minhash_dedup": OP4_SQL,
    "op7_license_scan": OP7_SQL,
    "op8_learned_partitions": OP8_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}
