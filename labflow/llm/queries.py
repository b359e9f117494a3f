"""Every query of this folder by name, and the SQL of those that SQL can express."""

from labflow.llm import (
    queries_documents,
    queries_merkle,
    queries_pii,
    queries_secrets,
    queries_sharding,
    queries_tokens,
    queries_toxicity,
    queries_vectors,
    queries_warc,
    queries_whitening,
)

QUERIES = {
    "op1_gated_network_toxicity": queries_toxicity.op1_gated_network_toxicity,
    "op2_markov_secrets": queries_secrets.op2_markov_secrets,
    "op3_bpe_round_trip": queries_tokens.op3_bpe_round_trip,
    "op4_one_bit_neighbours": queries_vectors.op4_one_bit_neighbours,
    "op5_bag_minhash_duplicates": queries_documents.op5_bag_minhash_duplicates,
    "op6_cap_filter_duplicates": queries_vectors.op6_cap_filter_duplicates,
    "op7_binary_pieces": queries_tokens.op7_binary_pieces,
    "op8_byte_shards": queries_sharding.op8_byte_shards,
    "op9_token_counts": queries_tokens.op9_token_counts,
    "op10_dictionary_archives": queries_warc.op10_dictionary_archives,
    "op11_interval_manifest": queries_merkle.op11_interval_manifest,
    "op12_boosted_private_spans": queries_pii.op12_boosted_private_spans,
    "op13_polarised_whitening": queries_whitening.op13_polarised_whitening,
}

SQL = {
    "op4_one_bit_neighbours": queries_vectors.OP4_SQL,
    "op6_cap_filter_duplicates": queries_vectors.OP6_SQL,
    "op8_byte_shards": queries_sharding.OP8_SQL,
    "op10_dictionary_archives": queries_warc.OP10_SQL,
    "op11_interval_manifest": queries_merkle.OP11_SQL,
}
