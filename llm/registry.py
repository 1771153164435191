"""The registered queries of this subpackage and their DuckDB oracles."""

import corpus_pipeline
from llm import (
    content_sort_dedup,
    grouped_packing,
    hilbert_shards,
    language_id,
    metric_tree,
    order_minhash,
    periodic_runs,
    prefix_trie,
    secret_scan,
    source_mix,
    suffix_dedup,
    warc_index,
    weighted_minhash,
)

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_hilbert_shards": hilbert_shards.op3_hilbert_shards,
    "op4_content_sort_dedup": content_sort_dedup.op4_content_sort_dedup,
    "op5_grouped_packing": grouped_packing.op5_grouped_packing,
    "op6_weighted_minhash": weighted_minhash.op6_weighted_minhash,
    "op7_source_mix": source_mix.op7_source_mix,
    "op8_metric_tree": metric_tree.op8_metric_tree,
    "op9_warc_index": warc_index.op9_warc_index,
    "op10_language_id": language_id.op10_language_id,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_order_minhash": order_minhash.op12_order_minhash,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}

# Where SQL can't express a query, tests/llm holds it against brute force.
ORACLES = {
    "op1_secret_scan": secret_scan.ORACLE,
    "op2_suffix_dedup": suffix_dedup.ORACLE,
    "op3_hilbert_shards": hilbert_shards.ORACLE,
    "op4_content_sort_dedup": content_sort_dedup.ORACLE,
    "op7_source_mix": source_mix.ORACLE,
    "op8_metric_tree": metric_tree.ORACLE,
    "op9_warc_index": warc_index.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op13_periodic_runs": periodic_runs.ORACLE,
}
