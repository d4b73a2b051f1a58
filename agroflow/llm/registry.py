"""The operators' queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agroflow.llm import oracles
from agroflow.llm.bpe import op13_trie_bpe
from agroflow.llm.decontamination import op8_seeded_alignment
from agroflow.llm.filter_audit import op12_filter_potential
from agroflow.llm.language import op1_language_fusion
from agroflow.llm.licenses import op7_license_index
from agroflow.llm.packing import op2_best_fit_packing
from agroflow.llm.ranked import op11_norm_buckets
from agroflow.llm.repeats import op3_lyndon_repeats
from agroflow.llm.secrets import op5_secret_linking
from agroflow.llm.simhash import op9_simhash_golay
from agroflow.llm.sketches import op6_scaled_sketch
from agroflow.llm.toxicity import op4_toxicity_channel
from agroflow.llm.urls import op10_url_words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_fusion": op1_language_fusion,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_lyndon_repeats": op3_lyndon_repeats,
    "op4_toxicity_channel": op4_toxicity_channel,
    "op5_secret_linking": op5_secret_linking,
    "op6_scaled_sketch": op6_scaled_sketch,
    "op7_license_index": op7_license_index,
    "op8_seeded_alignment": op8_seeded_alignment,
    "op9_simhash_golay": op9_simhash_golay,
    "op10_url_words": op10_url_words,
    "op11_norm_buckets": op11_norm_buckets,
    "op12_filter_potential": op12_filter_potential,
    "op13_trie_bpe": op13_trie_bpe,
}

ORACLES: dict[str, str] = {
    "op5_secret_linking": oracles.SECRETS,
    "op11_norm_buckets": oracles.RANKED_SEARCH,
    "op12_filter_potential": oracles.FILTER_AUDIT,
}
