"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm.contract_sql import filter_audit_sql, near_duplicates_sql, prefix_trie_sql, repeated_bytes_sql, repeated_words_sql
from ledgerlake.llm.filter_audit import op13_filter_audit
from ledgerlake.llm.fixed_blocks import op8_fixed_blocks
from ledgerlake.llm.html_mincut import op1_html_mincut
from ledgerlake.llm.kd_shards import op10_kd_shards
from ledgerlake.llm.language import op6_language
from ledgerlake.llm.multiprobe_lsh import op4_multiprobe_lsh
from ledgerlake.llm.ngram_join import op7_ngram_join
from ledgerlake.llm.packing import op9_packing
from ledgerlake.llm.pii_bootstrap import op12_pii_bootstrap
from ledgerlake.llm.prefix_trie import op11_prefix_trie
from ledgerlake.llm.spaced_seeds import op5_spaced_seeds
from ledgerlake.llm.suffix_array import op2_suffix_array
from ledgerlake.llm.url_markov import op3_url_markov

#: Each operator's query with the table it covers.
OPERATORS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "op1_html_mincut": (op1_html_mincut, ("pages",)),
    "op2_suffix_array": (partial(op2_suffix_array, by_id=True), ("documents",)),
    "op3_url_markov": (op3_url_markov, ("pages",)),
    "op4_multiprobe_lsh": (op4_multiprobe_lsh, ("embeddings",)),
    "op5_spaced_seeds": (op5_spaced_seeds, ("documents", "benchmark")),
    "op6_language": (op6_language, ("documents",)),
    "op7_ngram_join": (op7_ngram_join, ("documents",)),
    "op8_fixed_blocks": (op8_fixed_blocks, ("documents",)),
    "op9_packing": (op9_packing, ("documents",)),
    "op10_kd_shards": (op10_kd_shards, ("documents",)),
    "op11_prefix_trie": (op11_prefix_trie, ("conversations",)),
    "op12_pii_bootstrap": (op12_pii_bootstrap, ("documents",)),
    "op13_filter_audit": (op13_filter_audit, ("documents", "labels")),
}


def _query(operator: Callable[..., DataFrame], tables: tuple[str, ...]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))


QUERIES = {name: _query(*x) for name, x in OPERATORS.items()}
#: What SQL can state over whole tables; tests/llm holds brute-force versions of the others.
SQL: dict[str, str] = {
    "op2_suffix_array": repeated_bytes_sql(),
    "op7_ngram_join": near_duplicates_sql(),
    "op8_fixed_blocks": repeated_words_sql(),
    "op11_prefix_trie": prefix_trie_sql(),
    "op13_filter_audit": filter_audit_sql(),
}
