"""Training-data operators; nothing outside this subpackage imports them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import (
        chat, decontamination, fill_middle, html_extract, lattice_lm, lz_fingerprint, mixing, near_dup, prefix_trie, suffix_dedup, token_counts, top_k, toxicity,
    )

    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_suffix_array_dedup": suffix_dedup.op2_suffix_array_dedup,
        "op3_token_counts": token_counts.op3_token_counts,
        "op4_benchmark_decontamination": decontamination.op4_benchmark_decontamination,
        "op5_minhash_near_dedup": near_dup.op5_minhash_near_dedup,
        "op6_html_extraction": html_extract.op6_html_extraction,
        "op7_lz_fingerprint": lz_fingerprint.op7_lz_fingerprint,
        "op8_source_mixing": mixing.op8_source_mixing,
        "op10_lattice_lm": lattice_lm.op10_lattice_lm,
        "op9_chat_formatting": chat.op9_chat_formatting,
        "op11_exact_top_k": top_k.op11_exact_top_k,
        "op12_fill_in_middle": fill_middle.op12_fill_in_middle,
        "op13_prefix_trie": prefix_trie.op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    from . import chat, decontamination, fill_middle, near_dup, prefix_trie, top_k

    return {
        "op4_benchmark_decontamination": decontamination.ORACLE,
        "op5_minhash_near_dedup": near_dup.ORACLE,
        "op9_chat_formatting": chat.ORACLE,
        "op11_exact_top_k": top_k.ORACLE,
        "op12_fill_in_middle": fill_middle.ORACLE,
        "op13_prefix_trie": prefix_trie.ORACLE,
    }
