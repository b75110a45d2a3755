"""Queries of the training-data operators, by name, and the DuckDB SQL that states their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .ann import op8_multiprobe_ann
from .decontaminate import OP7_SQL, op7_decontaminate
from .html_text import op10_html_text
from .license_scan import op2_license_scan
from .merkle import OP12_SQL, op12_merkle_manifest
from .mixing import OP9_SQL, op9_mix_sources
from .ngram_jaccard import OP5_SQL, op5_ngram_jaccard_join
from .packing import op13_best_fit_packing
from .quality_kn import op6_quality_kn
from .runs import op11_runs
from .substring_dedup import op1_substring_dedup
from .toxicity import op3_toxicity
from .trie_lm import op4_trie_lm

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_toxicity": op3_toxicity,
    "op4_trie_lm": op4_trie_lm,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_quality_kn": op6_quality_kn,
    "op7_decontaminate": op7_decontaminate,
    "op8_multiprobe_ann": op8_multiprobe_ann,
    "op9_mix_sources": op9_mix_sources,
    "op10_html_text": op10_html_text,
    "op11_runs": op11_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_best_fit_packing": op13_best_fit_packing,
}

ORACLES: dict[str, str] = {
    "op5_ngram_jaccard_join": OP5_SQL,
    "op7_decontaminate": OP7_SQL,
    "op9_mix_sources": OP9_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
