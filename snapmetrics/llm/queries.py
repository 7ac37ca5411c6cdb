"""The registered queries of the llm operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snapmetrics.llm.alignment import op12_alignment
from snapmetrics.llm.ann import op7_ann
from snapmetrics.llm.bpe import op8_bpe
from snapmetrics.llm.jaccard import op5_jaccard
from snapmetrics.llm.lines import op2_line_dedup
from snapmetrics.llm.oracle import ORACLE_SQL
from snapmetrics.llm.packing import op1_packing
from snapmetrics.llm.pii import op4_pii
from snapmetrics.llm.quality_fm import op6_quality
from snapmetrics.llm.rules import op9_host_rules
from snapmetrics.llm.substrings import op3_substring_dedup
from snapmetrics.llm.superkmers import op11_super_kmers
from snapmetrics.llm.tries import op13_prefix_trie
from snapmetrics.llm.warc import op10_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_line_dedup,
        op3_substring_dedup,
        op4_pii,
        op5_jaccard,
        op6_quality,
        op7_ann,
        op8_bpe,
        op9_host_rules,
        op10_warc,
        op11_super_kmers,
        op12_alignment,
        op13_prefix_trie,
    )
}

__all__ = ["ORACLE_SQL", "QUERIES"]
