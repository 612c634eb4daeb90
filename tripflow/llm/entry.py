"""Queries of this folder for the driver, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripflow.llm.byte_bpe import op8_byte_bpe
from tripflow.llm.decontaminate import op4_decontaminate_prefix_join
from tripflow.llm.language_id import op2_language_hyperdimensional
from tripflow.llm.license_scan import ORACLE as LICENSE_SQL
from tripflow.llm.license_scan import op3_license_digests
from tripflow.llm.line_dedup import ORACLE as LINE_SQL
from tripflow.llm.line_dedup import op10_line_templates
from tripflow.llm.ngram_join import op6_ngram_jaccard_join
from tripflow.llm.periodic_runs import op11_periodic_runs
from tripflow.llm.pii import op1_pii_skip_chain
from tripflow.llm.prefix_trie import op13_rollup_trie
from tripflow.llm.quality import op5_quality_subword
from tripflow.llm.sharding import op12_feistel_shards
from tripflow.llm.token_counts import op7_token_counts
from tripflow.llm.topk import ORACLE as TOPK_SQL
from tripflow.llm.topk import op9_topk_uniform_threshold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii_skip_chain,
        op2_language_hyperdimensional,
        op3_license_digests,
        op4_decontaminate_prefix_join,
        op5_quality_subword,
        op6_ngram_jaccard_join,
        op7_token_counts,
        op8_byte_bpe,
        op9_topk_uniform_threshold,
        op10_line_templates,
        op11_periodic_runs,
        op12_feistel_shards,
        op13_rollup_trie,
    )
}

ORACLE: dict[str, str] = {
    "op3_license_digests": LICENSE_SQL,
    "op9_topk_uniform_threshold": TOPK_SQL,
    "op10_line_templates": LINE_SQL,
}
