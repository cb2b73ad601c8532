"""Queries of the subpackage: ``QUERIES[name](spark, sf_dir)`` and ``ORACLE``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .exact_topk import OP11_SQL, op11_topk
from .fill_middle import OP13_SQL, op13_fill_middle
from .jaccard_join import OP9_SQL, op9_jaccard_join
from .language import op3_language
from .mixing import op1_mixing
from .near_vectors import OP2_SQL, op2_near_vectors
from .neighbour_graph import op5_neighbours
from .orchard import OP12_SQL, op12_orchard
from .substring_dedup import op6_substring_dedup
from .token_counts import op10_token_counts
from .token_file import op7_token_file
from .url_filter import op4_url_filter
from .word_table import op8_bpe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_near_vectors": op2_near_vectors,
    "op3_language": op3_language,
    "op4_url_filter": op4_url_filter,
    "op5_neighbours": op5_neighbours,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_file": op7_token_file,
    "op8_bpe": op8_bpe,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_token_counts": op10_token_counts,
    "op11_topk": op11_topk,
    "op12_orchard": op12_orchard,
    "op13_fill_middle": op13_fill_middle,
}
ORACLE: dict[str, str] = {
    "op2_near_vectors": OP2_SQL,
    "op9_jaccard_join": OP9_SQL,
    "op11_topk": OP11_SQL,
    "op12_orchard": OP12_SQL,
    "op13_fill_middle": OP13_SQL,
}
