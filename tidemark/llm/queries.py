"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from functools import wraps

from tidemark.llm import (alignment, jaccard, lang_id, leaks, licenses, packing, pieces, ppm, repeats, sharding,
                          token_counts, topk, whitening)
from tidemark.llm.common import ship


def shipped(query):
    @wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {f.__name__: shipped(f) for f in (
    sharding.op1_extendible_hashing,
    repeats.op2_bucket_pointers,
    token_counts.op3_segment_trees,
    ppm.op4_partial_matching,
    lang_id.op5_language_filters,
    topk.op6_term_at_a_time,
    packing.op7_concatenate_cut,
    leaks.op8_seed_and_align,
    licenses.op9_signature_rules,
    jaccard.op10_vertical_partitions,
    pieces.op11_prefix_table,
    alignment.op12_merge_path,
    whitening.op13_cholesky_jacobi,
)}

ORACLE: dict[str, str] = {"op1_extendible_hashing": sharding.OP1_SQL, "op6_term_at_a_time": topk.OP6_SQL}
