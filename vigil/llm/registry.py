"""Queries of the package: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from vigil.llm import (bpe, collocations, dual_tree, exact_dedup, filter_audit, jaccard_join,
                       packing, pieces, quality_knn, sharding, suffix_dedup, superkmers,
                       url_filter)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_packing": packing.op3_packing,
    "op4_quality_knn": quality_knn.op4_quality_knn,
    "op5_dual_tree_top_k": dual_tree.op5_dual_tree_top_k,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_jaccard_join": jaccard_join.op7_jaccard_join,
    "op8_rendezvous_sharding": sharding.op8_rendezvous_sharding,
    "op9_superkmer_dedup": superkmers.op9_superkmer_dedup,
    "op10_bpe": bpe.op10_bpe,
    "op11_collocations": collocations.op11_collocations,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_sentencepiece": pieces.op13_sentencepiece,
}

ORACLE = {
    "op2_url_filter": url_filter.SQL,
    "op5_dual_tree_top_k": dual_tree.SQL,
    "op6_exact_dedup": exact_dedup.SQL,
    "op8_rendezvous_sharding": sharding.SQL,
    "op11_collocations": collocations.SQL,
    "op12_filter_audit": filter_audit.SQL,
}
