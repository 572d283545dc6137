from tradeweave.operators.entity import Rule, entity_match, entity_match_pairs, matched_keys
from tradeweave.operators.overlap import (
    common_rows,
    exclusive_rows,
    lookup_nested,
    overlap_split,
    top_rows_report,
)
from tradeweave.operators.partner import partner_products
from tradeweave.operators.ranking import tfidf_rank
from tradeweave.operators.relational import (
    aggregate,
    drop_null_rows,
    merge_rows,
    nest_key,
    order_by_price_text,
    price_key,
    render_json,
    render_text,
    select_available,
    select_mapped,
    top_k_federated,
    union_complete,
)
from tradeweave.operators.schema_match import (
    column_overlap,
    match_columns,
    mediated_mapping,
    mediated_union,
)
from tradeweave.operators.similarity_join import contained_words, overlap_pairs, substring_pairs

__all__ = [
    "Rule",
    "aggregate",
    "column_overlap",
    "common_rows",
    "contained_words",
    "drop_null_rows",
    "entity_match",
    "entity_match_pairs",
    "exclusive_rows",
    "lookup_nested",
    "match_columns",
    "matched_keys",
    "mediated_mapping",
    "mediated_union",
    "merge_rows",
    "nest_key",
    "order_by_price_text",
    "overlap_pairs",
    "overlap_split",
    "partner_products",
    "price_key",
    "render_json",
    "render_text",
    "select_available",
    "select_mapped",
    "substring_pairs",
    "tfidf_rank",
    "top_k_federated",
    "top_rows_report",
    "union_complete",
]
