from clickflow.operators.lookup import dim_join, dim_lookup
from clickflow.operators.predicates import non_blank
from clickflow.operators.salting import HeavyKeys, heavy_keys
from clickflow.operators.sizes import broadcast_bytes, if_small
from clickflow.operators.tables import cached, cached_view, register, row_count
from clickflow.operators.topk import group_top, group_top_list, group_top_selected, top_by
from clickflow.operators.words import STOP_TOKENS, drop_stop, lines_of, word_count, words

__all__ = [
    "HeavyKeys",
    "STOP_TOKENS",
    "broadcast_bytes",
    "cached",
    "cached_view",
    "dim_join",
    "dim_lookup",
    "drop_stop",
    "group_top",
    "group_top_list",
    "group_top_selected",
    "heavy_keys",
    "if_small",
    "lines_of",
    "non_blank",
    "register",
    "row_count",
    "top_by",
    "word_count",
    "words",
]
