from shopflow.functions.columns import (
    STEP_BUCKETS, VISIT_BUCKETS, concat_distinct, first_seen_join, half_up_ratio, int_div,
    half_up_text, id_list, pad2, render_times, trim_edge_commas)

__all__ = ["VISIT_BUCKETS", "STEP_BUCKETS", "half_up_ratio", "int_div", "half_up_text",
           "first_seen_join", "concat_distinct", "id_list", "trim_edge_commas",
           "pad2", "render_times"]
