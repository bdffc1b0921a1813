"""Column expressions used by the operators and plans."""

from vitalgauge.functions.scalars import (
    SCORE_BANDS,
    array_not_empty,
    band_score,
    case_flag,
    coalesce_first,
    concat_label,
    contains_text,
    date_parts,
    days_before,
    exact_ratio,
    format_month,
    json_path,
    months_before,
    normalize_department,
    plan_key,
    plan_keys,
    round_arr,
    safe_ratio,
    strip_id_prefix,
    sum_columns,
    text_not_empty,
    third_token,
    year_month_label,
)

__all__ = [
    "SCORE_BANDS", "array_not_empty", "band_score", "case_flag", "coalesce_first", "concat_label",
    "contains_text", "date_parts", "days_before", "exact_ratio", "format_month", "json_path", "months_before",
    "normalize_department", "plan_key", "plan_keys", "round_arr", "safe_ratio", "strip_id_prefix",
    "sum_columns", "text_not_empty", "third_token", "year_month_label",
]
