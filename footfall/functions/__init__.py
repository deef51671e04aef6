"""Scalar and aggregate helpers, each returning a Column built from Spark's own functions."""

from footfall.functions.dates import (
    after,
    before,
    date_hour,
    format_date,
    format_time,
    parse_time,
    seconds_between,
    today,
    yesterday,
)
from footfall.functions.numbers import divide_down, ratio, round_half_up
from footfall.functions.text import (
    comma_list,
    concat_field_get,
    concat_field_set,
    concat_long_string,
    concat_record,
    group_concat_distinct,
    is_empty,
    is_not_empty,
    json_field,
    pad_two,
    register_sql_functions,
    split_parts,
    trim_comma,
)

__all__ = [
    "after",
    "before",
    "comma_list",
    "concat_field_get",
    "concat_field_set",
    "concat_long_string",
    "concat_record",
    "date_hour",
    "divide_down",
    "format_date",
    "format_time",
    "group_concat_distinct",
    "is_empty",
    "is_not_empty",
    "json_field",
    "pad_two",
    "parse_time",
    "ratio",
    "register_sql_functions",
    "round_half_up",
    "seconds_between",
    "split_parts",
    "today",
    "trim_comma",
    "yesterday",
]
