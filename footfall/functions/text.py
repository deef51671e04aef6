"""Text, list and JSON expressions."""

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_empty(value) -> Column:
    value = _column(value)
    return value.isNull() | (value == "")


def is_not_empty(value) -> Column:
    return ~is_empty(value)


def trim_comma(value) -> Column:
    """Drop one comma at each end."""
    return F.regexp_replace(_column(value), r"^,|,\z", "")


def pad_two(value) -> Column:
    """Two characters stay as they are; any other text gets a leading ``0``."""
    value = _column(value)
    return F.when(F.length(value) == 2, value).otherwise(F.concat(F.lit("0"), value))


def split_parts(value) -> Column:
    """Parts of a comma text without the empty ones; NULL text gives NULL."""
    return F.filter(F.split(_column(value), ","), lambda part: part != "")


def comma_list(values) -> Column:
    """Sorted values of an array as comma text; no value gives ``''``.

    Numbers are put in order of value, not of their text.
    """
    return F.coalesce(F.array_join(F.array_sort(_column(values)).cast("array<string>"), ","), F.lit(""))


def concat_record(**fields) -> Column:
    """``name=value|name=value`` text of the given columns; a NULL value is written as empty."""
    parts = [F.concat(F.lit(f"{name}="), F.coalesce(_column(value).cast("string"), F.lit(""))) for name, value in fields.items()]
    return F.concat_ws("|", *parts)


def concat_field_get(record, field: str, delimiter: str = r"\|") -> Column:
    """Value of ``field`` in a ``name=value`` record text.

    NULL when the field is missing or empty, or when its part has more than one ``=``
    inside. ``=`` signs that end a part do not count. ``delimiter`` is a regular expression.
    """
    pairs = F.transform(
        F.split(_column(record), delimiter),
        lambda part: F.split(F.regexp_replace(part, r"=+\z", ""), "="),
    )
    match = F.filter(pairs, lambda pair: (F.size(pair) == 2) & (pair[0] == field))
    return F.get(F.get(match, F.lit(0)), F.lit(1))


def concat_field_set(record, field: str, value, delimiter: str = r"\|") -> Column:
    """Record text with the first part named ``field`` set to ``value``.

    A record without the field keeps its parts. Parts are joined by ``|`` whatever the
    delimiter was, and delimiters that end the text are dropped.
    """
    parts = F.split(F.regexp_replace(_column(record), rf"(?:{delimiter})+\z", ""), delimiter)
    names = F.transform(parts, lambda part: F.split(part, "=")[0])
    position = F.array_position(names, field)
    changed = F.transform(
        parts,
        lambda part, i: F.when(i + 1 == position, F.concat(F.lit(f"{field}="), value.cast("string"))).otherwise(part),
    )
    return F.array_join(changed, "|")


def concat_long_string(number, text, separator=":") -> Column:
    """``number``, separator and ``text`` in one text; a NULL is written as ``null``."""
    return F.concat(
        F.coalesce(_column(number).cast("string"), F.lit("null")),
        F.lit(separator),
        F.coalesce(_column(text), F.lit("null")),
    )


def group_concat_distinct(value) -> Column:
    """Aggregate: the distinct values of a group as sorted comma text."""
    return comma_list(F.collect_set(_column(value)))


def json_field(document, field: str) -> Column:
    """Top-level field of a JSON object text; NULL when the text is not JSON."""
    return F.get_json_object(_column(document), f"$['{field}']")


# SQL forms of the scalar helpers: SQL expressions, so no row leaves the JVM. The
# aggregate has no SQL form of its own, since a SQL function may not hold an
# aggregate; SQL users write listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x).
_SQL_FUNCTIONS = [
    """CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(number BIGINT, text STRING, separator STRING)
       RETURNS STRING
       RETURN concat(coalesce(cast(number AS STRING), 'null'), separator, coalesce(text, 'null'))""",
    """CREATE OR REPLACE TEMPORARY FUNCTION json_field(document STRING, field STRING)
       RETURNS STRING
       RETURN get_json_object(document, concat('$[\\'', field, '\\']'))""",
]


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``concat_long_string`` and ``json_field`` callable from SQL text."""
    for statement in _SQL_FUNCTIONS:
        spark.sql(statement)
