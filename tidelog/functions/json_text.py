"""Strict JSON and extended-JSON handling as built-in column expressions.

Spark's JSON functions ignore text after the first value. To accept exactly one
value, the text is wrapped into an array together with an end marker: only if
the marker comes back as the second and last element did the parser consume
everything before it. ``from_json`` with a fixed schema does the check and the
extraction in one pass over the text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tidelog.functions.rows import never

END_MARK = "␞"
_STRICT = {"allowSingleQuotes": "false"}

# A JSON string; the possessive loops keep long strings off the call stack.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# The look-ahead keeps broken JSON broken: a value must be followed by one of these.
_AFTER = r"(?=\s*(?:[,\]}]|$))"

# The single-key wrappers of MongoDB extended JSON as (markers,
# pattern, replacement), numbers first because a date may hold one. Each pattern
# starts at an unescaped quote after "{", which cannot occur inside a JSON
# string, and demands "}" right after the value, so objects with further keys
# stay as they are. Groups of the branch not taken are empty in a replacement.
_WRAPPERS = (
    (
        ('"$number',),
        r'\{\s*"\$number(?:(?:Long|Int)"\s*:\s*"?\s*(?:\+|(-))?0*(\d+)'
        r'|Decimal"\s*:\s*"?\s*(?:\+|(-))?0*(\d+(?:\.\d+)?(?:[eE][+-]?\d+)?))\s*"?\s*\}' + _AFTER,
        " $1$2$3$4 ",
    ),
    # Decimals that JSON has no number for stay texts, which the numeric fields read.
    (
        ('"$numberDecimal',),
        r'\{\s*"\$numberDecimal"\s*:\s*"\s*\+?(-?(?:(?:\d*\.\d+|\d+\.)(?:[eE][+-]?\d+)?|(?i:infinity|inf|nan)))\s*"\s*\}' + _AFTER,
        ' "$1" ',
    ),
    (
        ('"$oid', '"$date'),
        r'\{\s*"\$(?:oid"\s*:\s*(' + _STRING + r')'
        r'|date"\s*:\s*(?:(-?\d+)(?:\.\d*)?|(' + _STRING + r')))\s*\}' + _AFTER,
        " $1$2$3 ",
    ),
)
_BAD_NUMBER = r'\{\s*"\$number(?:Long|Int|Decimal)"\s*:\s*(?:' + _STRING + r'|[^",{}\[\]]*+)\s*\}'

# A decimal number as Python's float() reads it, without the type suffixes Java allows.
NUMBER_TEXT = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"


def utf8_text(binary: Column) -> Column:
    """Bytes as text, null when they are not valid UTF-8."""
    text = binary.cast("string")
    return F.when(F.is_valid_utf8(text), text)


def parse_object(text: Column, names: Sequence[str]) -> Column:
    """Parse exactly one JSON object into text fields, for :func:`object_or_null`.

    A field is null when missing or JSON null, and JSON text when nested. Of
    repeated keys the last one counts.
    """
    return read_object(object_text(text), names)


def object_text(text: Column) -> Column:
    """What :func:`read_object` reads, as a column of its own.

    Spark interprets whatever stands inside ``from_json``, with a look-up by name for each UTF-8 test; pinned
    (functions.rows.never), it is compiled like other columns.
    """
    return F.when(~never(), F.concat(F.lit("["), text, F.lit(f',{{"{END_MARK}":"{END_MARK}"}}]')))


def read_object(wrapped: Column, names: Sequence[str]) -> Column:
    fields = [StructField(n, StringType()) for n in (*names, END_MARK)]
    return F.from_json(wrapped, ArrayType(StructType(fields)), _STRICT)


def object_or_null(parsed: Column) -> Column:
    """The struct of a :func:`parse_object` result, null unless the text was one object and nothing else."""
    whole = (F.size(parsed) == 2) & (F.get(parsed, F.lit(1))[END_MARK] == END_MARK)
    return F.when(whole, F.get(parsed, F.lit(0)))


def parse_value(text: Column) -> Column:
    """Parse exactly one JSON value of any kind, for :func:`value_or_null`."""
    return F.from_json(F.concat(F.lit("["), text, F.lit(f',"{END_MARK}"]')), ArrayType(StringType()), _STRICT)


def value_or_null(parsed: Column) -> Column:
    """Text of the value of a :func:`parse_value` result, null unless it was the only one."""
    whole = (F.size(parsed) == 2) & (F.get(parsed, F.lit(1)) == END_MARK)
    return F.when(whole, F.get(parsed, F.lit(0)))


def is_empty_object(text: Column) -> Column:
    # A quote tells sooner than the expression that there are entries.
    return F.when(text.contains('"'), False).otherwise(text.rlike(r"^\s*\{\s*\}\s*$"))


def has_bad_number(text: Column) -> Column:
    """A number wrapper that did not turn into a number."""
    return F.when(text.contains('"$number'), text.rlike(_BAD_NUMBER)).otherwise(False)


def coerce_extended(df: DataFrame, column: str) -> DataFrame:
    """Unwrap extended-JSON values at any depth of the JSON text in ``column``.

    One projection per wrapper kind, so the second reads the text left by the
    first instead of repeating it. The cheap substring tests spare documents
    without a wrapper the regular expressions; a usual document runs one.
    """
    for markers, pattern, replacement in _WRAPPERS:
        text = F.col(column)
        present = text.contains(markers[0])
        for marker in markers[1:]:
            present = present | text.contains(marker)
        df = df.withColumn(column, F.when(present, F.regexp_replace(text, pattern, replacement)).otherwise(text))
    return df


def number_or_null(text: Column) -> Column:
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
