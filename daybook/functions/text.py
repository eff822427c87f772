"""String cleaning and tagged-message parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the regular expression class \s stands for.
WHITESPACE = " \t\n\x0b\f\r"


def normalize_symbol(symbol: Column) -> Column:
    """Upper-case a symbol with every whitespace character deleted."""
    return F.upper(F.translate(symbol, WHITESPACE, ""))


def clean_code(code: Column) -> Column:
    """Trim and upper-case a currency or side code."""
    return F.upper(F.trim(code))


def empty_to_null(text: Column) -> Column:
    """Trim; what is blank afterwards becomes NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def is_blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def is_not_currency(code: Column) -> Column:
    """A currency is any three characters."""
    return code.isNull() | (F.length(code) != 3)


def delimited(message: Column) -> Column:
    """A message with a separator in front, so that every field has one."""
    return F.concat(F.lit("|"), message)


def tag_position(fields: Column, tag: str) -> Column:
    """Where ``|tag=`` first occurs in a delimited message; 0 if it does not."""
    return F.locate(f"|{tag}=", fields)


def tag_value(fields: Column, position: Column, tag: str) -> Column:
    """Text of the field found at ``position``, up to the next separator."""
    start = position + len(f"|{tag}=")
    return F.when(position > 0, F.substring_index(F.substr(fields, start), "|", 1))


def extract_tag(message: Column, tag: str) -> Column:
    """Value of the first ``tag=`` field of a ``|``-separated message, or NULL.

    Searching for the literal ``|tag=`` is cheaper than a regular expression.
    """
    fields = delimited(message)
    return empty_to_null(tag_value(fields, tag_position(fields, tag), tag))


def truncate_text(text: Column, length: int = 5000) -> Column:
    return F.substring(text, 1, length)
