"""Cleaning of dirty text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: marks "not available" in the yearly rating files.
NOT_AVAILABLE = "n.d."
# Text left over from turning missing cells into strings.
NULL_WORDS = ["nan", "None", "none"]
# State code by the first two digits of a municipality code.
STATE_BY_PREFIX = {
    "11": "RO", "12": "AC", "13": "AM", "14": "RR", "15": "PA", "16": "AP", "17": "TO",
    "21": "MA", "22": "PI", "23": "CE", "24": "RN", "25": "PB", "26": "PE", "27": "AL",
    "28": "SE", "29": "BA",
    "31": "MG", "32": "ES", "33": "RJ", "35": "SP",
    "41": "PR", "42": "SC", "43": "RS",
    "50": "MS", "51": "MT", "52": "GO", "53": "DF",
}

# All white space, not only blanks.
SPACES = " \t\n\r\x0b\x0c\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
NUMBER_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: str | Column) -> Column:
    """Trim all white space (not only blanks) at both ends."""
    return F.trim(_column(value), F.lit(SPACES))


def null_if_in(value: str | Column, *tokens: str) -> Column:
    """NULL when the text equals one of the tokens."""
    value = _column(value)
    return F.when(~value.isin(*tokens), value)


def safe_double(value: str | Column) -> Column:
    """Text to double, NULL for anything that is not a plain number.

    The pattern keeps out forms such as '1d' that the cast alone would accept.
    """
    value = _column(value)
    return F.when(value.rlike(NUMBER_PATTERN), value.try_cast("double"))


def decimal_comma(value: str | Column) -> Column:
    """Indicator text with a decimal comma to double.

    'n.d.' and '' are no numbers, so they become NULL like any other text.
    """
    return safe_double(F.replace(strip(_column(value).cast("string")), F.lit(","), F.lit(".")))


def grade(value: str | Column, *tokens: str) -> Column:
    """Upper-case trimmed grade; the tokens are nulled before trimming."""
    return F.upper(strip(null_if_in(_column(value).cast("string"), *tokens)))


def integer_text(value: str | Column) -> Column:
    """'7037.0' -> '7037'; text that is not a plain number stays as it is."""
    value = _column(value)
    # Digits with at most one '.' and one '-', wherever they stand.
    digits = F.regexp_replace(F.regexp_replace(value, r"^([^.]*)\.", "$1"), r"^([^-]*)-", "$1")
    whole = value.try_cast("double").try_cast("bigint").cast("string")
    return F.when(digits.rlike("^[0-9]+$"), F.coalesce(whole, value)).otherwise(value)


def blank_null_words(value: str | Column) -> Column:
    """Left-over null words and real NULLs become the empty string."""
    value = _column(value)
    return F.when(value.isNull() | value.isin(*NULL_WORDS), "").otherwise(value)


def label_map(value: str | Column, labels: dict, default=None) -> Column:
    """A simple CASE: the label of each value, else the default."""
    value = _column(value)
    chain = None
    for key, label in labels.items():
        chain = F.when(value == key, label) if chain is None else chain.when(value == key, label)
    return chain.otherwise(default)


def state_from_code(code: str | Column) -> Column:
    """State of a municipality code by its first two digits; unknown -> NULL."""
    return label_map(F.substring(_column(code).cast("string"), 1, 2), STATE_BY_PREFIX)
