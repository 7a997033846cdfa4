"""Text parsing: minutes, program types, first values, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions.measures import as_column

# Program codes and the words that select them, first match wins.
# A rule matches when the lower-cased name holds all words of one of its groups.
DELAY_TYPE_RULES = [
    ("GroundDelay", [["ground delay"], ["gdp"]]),
    ("GroundStop", [["ground stop"], ["gsp"]]),
    ("ArriveDepart", [["arrival", "departure"]]),
    ("Closure", [["closure"]]),
    ("Airspace", [["airspace"]]),
]
UNKNOWN_TYPE = "Unknown"
DELAY_TYPE_LENGTH = 30

# Patterns for hours, minutes and numbers inside free text.
HOURS_PATTERN = r"(\d+)\s*hour"
MINUTES_PATTERN = r"(\d+)\s*min"
BARE_PATTERN = r"^\s*(\d+)\s*$"
SIGNED_NUMBER_PATTERN = r"([-\d.]+)"
UNSIGNED_NUMBER_PATTERN = r"([\d.]+)"


def strip(text: str | Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(as_column(text), r"^\s+|\s+$", "")


def blank_to_null(text: str | Column) -> Column:
    return F.nullif(as_column(text), F.lit(""))


def captured(text: Column, pattern: str) -> Column:
    """First group of the first match; no match is NULL, which casts cheaply."""
    return blank_to_null(F.regexp_extract(text, pattern, 1))


def captured_int(text: Column, pattern: str) -> Column:
    return captured(text, pattern).try_cast("int")


def delay_minutes(text: str | Column) -> Column:
    """"1 hour and 5 minutes" → 65; bare digits are minutes; no amount is NULL."""
    lowered = F.lower(as_column(text))
    worded = F.coalesce(captured_int(lowered, HOURS_PATTERN), F.lit(0)) * 60 + F.coalesce(
        captured_int(lowered, MINUTES_PATTERN), F.lit(0)
    )
    return F.coalesce(F.nullif(worded, F.lit(0)), captured_int(lowered, BARE_PATTERN))


def delay_type(name: str | Column, length: int | None = DELAY_TYPE_LENGTH) -> Column:
    """Compact program code of a program name; an unknown name at the stored ``length``, or whole with None."""
    name = as_column(name)
    lowered = F.lower(name)
    code = F.lit(None).cast("string")
    for label, groups in reversed(DELAY_TYPE_RULES):
        hit = F.lit(False)
        for words in groups:
            every = F.lit(True)
            for word in words:
                every = every & F.contains(lowered, F.lit(word))
            hit = hit | every
        code = F.when(hit, F.lit(label)).otherwise(code)
    given = strip(name) if length is None else F.left(strip(name), F.lit(length))
    rest = F.coalesce(blank_to_null(given), F.lit(UNKNOWN_TYPE))
    return F.coalesce(code, rest)


def first_text(raw: str | Column) -> Column:
    """First entry of a JSON list, or the value itself; blanks become NULL."""
    raw = as_column(raw)
    listed = F.from_json(raw, "array<string>")
    value = F.when(raw.startswith("["), F.get(listed, F.lit(0))).otherwise(raw)
    return blank_to_null(strip(value))


def temperature(raw: str | Column) -> Column:
    """First signed number in the text."""
    return captured(first_text(raw), SIGNED_NUMBER_PATTERN).try_cast("double")


def visibility(raw: str | Column) -> Column:
    """First unsigned number in the text."""
    return captured(first_text(raw), UNSIGNED_NUMBER_PATTERN).try_cast("double")


def name_and_code(name: str | Column, code: str | Column) -> Column:
    """``Name (CODE)``, or the code where the name is unknown."""
    name, code = as_column(name), as_column(code)
    return F.coalesce(F.concat(name, F.lit(" ("), code, F.lit(")")), code)


def code_and_name(code: str | Column, name: str | Column) -> Column:
    """``CODE — Name``, or the code where the name is unknown."""
    name, code = as_column(name), as_column(code)
    return F.coalesce(F.concat(code, F.lit(" — "), name), code)


def code_from_label(label: str | Column) -> Column:
    """The code back out of either label form.

    A closing bracket at the end marks ``Name (CODE)``; otherwise the code is
    the part before the dash.
    """
    label = as_column(label)
    bracketed = F.regexp_extract(label, r"\(([^()]*)\)\s*$", 1)
    dashed = strip(F.split_part(label, F.lit(" — "), F.lit(1)))
    return F.when(F.contains(label, F.lit(" — ")), dashed).otherwise(
        F.coalesce(blank_to_null(strip(bracketed)), dashed)
    )
