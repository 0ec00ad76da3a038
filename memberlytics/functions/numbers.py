"""Numbers that arrive as free text or inside JSON documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number. `\z` is the true end of the text; `$` would also
# accept a trailing newline.
WHOLE_NUMBER = r"^[0-9]+\z"
PLAIN_NUMBER = r"^[0-9]+(\.[0-9]+)?\z"
GIGABYTES = r"^[0-9]+(\.[0-9]+)?GB\z"
NOT_DIGIT_OR_DOT = "[^0-9.]"
# The JSON reader renders small and large JSON numbers in this form.
EXPONENT_FORM = r"^[0-9]+\.[0-9]+E-?[0-9]+\z"

# Byte resolution for GB quantities; the quotient of two keeps 15 fraction digits, so the usage
# thresholds are compared exactly.
GB_TYPE = "decimal(23,9)"


def guarded_number(text: Column, number_type: str, whole_only: bool) -> Column:
    """`text` as a number when the whole of it is one, else null.

    `whole_only` rejects a fraction ("5.5"), which is how the weekly index reads its inputs.
    """
    pattern = WHOLE_NUMBER if whole_only else PLAIN_NUMBER
    return F.when(text.rlike(pattern), text.try_cast(number_type))


def digits_number(text: Column, whole_only: bool = True) -> Column:
    """Everything but digits and dots removed ("base 55GB" -> 55, "5G 55GB" -> 555)."""
    return guarded_number(F.regexp_replace(text, NOT_DIGIT_OR_DOT, ""), "double", whole_only)


def parse_allowance(text: Column) -> Column:
    """Data allowance in GB; only an exact "12GB" or "12.5GB" has one."""
    return F.when(text.rlike(GIGABYTES), F.regexp_replace(text, r"GB\z", "").try_cast(GB_TYPE))


def json_text(document: Column, field: str) -> Column:
    """A field of a JSON object as text; null when the document is no object."""
    return F.from_json(document, f"{field} string")[field]


def json_number(
    document: Column, field: str, number_type: str = GB_TYPE, whole_only: bool = False, text: Column | None = None
) -> Column:
    """A numeric field of a JSON object; null when the document is no object or the value no number.

    Parsing is dear and the text is looked at several times: over many rows, select `json_text`
    first and pass its column as `text`.
    """
    text = json_text(document, field) if text is None else text
    plain = guarded_number(text, number_type, whole_only)
    if whole_only:
        return plain
    # Read as a double, a text that only looks like an exponent form is null.
    number = F.from_json(document, f"{field} double")[field].try_cast(number_type)
    return F.when(text.rlike(EXPONENT_FORM), number).otherwise(plain)


def count_tags_in(tags_json: Column, wanted: list[str]) -> Column:
    """How many elements of a JSON string array are in `wanted`; repeats count each time."""
    tags = F.from_json(tags_json, "array<string>")
    return F.coalesce(F.size(F.filter(tags, lambda tag: tag.isin(wanted))), F.lit(0))
