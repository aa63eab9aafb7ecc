"""Reading loosely typed JSON fields from a VARIANT column.

A value of the wrong JSON type is not coerced into a number or a flag: unless asked for, the text "12.5" is not a
price, and the text "true" is never a flag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.amounts import MONEY

# Fixed patterns of the timestamps that are accepted.
LIVE_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"
DOCUMENTED_TIMESTAMP = (
    r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?| \d{2}:\d{2}:\d{2})$"
)


def _path(name: str) -> str:
    return f"$.{name}" if name else "$"


def _json_type(doc: Column, name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(doc, _path(name), "variant"))


def _is_number(doc: Column, name: str, from_text: bool) -> Column:
    kind = _json_type(doc, name)
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return number | (kind == "STRING") if from_text else number


def raw_text(doc: Column, name: str) -> Column:
    """The field as text; NULL when missing, null or empty."""
    return text(doc, name, None)


def blank_to(value: Column, default: str | None = "") -> Column:
    """A text already read, ``default`` when missing, null or empty."""
    given = F.nullif(value, F.lit(""))
    return given if default is None else F.coalesce(given, F.lit(default))


def fields(doc: Column, kinds: str) -> Column:
    """Many fields in one pass, each read as its own path would read it; NULL unless ``doc`` is an object.

    ``kinds`` is a struct type. A field of a nested struct is NULL where the message has no object in its place.
    """
    return F.try_variant_get(doc, "$", kinds)


def text(doc: Column, name: str, default: str | None = "") -> Column:
    return blank_to(F.try_variant_get(doc, _path(name), "string"), default)


def number_or_null(doc: Column, name: str, from_text: bool = False) -> Column:
    """A JSON number as a wide decimal, NULL for every other type; ``from_text`` also reads numeric texts.

    With an empty ``name`` the document is the value itself.
    """
    return F.when(_is_number(doc, name, from_text), F.try_variant_get(doc, _path(name), "decimal(38,10)"))


def money(doc: Column, name: str, from_text: bool = False) -> Column:
    """A number rounded half-up to cents, else 0."""
    return F.coalesce(F.round(number_or_null(doc, name, from_text), 2).try_cast(MONEY), F.lit(0).cast(MONEY))


def whole(doc: Column, name: str, default: int, from_text: bool = False) -> Column:
    """A number without its fraction, else ``default``."""
    return F.coalesce(number_or_null(doc, name, from_text).try_cast("int"), F.lit(default))


def flag(doc: Column, name: str) -> Column:
    """True only for the JSON value true."""
    is_flag = _json_type(doc, name) == "BOOLEAN"
    return F.coalesce(is_flag & F.try_variant_get(doc, _path(name), "boolean"), F.lit(False))


def joined_list(doc: Column, name: str) -> Column:
    """A list of texts joined by commas; '' for anything that is no list."""
    return F.coalesce(F.array_join(F.try_variant_get(doc, _path(name), "array<string>"), ","), F.lit(""))


def live_timestamp(value: Column) -> Column:
    """First 19 characters, 'T' read as a blank; NULL when shorter or no date."""
    head = F.substring(F.replace(value, F.lit("T"), F.lit(" ")), 1, 19)
    return F.when(F.length(value) >= 19, F.try_to_timestamp(head, F.lit(LIVE_TIMESTAMP)))


def documented_timestamp(value: Column) -> Column:
    """Date and time with 'T' or blank; with 'T' the seconds may be missing or carry a fraction."""
    return F.when(value.rlike(DOCUMENTED_TIMESTAMP), value.try_cast("timestamp"))


def timestamp(doc: Column, name: str, as_of: Column, *, lenient: bool = True) -> Column:
    """The field as a timestamp, or the run's load time."""
    parse = live_timestamp if lenient else documented_timestamp
    return F.coalesce(parse(raw_text(doc, name)), as_of)


def list_of(doc: Column, name: str) -> Column:
    """A JSON array as an array of documents, NULL for anything else."""
    return F.try_variant_get(doc, _path(name), "array<variant>")


def list_size(doc: Column, name: str) -> Column:
    """Length of a JSON array, 0 for anything else. Its elements are read as flags, whatever they are, so none is copied."""
    return F.coalesce(F.array_size(F.try_variant_get(doc, _path(name), "array<boolean>")), F.lit(0))
