"""Tolerant parsing of dates, numbers and JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text (with or without fraction and zone) as a timestamp, else null."""
    return F.try_to_timestamp(text)


def short_us_date(text: Column) -> Column:
    """``MM/dd/yy`` text as a date; years 69-99 belong to the last century."""
    clean = F.nullif(F.trim(text), F.lit(""))
    month = F.split_part(clean, F.lit("/"), F.lit(1))
    day = F.split_part(clean, F.lit("/"), F.lit(2))
    year = F.split_part(clean, F.lit("/"), F.lit(3)).try_cast("int")
    century = F.when(year >= 69, F.lit(1900)).otherwise(F.lit(2000))
    iso = F.concat_ws(
        "-", (century + year).cast("string"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")
    )
    return F.when(clean.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), iso.try_cast("date"))


def first_parsed(text: Column, formats: Sequence[str]) -> Column:
    """First format that parses the text."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def json_text(document: Column, name: str) -> Column:
    """Scalar member of a JSON object as text; objects and arrays give null."""
    value = F.get_json_object(document, f"$.{name}")
    return F.when(~value.rlike(r"^\s*[\[{]"), value)


def json_whole(document: Column, name: str) -> Column:
    """Integer member of a JSON object, null when it is not a number."""
    return json_text(document, name).try_cast("double").cast("bigint")


def number(value: Column) -> Column:
    return value.try_cast("double")


def approval_share(value: Column) -> Column:
    """Approval as 0-1: shares as is, percentages divided, anything else null."""
    v = number(value)
    return F.when(v.between(0, 1), v).when((v > 1) & (v <= 100), v / 100)


def first_filled(*columns: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])
