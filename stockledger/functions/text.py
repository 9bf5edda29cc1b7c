"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concat_text(*parts) -> Column:
    """Parts of any type as one text; NULL parts are skipped."""
    return F.concat_ws("", *[(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts])


def plus_text(*parts) -> Column:
    """Parts as one text; NULL if any part is NULL."""
    return F.concat(*[(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts])


def position_of(needle: str, text: Column) -> Column:
    """1-based position of ``needle``, 0 if absent."""
    return F.instr(text, needle)


def text_before(text: Column, separator: str) -> Column:
    """Text up to the first separator, or all of it."""
    return F.substring_index(text, separator, 1)


def first_nonempty(*columns: Column) -> Column:
    """First value that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def json_field(text: Column, name: str) -> Column:
    """Text value of a key in a hand-written JSON comment.

    Well-formed JSON is read as such. Otherwise, for example with text around the object or a
    missing brace, the value is what stands between the quotes after the key. Values that are not
    text are not taken, in either form.
    """
    quoted = F.regexp_extract(text, f'"{re.escape(name)}":"([^"]*)"', 1)
    present = text.contains(f'"{name}":"')
    parsed = F.get_json_object(text, f"$.{name}")
    return F.when(present, F.coalesce(parsed, quoted))


def with_json_fields(df: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """``json_field`` of several keys of the column ``text``, added as ``{new column: key}``.

    The text is parsed once, into a variant of which the keys are read; text that does not parse is read as
    ``json_field`` reads it.
    """
    raw = F.col(text)
    shaped = F.when(raw.contains("{"), raw)
    parsed = df.withColumn("__json", F.try_parse_json(shaped))
    fields = {}
    for out, name in names.items():
        quoted = F.regexp_extract(raw, f'"{re.escape(name)}":"([^"]*)"', 1)
        read = F.try_variant_get(F.col("__json"), f"$['{name}']", "string")
        fields[out] = F.when(raw.contains(f'"{name}":"'), F.coalesce(read, quoted))
    return parsed.withColumns(fields).drop("__json")


def looks_like_json(text: Column) -> Column:
    """Starts with an opening and ends with a closing brace."""
    return text.like("{%}")


def has_braces(text: Column) -> Column:
    return text.contains("{") & text.contains("}")
