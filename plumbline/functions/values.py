"""Cleaning and coercion of text values, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(c: Column) -> Column:
    """Trimmed text; empty becomes null."""
    trimmed = F.trim(c.cast("string"))
    return F.when(trimmed != "", trimmed)


def coerce_number(c: Column) -> Column:
    """Number from text: thousands commas go, a trailing percent sign divides by 100."""
    text = clean_text(c)
    number = F.regexp_replace(text, "[,%]", "").try_cast("double")
    return F.when(text.endswith("%"), number / F.lit(100.0)).otherwise(number)


def percent_points(c: Column) -> Column:
    """Number from text where a percent sign is only removed (the validator's reading)."""
    return F.regexp_replace(clean_text(c), "[,%]", "").try_cast("double")


def strict_int(c: Column) -> Column:
    """Integer only if the text is all digits with an optional sign."""
    text = clean_text(c)
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))


def lenient_int(c: Column) -> Column:
    """Integer part of any number, thousands commas allowed."""
    return F.regexp_replace(clean_text(c), ",", "").try_cast("double").try_cast("bigint")


def truthy(c: Column, true_values: tuple[str, ...] = ("1", "true", "yes", "y")) -> Column:
    """1 when the text is in the true list, else 0."""
    return F.when(F.lower(clean_text(c)).isin(*true_values), 1).otherwise(0)


def first_non_empty(*cols: Column) -> Column:
    return F.coalesce(*[clean_text(c) for c in cols])


def unify_brackets(c: Column) -> Column:
    """Name with every bracket kind as a full-width parenthesis and no spaces."""
    return F.translate(c, "()[]【】 　", "（）（）（）")


def unify_separators(c: Column) -> Column:
    """Name with half-width brackets, commas for every list separator and no whitespace."""
    return F.regexp_replace(F.translate(F.trim(c), "（）【】，、；;", "()[],,,,"), r"\s+", "")


def alias_form(c: Column) -> Column:
    """Spelling used to compare aliases: lower case, no spaces."""
    return F.lower(F.translate(c, " 　", ""))


def slug(c: Column) -> Column:
    """Identifier-safe text: every other run of characters is one underscore, none at the ends."""
    return F.btrim(F.regexp_replace(F.trim(c), "[^0-9A-Za-z_]+", "_"), F.lit("_"))


def canonical_url(c: Column) -> Column:
    """Scheme and host in lower case, no ``www.``, no trailing slash on the path, no fragment."""
    url = F.trim(c)
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[^:/]+://([^/?#]*)", 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, r"^[^:/]+://[^/?#]*([^?#]*)", 1), "/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    return F.concat(scheme, F.lit("://"), host, path, query)


def url_host(c: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(c), r"^[^:/]+://([^/?#]*)", 1))


def url_path(c: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(c), r"^[^:/]+://[^/?#]*([^?#]*)", 1))


def title_form(c: Column) -> Column:
    """Title without whitespace, half-width parentheses, lower case."""
    return F.lower(F.translate(F.regexp_replace(c, r"\s+", ""), "（）", "()"))


def joined_key(*parts: Column, sep: str = "|") -> Column:
    """Parts joined by ``sep``, or null when any part is empty."""
    texts = [clean_text(p) for p in parts]
    present = texts[0].isNotNull()
    for t in texts[1:]:
        present = present & t.isNotNull()
    return F.when(present, F.concat_ws(sep, *texts))


def strip_suffixes(c: Column, suffixes: tuple[str, ...], repeat: bool) -> Column:
    """Without the given suffixes: each tried once in order (``repeat``) or only the first that fits."""
    if repeat:
        for s in suffixes:
            c = F.trim(F.regexp_replace(c, f"{re.escape(s)}$", ""))
        return c
    out = c
    for s in reversed(suffixes):
        out = F.when(c.endswith(s), F.substring(c, F.lit(1), F.length(c) - len(s))).otherwise(out)
    return out


def append_note(current: Column, note: Column, sep: str = "; ") -> Column:
    """Note added to the current text; unchanged when the text already holds it."""
    base = F.coalesce(current, F.lit(""))
    return F.when(base.contains(note), base).when(base == "", note).otherwise(F.concat(base, F.lit(sep), note))


def stable_id(*parts: Column, length: int = 20) -> Column:
    """Id from the values themselves: SHA-1 of the joined parts, null read as empty."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.substring(F.sha1(F.concat_ws("|", *texts)), 1, length)


def fixed6(c: Column) -> Column:
    """Six decimals, half up; written out so that every engine gives the same digits."""
    return F.floor(c * F.lit(1000000.0) + F.lit(0.5)).cast("double") / F.lit(1000000.0)


def truncate(c: Column, limit: int, mark: str = "...") -> Column:
    """Text no longer than ``limit``, with a mark where it was cut."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - len(mark)), F.lit(mark))).otherwise(c)
