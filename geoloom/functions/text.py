"""Text functions: addresses, keys, tags."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_address(s: Column) -> Column:
    """Single spaces, none before a comma, upper case, trimmed."""
    return F.trim(F.upper(F.regexp_replace(F.regexp_replace(s, r"\s+", " "), r"\s+,", ",")))


def present(s: Column) -> Column:
    """Null for blank text."""
    return F.nullif(F.trim(s), F.lit(""))


def normalize_address(full: Column, street: Column, city: Column, state: Column, zip_code: Column) -> Column:
    """Parts joined by ', ' without blank ones, or else the full address; single spaces, upper case."""
    joined = F.concat_ws(", ", *[present(p) for p in (street, city, state, zip_code)])
    return F.upper(F.trim(F.regexp_replace(F.coalesce(present(joined), present(full)), r"\s+", " ")))


def address_hash(*parts: Column) -> Column:
    return F.md5(normalize_address(*parts))


def fill_block(block: Column, suffix: str = ", CHICAGO, IL") -> Column:
    """A redacted block number (..XX) filled with zeros, with its city."""
    return F.concat(F.regexp_replace(block, "XX", "00"), F.lit(suffix))


def first_number(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9].*", "").try_cast("int")


def first_listed(s: Column) -> Column:
    """The first name of a list-like text, or the text."""
    return F.when(s.startswith("["), F.regexp_extract(s, r"\[\s*['\"]?([^'\",\]]*)", 1)).otherwise(s)


def geocoder_input(raw: Column, street: Column, city: Column, state: Column, zip_code: Column) -> Column:
    """Street, city, and state with zip as one part; the raw address where there is no street."""
    region = present(F.concat_ws(" ", present(state), present(zip_code)))
    return F.when(present(street).isNotNull(), F.concat_ws(", ", present(street), present(city), region)).otherwise(raw)


def any_contains(names: Column, part: Column) -> Column:
    """Whether any name contains the part, whatever the case."""
    return F.exists(names, lambda n: F.contains(F.lower(n), F.lower(part)))


def either_contains(a: Column, b: Column) -> Column:
    """Whether one name contains the other, whatever the case; a null first name is contained in any."""
    return F.contains(F.lower(a), F.lower(b)) | F.contains(F.lower(b), F.lower(F.coalesce(a, F.lit(""))))


def joined_key(*parts: Column, null_safe: bool = True) -> Column:
    """md5 over '|'-joined values; without ``null_safe`` a null part makes the key null."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) if null_safe else p.cast("string") for p in parts]
    out = [texts[0]]
    for t in texts[1:]:
        out += [F.lit("|"), t]
    return F.md5(F.concat(*out))


def canonical_text(c: Column, kind: str) -> Column:
    """The one text form of a value that row hashes use; null and '' are alike."""
    if kind.startswith("timestamp"):
        c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    elif kind.startswith(("array", "struct", "map")):
        c = F.to_json(F.array_sort(F.map_entries(c)) if kind.startswith("map") else c)
    return F.coalesce(c.cast("string"), F.lit(""))


def sanitize(s: Column) -> Column:
    """Tabs and line ends become spaces."""
    return F.regexp_replace(s, r"[\t\n\r]", " ")


def json_text(s: Column) -> Column:
    """Literal-style maps ({'a': None}) as JSON text; other text as it is."""
    words = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
    return F.when(s.startswith("{"), F.regexp_replace(words, "'", '"')).otherwise(s)


def standard_name(name: str) -> str:
    """A column name of lower-case letters, digits and single underscores, not beginning with a digit."""
    words = re.findall(r"[a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", name).lower())
    plain = "_".join(words) or "column"
    return f"_{plain}" if plain[0].isdigit() else plain
