"""Place names and query texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Administrative prefixes of Vietnamese place names. (?iU) folds case and blanks by Unicode rules.
PROVINCE_PREFIX = r"(?iU)^tỉnh\s+"
CITY_PREFIX = r"(?iU)^thành phố\s+"
CITY_LABEL = "Thành phố "
COUNTRY_NAME = "Việt Nam"


def strip(text: Column) -> Column:
    """Remove blanks of any kind at both ends; `trim` knows the plain space only."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def clean_place_name(text: Column) -> Column:
    """Strip, drop the province prefix, and write the city prefix in one way."""
    bare = F.regexp_replace(strip(text), PROVINCE_PREFIX, "")
    return F.regexp_replace(bare, CITY_PREFIX, CITY_LABEL)


def geocoder_query(name: Column, *parents: str) -> Column:
    """The search text for a place: name, then enclosing areas, then the country."""
    return F.concat(name, F.lit("".join(f", {p}" for p in (*parents, COUNTRY_NAME))))
