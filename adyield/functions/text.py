"""Text clean-up: URL parameters, place names in keywords, value recodes, hashes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Place names that mark a geo-granular keyword.
STATES = [
    "Alaska", "Alabama", "Arkansas", "American Samoa", "Samoa", "Arizona", "California", "Colorado",
    "Connecticut", "District of Columbia", "DC", "District Columbia", "Delaware", "Florida", "Georgia",
    "Guam", "Hawaii", "Iowa", "Idaho", "Illinois", "Indiana", "Kansas", "Kentucky", "Louisiana",
    "Massachusetts", "Maryland", "Maine", "Michigan", "Minnesota", "Missouri", "Mississippi", "Montana",
    "North Carolina", "North Dakota", "Nebraska", "New Hampshire", "New Jersey", "New Mexico", "Nevada",
    "New York", "Ohio", "Oklahoma", "Oregon", "Pennsylvania", "Puerto Rico", "Rhode Island",
    "South Carolina", "South Dakota", "Tennessee", "Texas", "Utah", "Virginia", "Virgin Islands",
    "Vermont", "Washington", "Wisconsin", "West Virginia", "Wyoming",
]
STATE_TAG = "<STATE>"

# Raw device / operating-system names and the names the ad network uses.
DEVICE_NAMES = {
    "DESKTOP": "DESK", "MOBILE": "PHON", "TABLET": "TBLT",
    "D": "DESK", "P": "PHON", "T": "TBLT",
}
OPERATING_SYSTEM_NAMES = {
    "Linux": "Linux", "Linux armv7l": "Linux", "Linux armv8l": "Linux", "Linux x86_64": "Linux",
    "ARM": "Linux", "FreeBSD amd64": "Linux", "Linux aarch64": "Linux", "Linux armv7": "Linux",
    "Linux i686": "Linux",
    "MacIntel": "Mac OS X",
    "Win32": "Windows", "Win64": "Windows", "Windows": "Windows",
    "iPad": "iPadOS", "iPhone": "iOS", "iPod touch": "iOS", "Android": "Android",
}


def state_pattern() -> str:
    """One case-insensitive alternation; words may be joined by a blank or dash and an optional plus."""
    return "(?i)(" + "|".join(r"[ -]\+?".join(name.split()) for name in STATES) + ")"


def tag_states(text: Column) -> Column:
    return F.regexp_replace(text, state_pattern(), STATE_TAG)


def tag_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(STATE_TAG))


def contains_flag(text: Column, part: str) -> Column:
    """Substring test in which NULL text counts as False."""
    return F.coalesce(F.contains(text, F.lit(part)), F.lit(False))


def url_parameter(url: Column, name: str) -> Column:
    after = F.split_part(url, F.lit(f"{name}="), F.lit(2))
    return F.split_part(after, F.lit("&"), F.lit(1))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def recode(value: Column, names: Mapping[str, str]) -> Column:
    """Mapped name, or the value itself when it has none."""
    pairs = [F.lit(part) for item in names.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)


def clean_zip(zip_code: Column) -> Column:
    return F.regexp_replace(F.trim(zip_code), r"[\n\r\t|]*", "")


def hashed_contact(contact: Column) -> Column:
    return F.md5(contact)
