"""IPv4 helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _octet(ip: Column, position: int) -> Column:
    return F.split_part(ip, F.lit("."), F.lit(position))


def inet_aton(ip: Column) -> Column:
    """Dotted address to BIGINT; blank or malformed addresses give NULL instead of a failed task."""
    value = F.lit(0).cast("long")
    for position, weight in ((1, 1 << 24), (2, 1 << 16), (3, 1 << 8), (4, 1)):
        value = value + _octet(ip, position).try_cast("long") * F.lit(weight).cast("long")
    return value


def octets_of(ip: Column) -> Column:
    """The parts of an address, split once; ``octets_aton`` adds them up."""
    return F.split(ip, r"\.")


def octets_aton(octets: Column) -> Column:
    """``inet_aton`` of an address that is split already."""
    value = F.lit(0).cast("long")
    for position, weight in ((1, 1 << 24), (2, 1 << 16), (3, 1 << 8), (4, 1)):
        value = value + F.try_element_at(octets, F.lit(position)).try_cast("long") * F.lit(weight).cast("long")
    return value


def ip_index(ip: Column) -> Column:
    """First two octets, the equi-join bucket of an address."""
    return F.regexp_extract(ip, r"\d+\.\d+", 0)


def extract_octets(ip: Column, octets: Sequence[int] = (1, 2, 3, 4), join: bool = False) -> Column:
    parts = [_octet(ip, octet) for octet in octets]
    return F.concat_ws(".", *parts) if join else F.array(*parts)
