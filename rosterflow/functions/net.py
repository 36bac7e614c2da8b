"""IPv4 helpers as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterflow.functions.common import let

IPV4 = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"


def ip_to_long(c: Column) -> Column:
    """Dotted IPv4 text -> BIGINT (NULL when not a valid address)."""
    def convert(v: Column) -> Column:
        def from_octets(octets: Column) -> Column:
            parts = [F.try_element_at(octets, F.lit(i)).try_cast("bigint") for i in range(1, 5)]
            ok = v.rlike(IPV4)
            for p in parts:
                ok = ok & (p <= 255)
            return F.when(ok, parts[0] * 16777216 + parts[1] * 65536 + parts[2] * 256 + parts[3])
        return let(F.split(v, "[.]"), from_octets)
    return let(c, convert)


def cidr_bounds(c: Column) -> tuple[Column, Column]:
    """``a.b.c.d/n`` -> (lowest, highest) BIGINT address of the block."""
    net = ip_to_long(F.substring_index(c, "/", 1))
    bits = F.substring_index(c, "/", -1).try_cast("int")
    size = F.pow(F.lit(2), 32 - bits).cast("bigint")
    valid = c.contains("/") & net.isNotNull() & bits.between(0, 32)
    lo = F.when(valid, net - F.pmod(net, size))
    return lo, F.when(valid, lo + size - 1)
