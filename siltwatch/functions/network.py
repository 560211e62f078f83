"""IP address predicates and subnet keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The textual forms of an address.
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{OCTET}(?:\.{OCTET}){{3}}$"
GROUP = "[0-9A-Fa-f]{1,4}"
V4_TAIL = rf"(?:{OCTET}\.){{3}}{OCTET}"
ZONE = r"(?:%[^%]+)?"


def _ipv6_pattern() -> str:
    """Pattern of every IPv6 text form: plain, one '::', dotted tail, zone id."""
    full = [rf"(?:{GROUP}:){{7}}{GROUP}", rf"(?:{GROUP}:){{6}}{V4_TAIL}"]
    short = []
    for left in range(8):
        head = "" if left == 0 else rf"{GROUP}(?::{GROUP}){{{left - 1}}}"
        room = 7 - left
        tails = [""]
        if room >= 1:
            tails.append(rf"{GROUP}(?::{GROUP}){{0,{room - 1}}}")
        if room >= 2:
            tails.append(rf"(?:{GROUP}:){{0,{room - 2}}}{V4_TAIL}")
        short.append(rf"{head}::(?:{'|'.join(tails)})")
    return rf"^(?:{'|'.join(full + short)}){ZONE}$"


IPV6 = _ipv6_pattern()


def is_ipv4(col: Column) -> Column:
    return F.coalesce(col.rlike(IPV4), F.lit(False))


def is_ipv6(col: Column) -> Column:
    return F.coalesce(col.rlike(IPV6), F.lit(False))


def is_ip(col: Column) -> Column:
    return is_ipv4(col) | is_ipv6(col)


def subnet_v4(col: Column, prefix: int = 24) -> Column:
    """``network_prefix`` text of an IPv4 address, null for anything else."""
    if not 0 <= prefix <= 32:
        raise ValueError("IPv4 prefix length must be between 0 and 32")
    parts = F.split(col, r"\.")
    masks = [max(0, min(8, prefix - 8 * i)) for i in range(4)]
    octets = [
        F.try_element_at(parts, F.lit(i + 1)).try_cast("int").bitwiseAND((0xFF00 >> bits) & 0xFF).cast("string")
        for i, bits in enumerate(masks)
    ]
    return F.when(is_ipv4(col), F.concat(F.concat_ws(".", *octets), F.lit(f"_{prefix}")))


def _v6_groups(col: Column) -> Column:
    """The eight groups of a valid IPv6 text as hexadecimal strings."""
    bare = F.regexp_replace(col, "%.*$", "")
    octets = F.split(F.substring_index(bare, ":", -1), r"\.")
    pair = lambda i: F.hex(F.try_element_at(octets, F.lit(i)).try_cast("int") * 256 + F.try_element_at(octets, F.lit(i + 1)).try_cast("int"))
    plain = F.when(F.contains(bare, F.lit(".")), F.concat(F.regexp_replace(bare, "[0-9.]+$", ""), pair(1), F.lit(":"), pair(3))).otherwise(bare)
    sides = F.split(plain, "::", -1)
    none = F.array().cast("array<string>")
    side = lambda i: F.when(F.length(F.try_element_at(sides, F.lit(i))) > 0, F.split(F.try_element_at(sides, F.lit(i)), ":")).otherwise(none)
    gap = F.greatest(F.lit(0), 8 - F.size(side(1)) - F.size(side(2)))
    return F.concat(side(1), F.array_repeat(F.lit("0"), gap), side(2))


def _shortened(groups: Column) -> Column:
    """Groups with the first longest run of at least two zeros as '::'."""
    chain = None
    for n in range(8, 1, -1):
        run = rf"^(.*?)(?:^|:)0(?::0){{{n - 1}}}(?::|$)(.*)$"
        found, short = groups.rlike(run), F.regexp_replace(groups, run, "$1::$2")
        chain = F.when(found, short) if chain is None else chain.when(found, short)
    return chain.otherwise(groups)


def subnet_v6(col: Column, prefix: int = 64) -> Column:
    """``network_prefix`` text of an IPv6 address in shortest hexadecimal form, null for anything else."""
    if not 0 <= prefix <= 128:
        raise ValueError("IPv6 prefix length must be between 0 and 128")
    masks = F.array(*[F.lit((0xFFFF0000 >> max(0, min(16, prefix - 16 * i))) & 0xFFFF) for i in range(8)])
    masked = F.zip_with(_v6_groups(col), masks, lambda g, m: F.lower(F.hex(F.conv(g, 16, 10).cast("int").bitwiseAND(m))))
    network = F.transform(F.array(F.array_join(masked, ":")), _shortened)
    return F.when(is_ipv6(col), F.concat(F.element_at(network, 1), F.lit(f"_{prefix}")))


def subnet_id(col: Column, v4_prefix: int = 24, v6_prefix: int = 64, v6: bool = True) -> Column:
    """Subnet key of any address, all built-in expressions."""
    v4 = subnet_v4(col, v4_prefix)
    return F.coalesce(v4, subnet_v6(col, v6_prefix)) if v6 else v4
