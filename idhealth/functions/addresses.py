"""Address columns: text to 16 bytes, networks, prefixes."""

from __future__ import annotations

import hashlib
import ipaddress
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import OCTET

RANGE = T.StructType().add("first", T.BinaryType()).add("last", T.BinaryType()).add("prefix", T.IntegerType()).add("v4", T.BooleanType())
V4 = rf"\A({OCTET}\.){{3}}{OCTET}\z"


def is_v4(text: Column) -> Column:
    return text.rlike(V4)


def v4_number(text: Column) -> Column:
    """An IPv4 address as a number; null for other texts."""
    p = F.split(text, r"\.")
    n = lambda i: F.get(p, F.lit(i)).try_cast("long")
    return F.when(is_v4(text), ((n(0) * 256 + n(1)) * 256 + n(2)) * 256 + n(3))


def v4_text(number: Column) -> Column:
    part = lambda s: F.shiftright(number, s).bitwiseAND(F.lit(255)).cast("string")
    return F.concat_ws(".", part(24), part(16), part(8), part(0))


@F.pandas_udf(T.BinaryType())
def ip_bin(text: pd.Series) -> pd.Series:
    """16 bytes of an address (IPv4 as ::ffff:a.b.c.d), null if it is none. Binary values compare as unsigned bytes."""

    def one(x: str | None) -> bytes | None:
        try:
            a = ipaddress.ip_address(x.strip())
        except (ValueError, AttributeError):
            return None
        return a.packed if a.version == 6 else b"\0" * 10 + b"\xff\xff" + a.packed

    return text.map(one)


def replaced_v6(key: str, kept: Sequence[str] = ()) -> Callable[[Column], Column]:
    """Column function: an IPv6 address whose groups, but the first one and those of 0, 1 and ffff, are digits of a keyed hash; null for other texts.

    The canonical form is what is replaced; addresses in kept stay. An IPv4 tail keeps its first number.
    """
    listed = frozenset(kept)

    def one(x: str | None) -> str | None:
        try:
            a = ipaddress.IPv6Address(x.strip())
        except (ValueError, AttributeError):
            return None
        groups = f"::ffff:{a.ipv4_mapped}".split(":") if a.ipv4_mapped else str(a).split(":")
        if ":".join(groups) in listed:
            return ":".join(groups)
        code = hashlib.sha256((key + "".join(groups) + key).encode()).digest()
        for i, g in enumerate(groups):
            if "." in g:
                groups[i] = ".".join([g.split(".")[0], *(str(c) for c in code[1:4])])
            elif i and g not in ("", "0", "1", "ffff"):
                groups[i] = "".join(f"{code[(4 * i + j) % 32] & 15:x}" for j in range(len(g)))
        return ":".join(groups)

    @F.pandas_udf(T.StringType())
    def replaced(text: pd.Series) -> pd.Series:
        return text.map(one)

    return replaced


@F.pandas_udf(RANGE)
def cidr_range(text: pd.Series) -> pd.DataFrame:
    """First and last address of a prefix as 16 bytes; nulls if it is none."""
    rows = []
    for x in text:
        try:
            n = ipaddress.ip_network((x or "").strip(), strict=False)
            lead = b"\0" * 10 + b"\xff\xff" if n.version == 4 else b""
            rows.append((lead + n.network_address.packed, lead + n.broadcast_address.packed, n.prefixlen, n.version == 4))
        except ValueError:
            rows.append((None, None, None, None))
    return pd.DataFrame(rows, columns=["first", "last", "prefix", "v4"])


def network(text: Column, v4_bits: int = 24, v6_bits: int = 48) -> Column:
    """Text of the address's network: native for IPv4, for IPv6 the first v6_bits as hexadecimal of the 16 bytes."""
    v4 = F.shiftleft(F.shiftright(v4_number(text), 32 - v4_bits), 32 - v4_bits)
    v6 = F.substring(F.lower(F.hex(ip_bin(text))), 1, v6_bits // 4)
    return F.when(is_v4(text), F.concat(v4_text(v4), F.lit(f"/{v4_bits}"))).otherwise(F.concat(v6, F.lit(f"/{v6_bits}")))
