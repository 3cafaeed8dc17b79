"""Wire-level columns: EDNS, DNSSEC parameters, option hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def edns(ttl: Column, rcode: Column, options: Column) -> Column:
    """From an OPT record's 32-bit TTL, the header's rcode and the option codes: do, version, flags set (by number, 0 the highest), extended rcode, options."""
    flags = ttl.bitwiseAND(F.lit(0xFFFF))
    on = F.filter(F.sequence(F.lit(0), F.lit(15)), lambda i: F.try_mod(F.floor(flags / F.pow(F.lit(2.0), (15 - i).cast("double"))), F.lit(2)) == 1)
    return F.struct(
        (flags.bitwiseAND(F.lit(0x8000)) != 0).alias("do"),
        F.shiftright(ttl, 16).bitwiseAND(F.lit(255)).cast("int").alias("version"),
        on.alias("flags"),
        (rcode + F.shiftleft(F.shiftright(ttl, 24).bitwiseAND(F.lit(255)), 4)).cast("int").alias("rcode"),
        options.alias("options"),
    )


def _byte(data: Column, i: int, n: int = 1) -> Column:
    return F.conv(F.substring(F.hex(data), 2 * i + 1, 2 * n), 16, 10).try_cast("int")


def dnssec_params(rr_type: Column, rdata: Column) -> Column:
    """Algorithms and TLSA fields of a record's data: DNSKEY (48), RRSIG (46), DS (43), TLSA (52); nulls elsewhere."""
    return F.struct(
        F.when(rr_type == 48, _byte(rdata, 3)).when(rr_type == 46, _byte(rdata, 2)).when(rr_type == 43, _byte(rdata, 2)).alias("algorithm"),
        F.when(rr_type == 43, _byte(rdata, 3)).alias("digest"),
        F.when(rr_type == 52, _byte(rdata, 0)).alias("usage"),
        F.when(rr_type == 52, _byte(rdata, 1)).alias("selector"),
        F.when(rr_type == 52, _byte(rdata, 2)).alias("matching"),
    )


def option_hash(code: Column) -> Column:
    """6-bit fold of an option code."""
    c = code.bitwiseXOR(F.shiftright(code, 6)).bitwiseXOR(F.shiftright(code, 12))
    return c.bitwiseAND(F.lit(63))


def option_codes(rdata: Column) -> Column:
    """Codes of the EDNS options in an OPT record's data, in order; an option that is cut off still counts, as its code was read."""
    text = F.hex(rdata)
    size = F.octet_length(rdata)
    pair = lambda at: F.conv(F.substr(text, at * 2 + 1, F.lit(4)), 16, 10).cast("int")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("codes"))

    def step(s: Column, _: Column) -> Column:
        more = F.struct((s["at"] + 4 + pair(s["at"] + 2)).alias("at"), F.array_append(s["codes"], pair(s["at"])).alias("codes"))
        return F.when(s["at"] + 4 <= size, more).otherwise(s)

    # no more options than four bytes each
    return F.aggregate(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor(size / 4).cast("int"))), start, step)["codes"]


def flag_numbers(bits: Column, n: int = 16) -> Column:
    """Numbers of the flags that are set in an n-bit field, 0 the highest."""
    text = F.lpad(F.bin(bits), n, "0")
    return F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.substr(text, i + 1, F.lit(1)) == "1")
