"""Domain-name columns: labels, syntax, leak classes, patterns, randomness, anonymisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# fixed values: special-use top-level names
RFC6761 = ("ALT", "EXAMPLE", "INVALID", "LOCAL", "LOCALHOST", "ONION", "TEST")
OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def canonic(name: Column, most: int = 64) -> Column:
    """ASCII letters in upper case, cut at `most` characters; other characters stay."""
    return F.substring(F.translate(name, LOWER, UPPER), 1, most)


def labels(name: Column) -> Column:
    """Labels without a final empty one."""
    return F.split(F.regexp_replace(name, r"\.$", ""), r"\.")


def n_labels(name: Column) -> Column:
    return F.when(name.isNull() | (name == ""), 0).otherwise(F.size(labels(name)))


def tld(name: Column) -> Column:
    return F.try_element_at(labels(name), F.lit(-1))


def sld(name: Column) -> Column:
    """The label before the last; null if there is one label only."""
    return F.try_element_at(labels(name), F.lit(-2))


def is_valid_tld(t: Column) -> Column:
    return t.rlike(r"\A[A-Za-z0-9-]+\z")


def is_numeric(t: Column) -> Column:
    """Digits only; a hyphen may come first."""
    return t.rlike(r"\A-?[0-9]+\z")


def is_binary(t: Column) -> Column:
    """Has a control character, a space or a byte above ASCII."""
    return t.rlike(r"[^\x21-\x7E]")


def tld_check(t: Column) -> Column:
    return F.struct(is_binary(t).alias("is_binary"), (~is_valid_tld(t)).alias("is_wrong_syntax"), is_numeric(t).alias("is_numeric"))


def is_ipv4_name(name: Column) -> Column:
    """The last four labels are 0 to 255."""
    return name.rlike(rf"(\A|\.)({OCTET}\.){{3}}{OCTET}\z")


def is_chromium(name: Column) -> Column:
    """A probe: one label of 7 to 15 letters."""
    return name.rlike(r"\A[A-Za-z]{7,15}\z")


def is_member(t: Column, words: Sequence[str]) -> Column:
    return canonic(t).isin(*words)


def leak_type(name: Column, frequent: Sequence[str] = ()) -> Column:
    """Why a name leaks to the root; the first that holds of binary, bad_syntax, ipv4, numeric, rfc6761, frequent, dga, jumbo (16 characters or more), other."""
    t = tld(name)
    out = F.when(is_binary(t), "binary").when(~is_valid_tld(t), "bad_syntax").when(is_numeric(t) & is_ipv4_name(name), "ipv4").when(is_numeric(t), "numeric").when(is_member(t, RFC6761), "rfc6761")
    if frequent:
        out = out.when(is_member(t, frequent), "frequent")
    return out.when(is_chromium(name), "dga").when(F.char_length(t) >= 16, "jumbo").otherwise("other")


def underscore_labels(name: Column) -> Column:
    return F.filter(labels(name), lambda x: x.startswith("_"))


#: Runs of characters that are escaped: control, quote, comma, backslash, non-ASCII, a first =, edge blanks, blanks behind a blank.
ESCAPED = r"(?:[^\x20-\x7E]|[\",\\]|\A=|\A | \z|(?<= ) )+"


def safe_text(text: Column) -> Column:
    r"""Escapes as \ddd the characters that a CSV cell or a log can't hold: control, quote, comma, backslash, non-ASCII, a first =, edge and repeated blanks."""
    # the text is cut once at the runs of such characters; nothing looks at it again for each character
    plain = F.split(text, ESCAPED, -1)
    runs = F.regexp_extract_all(text, F.lit(f"({ESCAPED})"), F.lit(1))
    codes = lambda run: F.regexp_replace(F.hex(F.encode(run, "UTF-8")), "(..)", "\\\\$1")
    escaped = F.transform(runs, lambda run: F.array_join(F.transform(F.split(F.substring(codes(run), 2, 1 << 30), r"\\"), lambda b: F.concat(F.lit("\\"), F.lpad(F.conv(b, 16, 10), 3, "0"))), ""))
    return F.array_join(F.zip_with(plain, escaped, lambda p, e: F.concat(p, F.coalesce(e, F.lit("")))), "")


def is_qname_minimized(qname: Column, qtype: Column, qclass: Column, n_questions: Column, first_owner: Column) -> Column:
    """One question of class IN for A (1) or NS (2) whose name owns the first record of the answer; without records (null owner) it counts too."""
    return (n_questions == 1) & (qclass == 1) & qtype.isin(1, 2) & (first_owner.isNull() | (F.translate(qname, UPPER, LOWER) == F.translate(first_owner, UPPER, LOWER)))


# fixed values: model of registered top-level names, letters a to z
LETTER_SHARE = (
    0.076492537, 0.067164179, 0.11380597, 0.041044776, 0.035447761, 0.055970149, 0.03358209, 0.044776119, 0.026119403, 0.01119403, 0.018656716, 0.048507463, 0.054104478,
    0.026119403, 0.024253731, 0.044776119, 0.001865672, 0.041044776, 0.10261194, 0.046641791, 0.005597015, 0.029850746, 0.029850746, 0.005597015, 0.01119403, 0.003731343,
)
# fixed values: group of each letter, letters in each group, share of each group in registered names
LETTER_GROUP = (0, 3, 2, 2, 0, 3, 2, 2, 1, 4, 3, 2, 2, 1, 1, 2, 4, 1, 1, 1, 2, 3, 3, 4, 3, 4)
GROUP_LETTERS = (2, 6, 8, 6, 4)
GROUP_SHARE = (0.110244689, 0.478354396, 0.294433988, 0.103791342, 0.013175585)
# fixed values: share of steps vowel-vowel, vowel-consonant, consonant-vowel, consonant-consonant (vowels a e i o u)
STEP_SHARE = (0.036855037, 0.314847315, 0.341172341, 0.307125307)
STEP_UNIFORM = (4 * 4 / 676, 4 * 22 / 676, 22 * 4 / 676, 22 * 22 / 676)
VOWELS = "aeiou"


def _divergence(counts: Sequence[Column], prior: Sequence[float], total: Column, model: Sequence[float]) -> Column:
    """Sum of p ln(p / model) with p = (count + prior) / total."""
    parts = [((c + F.lit(w)) / total) for c, w in zip(counts, prior, strict=True)]
    return sum((p * F.log(p / F.lit(m)) for p, m in zip(parts[1:], model[1:], strict=True)), parts[0] * F.log(parts[0] / F.lit(model[0])))


def _times(values: Column, wanted: str) -> Column:
    return F.size(F.filter(values, lambda x: x == wanted))


def random_metrics(name: Column) -> dict[str, Column]:
    """For a name of letters: p (product of letter shares over 1/26), and divergences of letter groups (c) and vowel steps (t) from uniform (u) and registered names (a)."""
    low = F.translate(name, UPPER, LOWER)
    n = F.char_length(low)
    group_text = F.translate(low, LOWER, "".join(str(g) for g in LETTER_GROUP))
    counts = [n - F.char_length(F.replace(group_text, F.lit(str(g)), F.lit(""))) for g in range(5)]
    kinds = F.translate(low, LOWER, "".join("v" if x in VOWELS else "c" for x in LOWER))
    # each step once: every second character starts one, from the first and from the second character
    doubled = F.regexp_replace(kinds, "(?<=.)(.)(?=.)", "$1$1")
    pairs = F.regexp_extract_all(doubled, F.lit("(..)"), F.lit(1))
    steps = [_times(pairs, k) for k in ("vv", "vc", "cv", "cc")]
    odds = F.array(*[F.lit(26.0 * x) for x in LETTER_SHARE])
    p = F.aggregate(F.split(low, ""), F.lit(1.0), lambda acc, c: acc * F.coalesce(F.get(odds, F.ascii(c) - 97), F.lit(1.0)))
    uniform = [w / 26 for w in GROUP_LETTERS]
    return {
        "p": p,
        "c_u": _divergence(counts, uniform, n + 1, uniform),
        "c_a": _divergence(counts, uniform, n + 1, GROUP_SHARE),
        "t_u": _divergence(steps, STEP_UNIFORM, n, STEP_UNIFORM),
        "t_a": _divergence(steps, STEP_UNIFORM, n, STEP_SHARE),
    }


def is_random(name: Column) -> Column:
    """Whether a name of letters looks generated: unlikely letters, unless its vowel steps look like a name's, or likely letters in unlikely order. The bounds are fixed values."""
    m = random_metrics(name)
    once = F.array(F.struct(F.char_length(name).alias("n"), *[c.alias(k) for k, c in m.items()]))  # each metric is computed once

    def decide(x: Column) -> Column:
        n, p, c_u, c_a, t_u, t_a = (x[k] for k in ("n", "p", "c_u", "c_a", "t_u", "t_a"))
        even_steps = F.when(c_a > 0.4, t_a < 0.1).otherwise(t_a > F.when(c_u > 0.19, 0.2).otherwise(0.19))
        unlikely = (n >= 10) | (t_a > 0.5) | ((t_u <= 0.25) & ((p < 0.1) | even_steps)) | ((t_u > 0.25) & (t_u <= 0.44) & (c_a >= 0.275))
        short = (n > 6) & (t_a > 0.2) & (t_u < 0.125)
        long = (c_u <= 0.3) & ((t_a > 0.15) | ((n >= 12) & (t_u < 0.35)))
        return F.when(p < 0.9, unlikely).when(n < 9, short).otherwise(long)

    return F.get(F.transform(once, decide), F.lit(0))


def name_pattern(name: Column) -> Column:
    """The first pattern that fits: idn_7_64, num_1_3, num_4_8, dga_alpha_6 to dga_alpha_16 (random), alpha_6_7, alpha_8_9, then for random names alpha_10_12, alpha_13_16; else null."""
    n = F.char_length(name)
    alpha = name.rlike(r"\A[A-Za-z]+\z")
    random = alpha & n.between(6, 16) & is_random(name)
    idn = name.rlike(r"\A[Xx][Nn]--[A-Za-z0-9-]+\z") & (n >= 7)
    out = F.when(n >= 64, F.lit(None).cast("string")).when(idn, "idn_7_64").when(is_numeric(name) & (n <= 3), "num_1_3").when(is_numeric(name) & n.between(4, 8), "num_4_8")
    out = out.when(random, F.concat(F.lit("dga_alpha_"), n.cast("string")))
    return out.when(alpha & n.between(6, 7), "alpha_6_7").when(alpha & n.between(8, 9), "alpha_8_9")


def zone(df: DataFrame, name: str, rules: DataFrame) -> DataFrame:
    """Adds `zone`, the registrable zone of a name by public-suffix rules (suffix, kind: std, wildcard or exception).

    The longest suffix of the name that is a rule decides: std gives it and one label more (null if there is none),
    wildcard two more, exception the suffix itself. Without a rule the last two labels. The candidates of distinct names
    are joined, not the rows.
    """
    own = df.select(F.col(name).alias("name_")).where("name_ IS NOT NULL").distinct().withColumn("l_", labels(canonic(F.col("name_"), 255)))
    n = F.size("l_")
    tails = own.select("name_", "l_", F.explode(F.sequence(F.lit(1), n)).alias("k_")).withColumn("suffix", F.array_join(F.slice("l_", -F.col("k_"), F.col("k_")), "."))
    hit = tails.join(rules.select(F.translate("suffix", LOWER, UPPER).alias("suffix"), "kind"), "suffix").groupBy("name_").agg(F.max(F.struct("k_", "kind")).alias("r_"))
    full = own.join(hit, "name_", "left")
    more = F.when(F.col("r_.kind") == "std", 1).when(F.col("r_.kind") == "wildcard", 2).otherwise(0)
    want = F.when(F.col("r_").isNull(), F.least(F.lit(2), n)).otherwise(F.col("r_.k_") + more)
    z = F.when(want <= n, F.array_join(F.slice("l_", -F.greatest(want, F.lit(1)), F.greatest(want, F.lit(1))), "."))
    return df.join(full.select(F.col("name_").alias(name), z.alias("zone")), name, "left")


def anonymize_name(name: Column, key: str, level: int = 1, kept: Sequence[str] = RFC6761) -> Column:
    """Keyed replacement that keeps lengths, letters as letters and digits as digits; the last `level` labels and words in `kept` stay."""
    parts = labels(name)
    n = F.size(parts)

    def part(x: Column, i: Column) -> Column:
        digest = F.sha2(F.concat(F.lit(key), F.translate(x, UPPER, LOWER), F.lit(key)), 256)
        byte = lambda k: F.conv(F.substr(digest, k * 2 + 1, F.lit(2)), 16, 10).cast("int")

        def char(c: Column, j: Column) -> Column:
            v = byte(j % 32) * 256 + byte((j + 8) % 32)
            return F.when(c.rlike("[A-Za-z]"), F.char(v % 26 + 65)).when(c.rlike("[0-9]"), (v % 10).cast("string")).otherwise(c)

        return F.when((i >= n - level) | is_member(x, kept), x).otherwise(F.array_join(F.transform(F.split(x, ""), char), ""))

    return F.array_join(F.transform(parts, part), ".")
