"""Queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chaining, chat, decontaminate, media, merkle, mixing, neardup, quality, simhash, suffixdedup, trie, warc, wrapper

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_passages": chaining.op1_passages,
        "op2_chat": chat.op2_chat,
        "op3_main_text": wrapper.op3_main_text,
        "op4_suffix_dedup": suffixdedup.op4_suffix_dedup,
        "op5_decontaminate": decontaminate.op5_decontaminate,
        "op6_near_duplicates": neardup.op6_near_duplicates,
        "op7_warc": warc.op7_warc,
        "op8_mix": mixing.op8_mix,
        "op9_quality": quality.op9_quality,
        "op10_media": media.op10_media,
        "op11_prefix_trie": trie.op11_prefix_trie,
        "op12_simhash": simhash.op12_simhash,
        "op13_manifest": merkle.op13_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat": chat.OP2_SQL,
        "op4_suffix_dedup": suffixdedup.OP4_SQL,
        "op5_decontaminate": decontaminate.OP5_SQL,
        "op7_warc": warc.OP7_SQL,
        "op8_mix": mixing.OP8_SQL,
        "op11_prefix_trie": trie.OP11_SQL,
        "op13_manifest": merkle.OP13_SQL,
    }
