"""Queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, fixity, line_dedup, maxscore, mixing, neardup, ngram_join, packing, pii, quality


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_embedding_neardup": neardup.op1_embedding_neardup,
        "op2_packing": packing.op2_packing,
        "op3_topk": maxscore.op3_topk,
        "op4_mixing": mixing.op4_mixing,
        "op5_fixity": fixity.op5_fixity,
        "op6_chat": chat.op6_chat,
        "op7_quality": quality.op7_quality,
        "op8_pii": pii.op8_pii,
        "op9_ngram_join": ngram_join.op9_ngram_join,
        "op10_line_dedup": line_dedup.op10_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_embedding_neardup": neardup.op_sql(), "op3_topk": maxscore.op_sql(), "op4_mixing": mixing.sql(), "op5_fixity": fixity.sql(), "op9_ngram_join": ngram_join.op_sql(), "op10_line_dedup": line_dedup.op_sql()}
