"""The queries of this subpackage and their DuckDB SQL, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from . import alignment, ann, decontam, mixing, negatives, pii, sharding, simhash, substring, tokens, toxicity, url_filter, warc


def queries() -> dict[str, Callable]:
    return {"op1_mix_sources": mixing.op1_mix_sources, "op2_decontaminate": decontam.op2_decontaminate, "op3_token_output": tokens.op3_token_output, "op4_pii": pii.op4_pii, "op5_toxicity": toxicity.op5_toxicity, "op6_nearest": ann.op6_nearest, "op7_url_filter": url_filter.op7_url_filter, "op8_warc": warc.op8_warc, "op9_substring_dedup": substring.op9_substring_dedup, "op10_simhash_near_dedup": simhash.op10_simhash_near_dedup, "op11_align": alignment.op11_align, "op12_hard_negatives": negatives.op12_hard_negatives, "op13_shard": sharding.op13_shard}


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": mixing.OP1_SQL, "op2_decontaminate": decontam.OP2_SQL, "op7_url_filter": url_filter.OP7_SQL, "op9_substring_dedup": substring.OP9_SQL, "op12_hard_negatives": negatives.OP12_SQL, "op13_shard": sharding.OP13_SQL}
