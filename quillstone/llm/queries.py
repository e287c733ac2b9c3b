"""The corpus operators' queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillstone.llm import clusters, decontam, divergence, gam, mixing, oneperm, pii, rules, secrets, simhash, suffixes, tokens, urls


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": tokens.op1_token_counts,
        "op2_secret_scan": secrets.op2_secret_scan,
        "op3_quality_rules": rules.op3_quality_rules,
        "op4_surrogates": pii.op4_surrogates,
        "op5_repeats": suffixes.op5_repeats,
        "op6_decontaminate": decontam.op6_decontaminate,
        "op7_quality_gam": gam.op7_quality_gam,
        "op8_mixture": mixing.op8_mixture,
        "op9_simhash": simhash.op9_simhash,
        "op10_url_filter": urls.op10_url_filter,
        "op11_centroids": clusters.op11_centroids,
        "op12_divergence": divergence.op12_divergence,
        "op13_fingerprints": oneperm.op13_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_url_filter": urls.OP10_SQL, "op11_centroids": clusters.OP11_SQL, "op12_divergence": divergence.OP12_SQL}
