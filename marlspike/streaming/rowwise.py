"""Encoding a stream of company rows with dictionaries fitted beforehand."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from marlspike.operators.features import FeatureSpec, assemble_wide, company_features


def encode_stream(
    rows: DataFrame, dictionaries: Mapping[str, DataFrame], spec: FeatureSpec, preset: str
) -> DataFrame:
    """Company features and wide slots; the dictionaries are static tables, so
    each micro-batch is a map with small-side joins and keeps no state."""
    if not rows.isStreaming:
        raise ValueError("encode_stream takes a streaming DataFrame")
    return assemble_wide(company_features(rows, dictionaries, preset), spec)
