"""Merchant report: features, ranking, census, merge, importance and score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from trendspark.operators.aggregate import city_totals
from trendspark.operators.features import merchant_features
from trendspark.operators.forest import feature_importance
from trendspark.operators.joins import census_enrich, merge_all
from trendspark.operators.ranking import trend_ranking
from trendspark.operators.scoring import scoring_report
from trendspark.settings import (
    COUNT_TREND_WEIGHTS,
    RESTAURANT_CODE,
    SALES_TREND_WEIGHTS,
    SCORING_COLUMNS,
    SCORING_DIRECTIONS,
    SUM_WEIGHTS,
)
from trendspark.sources.warehouse import merchant_extract
from trendspark.staging import stage, stage_all


def merge_job(
    merchants: DataFrame,
    bank: DataFrame,
    census: DataFrame,
    *,
    code: str = RESTAURANT_CODE,
    first_base: str = "current",
    legacy_2018: bool = False,
    sales_weights: Sequence[float] = SALES_TREND_WEIGHTS,
    count_weights: Sequence[float] = COUNT_TREND_WEIGHTS,
) -> dict[str, DataFrame]:
    """Every table up to the merged one.

    Tables with several consumers are written once: the extract (features and totals),
    the features (quantiles, counts and ranks), the lookups (measured, then joined) and
    the merged table (importance, and both passes of the score).
    """
    extract = stage(merchant_extract(merchants, code), "merchants")
    features, totals = stage_all(
        features=merchant_features(extract, first_base), city_totals=city_totals(extract, bank, code, legacy_2018)
    )
    ranking = trend_ranking(features, sales_weights, count_weights)
    enriched = stage(census_enrich(features, census), "census")
    merged = stage(merge_all(ranking, totals, enriched), "merged")
    return {
        "features": features,
        "ranking": ranking,
        "city_totals": totals,
        "census": enriched,
        "merged": merged,
    }


def merchant_job(
    merchants: DataFrame,
    bank: DataFrame,
    census: DataFrame,
    *,
    scoring_columns: Sequence[str] = SCORING_COLUMNS,
    directions: Sequence[int] = SCORING_DIRECTIONS,
    sum_weights: Sequence[float] = SUM_WEIGHTS,
    importance_mode: str = "classify",
    importance_exclude: Sequence[str] = (),
    **merge_options,
) -> dict[str, DataFrame]:
    """The tables of :func:`merge_job`, plus ``importance`` and ``report``.

    ``census`` has one row per ZIP code (see ``sources.census.census_table``).
    """
    tables = merge_job(merchants, bank, census, **merge_options)
    merged = tables["merged"]
    return {
        **tables,
        "importance": feature_importance(merged, mode=importance_mode, exclude=importance_exclude),
        "report": scoring_report(merged, scoring_columns, directions, sum_weights),
    }
