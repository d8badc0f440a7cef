"""The four report tables and their display form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storewright import fixed_values as fixed
from storewright.config import ConversionConfig
from storewright.functions.rates import percent_text
from storewright.operators.rollups import (
    group_rates,
    national_rates,
    rate_columns,
    region_and_national_rates,
    with_rates,
)
from storewright.schemas import DETAIL_KEYS


def detail_report(detail: DataFrame) -> DataFrame:
    """Store rows: each rate stands right after its two counts."""
    return with_rates(detail).select(
        *DETAIL_KEYS,
        *["buyers", "added", "add_rate"],
        *["new_buyers", "new_added", "new_add_rate"],
        *["old_buyers", "old_added", "old_add_rate"],
    )


def region_report(detail: DataFrame, cfg: ConversionConfig) -> DataFrame:
    """One row per region plus the national row (``level`` tells them apart)."""
    return region_and_national_rates(detail, cfg)


def sort_region_report(report: DataFrame) -> DataFrame:
    """Worst region first, the national row last. For the sink only."""
    return report.orderBy(F.col("level") == "national", "overall_add_rate", "region")


def national_row(detail: DataFrame, cfg: ConversionConfig) -> DataFrame:
    return national_rates(detail, cfg).select(
        F.lit("national").alias("level"), F.lit("ALL").alias("region"), *rate_columns()
    )


def subregion_report(detail: DataFrame, cfg: ConversionConfig) -> DataFrame:
    return group_rates(detail, "subregion", cfg, overall="weighted")


def lagging_subregions(
    detail: DataFrame, cfg: ConversionConfig, k: int = fixed.LAGGING_SUBREGIONS
) -> DataFrame:
    """The ``k`` sub-regions with the lowest overall rate; ties are cut by name."""
    return subregion_report(detail, cfg).orderBy("overall_add_rate", "subregion").limit(k)


def store_report(detail: DataFrame, cfg: ConversionConfig) -> DataFrame:
    return group_rates(detail, "store_name", cfg, overall="mean")


def percent_view(report: DataFrame) -> DataFrame:
    """Display form: every rate as percent text, the other columns as they are."""
    return report.select(
        *[percent_text(F.col(c)).alias(c) if c.endswith("add_rate") else F.col(c) for c in report.columns]
    )
