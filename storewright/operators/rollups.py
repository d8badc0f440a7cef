"""Rates per group of stores.

Four averaging rules look alike and are kept apart by name:

=============  =======================  ==========================
row            per store type           regardless of type
=============  =======================  ==========================
region         mean of store rates      sum / sum   ("weighted")
sub-region     mean of store rates      sum / sum   ("weighted")
store name     mean of store rates      mean of store rates ("mean")
national       sum / sum                sum / sum
=============  =======================  ==========================

Every rollup is one ``groupBy`` with conditional aggregates: no pivot job, no
join of a per-type and an overall result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storewright.config import ConversionConfig
from storewright.functions.rates import rate_of_sums, safe_rate
from storewright.operators.spread import spread_join

# rate name -> (numerator, denominator)
RATES = {
    "add_rate": ("added", "buyers"),
    "new_add_rate": ("new_added", "new_buyers"),
    "old_add_rate": ("old_added", "old_buyers"),
}


def rate_columns() -> list[str]:
    """The nine measures of a rollup, in report order."""
    return [f"{scope}_{rate}" for scope in ("overall", "own", "agent") for rate in RATES]


def with_rates(detail: DataFrame) -> DataFrame:
    """Add the three rates of each store; 0.0 where nobody bought."""
    return detail.withColumns(
        {rate: safe_rate(F.col(part), F.col(whole)) for rate, (part, whole) in RATES.items()}
    )


def _type_scopes(cfg: ConversionConfig) -> dict[str, Column]:
    store_type = F.col("store_type")
    return {"own": store_type == cfg.own_label, "agent": store_type == cfg.agent_label}


def _weighted(part: str, whole: str, rows: Column | None = None) -> Column:
    def total(name: str) -> Column:
        return F.sum(F.col(name) if rows is None else F.when(rows, F.col(name)))

    return rate_of_sums(total(part), total(whole))


def _mean(rate: str, rows: Column | None = None) -> Column:
    value = F.col(rate) if rows is None else F.when(rows, F.col(rate))
    return F.coalesce(F.avg(value), F.lit(0.0))


def _mean_by_type(cfg: ConversionConfig) -> list[Column]:
    return [
        _mean(rate, rows).alias(f"{scope}_{rate}")
        for scope, rows in _type_scopes(cfg).items()
        for rate in RATES
    ]


def _weighted_overall() -> list[Column]:
    return [_weighted(*pair).alias(f"overall_{rate}") for rate, pair in RATES.items()]


def _weighted_by_type(cfg: ConversionConfig) -> list[Column]:
    return [
        _weighted(*pair, rows).alias(f"{scope}_{rate}")
        for scope, rows in _type_scopes(cfg).items()
        for rate, pair in RATES.items()
    ]


def group_rates(detail: DataFrame, key: str, cfg: ConversionConfig, overall: str) -> DataFrame:
    """Nine rates per value of ``key``; a NULL key is dropped, a missing store type counts as 0.0."""
    if overall == "weighted":
        totals = _weighted_overall()
    elif overall == "mean":
        totals = [_mean(rate).alias(f"overall_{rate}") for rate in RATES]
    else:
        raise ValueError(f"overall must be 'weighted' or 'mean', not {overall!r}")
    return (
        with_rates(detail)
        .filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*totals, *_mean_by_type(cfg))
    )


def national_rates(detail: DataFrame, cfg: ConversionConfig) -> DataFrame:
    """One row, all nine rates as sum / sum."""
    return detail.agg(*_weighted_overall(), *_weighted_by_type(cfg))


def region_and_national_rates(detail: DataFrame, cfg: ConversionConfig) -> DataFrame:
    """`group_rates` by region and `national_rates` from one pass over the detail.

    ``rollup`` yields both levels; the national row takes the weighted type
    columns, the regions take the means.
    """
    national = F.col("is_national") == 1
    by_type = [f"{scope}_{rate}" for scope in ("own", "agent") for rate in RATES]
    both = (
        with_rates(detail)
        .rollup("region")
        .agg(
            F.grouping("region").alias("is_national"),
            *_weighted_overall(),
            *_mean_by_type(cfg),
            F.struct(*_weighted_by_type(cfg)).alias("weighted"),
        )
        .filter(national | F.col("region").isNotNull())
    )
    return both.select(
        F.when(national, "national").otherwise("region").alias("level"),
        F.when(national, "ALL").otherwise(F.col("region")).alias("region"),
        *[f"overall_{rate}" for rate in RATES],
        *[F.when(national, F.col(f"weighted.{c}")).otherwise(F.col(c)).alias(c) for c in by_type],
    )


def with_group_totals(detail: DataFrame, key: str) -> DataFrame:
    """Every store row with the weighted overall rates of its group.

    Group totals are computed once and joined back rather than taken over a
    window, which would gather a whole group in one task.
    """
    totals = detail.filter(F.col(key).isNotNull()).groupBy(key).agg(*_weighted_overall())
    return spread_join(detail, totals, key, "inner", ["store_code"])
