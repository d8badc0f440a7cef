"""Parameters of the three jobs. Nothing here touches a SparkSession."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storewright import fixed_values as fixed


@dataclass(frozen=True)
class ConversionConfig:
    """Period and exclusion lists of the member-conversion report."""

    period_start: date
    period_end: date
    channels: tuple = fixed.CHANNELS
    excluded_classes: tuple = fixed.EXCLUDED_CLASSES
    excluded_skus: tuple = fixed.EXCLUDED_SKUS
    excluded_guides: tuple = fixed.EXCLUDED_GUIDES
    excluded_region: str = fixed.EXCLUDED_REGION
    activated_flag: str = fixed.ACTIVATED_FLAG
    agent_store_type: str = fixed.AGENT_STORE_TYPE
    own_label: str = "own"
    agent_label: str = "agent"
    # Name of the date column by which purchases and followers are partitioned, if they are.
    day_partition: str | None = None

    # NTZ literals: folded by Catalyst, so the bounds reach the Parquet scan
    # whether the column is timestamp_ntz or timestamp.
    @property
    def start_ts(self) -> Column:
        return F.lit(f"{self.period_start} 00:00:00").cast("timestamp_ntz")

    @property
    def end_ts(self) -> Column:
        """Inclusive upper bound; the last fractional second is outside the period."""
        return F.lit(f"{self.period_end} 23:59:59").cast("timestamp_ntz")

    def in_period(self, ts: Column) -> Column:
        return ts.between(self.start_ts, self.end_ts)

    def of_period(self, df: DataFrame, ts: str) -> DataFrame:
        """Rows of the period. With a day partition the folders of other days are not even listed."""
        rows = df.filter(self.in_period(F.col(ts)))
        if self.day_partition is None:
            return rows
        return rows.filter(F.col(self.day_partition).between(F.lit(self.period_start), F.lit(self.period_end)))


@dataclass(frozen=True)
class LabelSpec:
    """The two labels asked for, the wording of the request and the fallback pair."""

    is_service_description: str = fixed.IS_SERVICE_DESCRIPTION
    category_description: str = fixed.CATEGORY_DESCRIPTION
    topics: tuple = fixed.SERVICE_TOPICS
    other: str = fixed.OTHER_CATEGORY
    failed_is_service: str = fixed.FAILED_IS_SERVICE
    failed_category: str = fixed.FAILED_CATEGORY
    template: str = fixed.PROMPT_TEMPLATE

    def format_instructions(self) -> str:
        fields = {"is_service": self.is_service_description, "category": self.category_description}
        lines = [f'\t"{name}": string  // {text}' for name, text in fields.items()]
        return "\n".join([fixed.FORMAT_INSTRUCTIONS_HEAD, "", "```json", "{", *lines, "}", "```"])

    def prompt_parts(self) -> tuple[str, str]:
        """Text before and after the user input."""
        head, tail = self.template.split("{user_input}")
        return head.replace("{format_instructions}", self.format_instructions()), tail


@dataclass(frozen=True)
class StockConfig:
    """Constants written into every adjustment row."""

    warehouse_code: str = fixed.WAREHOUSE_CODE
    adjust_type: str = fixed.ADJUST_TYPE
    real_stock_mode: str = fixed.REAL_STOCK_MODE
    blank_columns: tuple = field(
        default=("courier", "tracking_no", "receiver_contact", "remark", "sub_order_no")
    )
