"""Retail batch analytics on PySpark: member conversion, session labels, gift stock."""

from storewright.config import ConversionConfig, LabelSpec, StockConfig

__all__ = ["ConversionConfig", "LabelSpec", "StockConfig"]
