"""Price history on Spark: import, merge, back-adjust and look up stock prices."""

from pricefold.store import AdjustReport, ImportReport, MergeReport, PriceStore

__all__ = ["AdjustReport", "ImportReport", "MergeReport", "PriceStore"]
