"""CSV export of report results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

# File names of the dashboard exports
SALES_EXPORTS = {"monthly": "ventes_mensuelles", "regions": "ventes_regions", "weekdays": "ventes_hebdo"}
PROMOTION_EXPORTS = {"categories": "promo_categories", "regions": "promo_regions", "discounts": "promo_remises"}


def export_csv(df: DataFrame, folder: str, name: str, as_of: dt.date | None = None) -> str:
    """Write a report with a header under a dated name; returns the folder written.

    Spark picks the number of files: a report is small after adaptive
    coalescing and gives one file, while a large frame is not forced through a
    single task. NULL and empty text both come out empty.
    """
    stamp = (as_of or dt.date.today()).strftime("%Y%m%d")
    target = f"{folder.rstrip('/')}/{name}_{stamp}"
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(target)
    return target
