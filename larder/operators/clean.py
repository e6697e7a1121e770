"""Raw to clean: declared rules per table, one generic job.

All column rules are narrow expressions in a single projection; the only
shuffle is the de-duplication on the table key.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from itertools import groupby
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from larder.functions import rules


@dataclass(frozen=True)
class Cleaning:
    source: str
    target: str
    key: tuple[str, ...]
    blank: tuple[str, ...] = ()
    trim: tuple[str, ...] = ()
    email: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)
    interval: tuple[str, str] | None = None
    newest: str | None = None
    # order of rows inside stored files, so that scans filtering on these skip row groups
    layout: tuple[str, ...] = ()


CLEANINGS: dict[str, Cleaning] = {
    c.source: c
    for c in (
        Cleaning(
            "customer_demographics", "customer_demographics_clean", ("customer_id",),
            blank=("name", "gender", "region", "country", "city", "marital_status"),
            non_negative=("annual_income",),
        ),
        Cleaning(
            "customer_service_interactions", "customer_service_interactions_clean",
            ("interaction_id",),
            blank=("interaction_id", "interaction_type", "issue_category", "resolution_status",
                   "follow_up_required"),
            trim=("description",),
            non_negative=("duration_minutes",),
            ranges={"customer_satisfaction": (1, 5)},
        ),
        Cleaning(
            "financial_transactions", "financial_transactions_clean", ("transaction_id",),
            blank=("transaction_id", "transaction_type", "payment_method", "entity", "region",
                   "account_code"),
            non_negative=("amount",),
            layout=("transaction_type", "region", "transaction_date"),
        ),
        Cleaning(
            "promotions_data", "promotions_clean", ("promotion_id",),
            blank=("promotion_id", "product_category", "promotion_type", "region"),
            ranges={"discount_percentage": (0, 1)},
            interval=("start_date", "end_date"),
        ),
        Cleaning(
            "marketing_campaigns", "marketing_campaigns_clean", ("campaign_id",),
            blank=("campaign_id", "campaign_name", "campaign_type", "product_category",
                   "target_audience", "region"),
            non_negative=("budget", "reach"),
            ranges={"conversion_rate": (0, 1)},
        ),
        Cleaning(
            "product_reviews", "product_reviews_clean", ("review_id",),
            blank=("product_id", "reviewer_id", "reviewer_name", "product_category"),
            trim=("review_title", "review_text"),
            ranges={"rating": (1, 5)},
        ),
        Cleaning(
            "logistics_and_shipping", "logistics_and_shipping_clean", ("shipment_id",),
            blank=("shipment_id", "order_id", "shipping_method", "status", "destination_region",
                   "destination_country", "carrier"),
            non_negative=("shipping_cost",),
            interval=("ship_date", "estimated_delivery"),
        ),
        Cleaning(
            "supplier_information", "supplier_information_clean", ("supplier_id",),
            blank=("supplier_id", "supplier_name", "product_category", "region", "country", "city",
                   "quality_rating"),
            non_negative=("lead_time",),
            ranges={"reliability_score": (0, 1)},
        ),
        Cleaning(
            "employee_records", "employee_records_clean", ("employee_id",),
            blank=("employee_id", "name", "department", "job_title", "region", "country"),
            email=("email",),
            non_negative=("salary",),
        ),
        Cleaning(
            "inventory", "inventory_clean", ("product_id", "country", "warehouse"),
            blank=("product_id", "product_category", "region", "country", "warehouse"),
            non_negative=("current_stock", "reorder_point", "lead_time"),
            newest="last_restock_date",
        ),
        Cleaning(
            "store_locations", "store_locations_clean", ("store_id",),
            blank=("store_id", "store_name", "store_type", "region", "country", "city", "address",
                   "postal_code"),
            non_negative=("square_footage", "employee_count"),
        ),
    )
}


def apply_rules(df: DataFrame, spec: Cleaning, strict_blanks: bool = False) -> DataFrame:
    """The column rules alone, without de-duplication. Row count is unchanged."""

    def ruled(name: str):
        c = F.col(name)
        if name in spec.blank:
            c = rules.blank_to_null(c, strict_blanks)
        elif name in spec.trim:
            c = rules.trim_only(c)
        elif name in spec.email:
            c = rules.normalize_email(c)
        elif name in spec.non_negative:
            c = rules.non_negative(c)
        elif name in spec.ranges:
            c = rules.in_range(c, *spec.ranges[name])
        elif spec.interval and name == spec.interval[1]:
            c = rules.fix_end(F.col(spec.interval[0]), c)
        return c.alias(name)

    return df.select(*map(ruled, df.columns))


# ends a text, and stands before one that is there or missing
_END, _THERE, _MISSING = "\u0000", "\u0002", "\u0003"
# characters not above the end of a text, and what stands for them
_ESCAPED = {"\u0001": "\u0001\u0002", "\u0000": "\u0001\u0001"}


def pack_texts(names: list[str]) -> Column:
    """Several text columns in one, which sorts as they do one after the other, NULLs last."""

    def packed(name: str) -> Column:
        text = escaped = F.col(name)
        for char, instead in _ESCAPED.items():
            escaped = F.replace(escaped, F.lit(char), F.lit(instead))
        rare = reduce(or_, [text.contains(char) for char in _ESCAPED])
        return F.coalesce(F.concat(F.lit(_THERE), F.when(rare, escaped).otherwise(text)), F.lit(_MISSING))

    return F.concat_ws(_END, *map(packed, names))


def unpack_texts(parts: str, names: list[str]) -> list[Column]:
    """The columns that ``pack_texts`` made one of, from its result split at ``_END``."""

    def unpacked(k: int) -> Column:
        text = plain = F.expr(f"substr({parts}[{k}], 2)")
        for char, instead in reversed(_ESCAPED.items()):
            plain = F.replace(plain, F.lit(instead), F.lit(char))
        plain = F.when(text.contains("\u0001"), plain).otherwise(text)
        return F.when(F.startswith(F.col(parts)[k], F.lit(_THERE)), plain)

    return [unpacked(k).alias(name) for k, name in enumerate(names)]


def keep_one(df: DataFrame, key: tuple[str, ...], newest: str | None = None) -> DataFrame:
    """One row per key; rows whose key is NULL count as one group.

    The survivor is the row with the latest ``newest`` (NULLs last), then the
    smallest in the remaining columns, so reruns agree. Spark cuts each key to
    one row inside every map task before the shuffle (WindowGroupLimit), so a
    key that holds a large part of the table does not reach one reducer whole.
    Text columns that follow each other are shuffled as one, without the place
    and the padding that a row keeps for each.
    """
    texts = {f.name for f in df.schema if f.dataType == T.StringType()}
    rest = [c for c in df.columns if c not in key and c != newest]
    runs = [list(run) for _, run in groupby(rest, texts.__contains__)]
    together = {f"_texts_{k}": run for k, run in enumerate(runs) if len(run) > 1 and run[0] in texts}
    moved = {c for run in together.values() for c in run}
    rows = df.select(*[c for c in df.columns if c not in moved], *[pack_texts(run).alias(p) for p, run in together.items()])
    packs = {run[0]: p for p, run in together.items()}
    order = [F.col(newest).desc_nulls_last()] if newest else []
    order += [F.col(packs.get(c, c)).asc_nulls_last() for c in rest if c in packs or c not in moved]
    position = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    kept = rows.withColumn("_position", position).filter("_position = 1").withColumns(
        {p: F.split(p, _END, -1) for p in together}
    )
    back = {c: e for p, run in together.items() for c, e in zip(run, unpack_texts(p, run))}
    return kept.select(*[back.get(c, F.col(c)) for c in df.columns])


def clean(df: DataFrame, table: str, strict_blanks: bool = False) -> DataFrame:
    """Clean rows of a raw table named in ``CLEANINGS``."""
    spec = CLEANINGS[table]
    return keep_one(apply_rules(df, spec, strict_blanks), spec.key, spec.newest)


def clean_keys(df: DataFrame, table: str) -> DataFrame:
    """The keys that ``clean`` keeps a row for, without ordering the rows of a key."""
    spec = CLEANINGS[table]
    return apply_rules(df, spec).select(*spec.key).distinct()


def laid_out(cleaned: DataFrame, table: str) -> DataFrame:
    """Clean rows in the order they are stored in: sorted inside each partition, no shuffle."""
    layout = CLEANINGS[table].layout
    return cleaned.sortWithinPartitions(*layout) if layout else cleaned
