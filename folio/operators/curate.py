"""The curated dataset: dedupe catalog -> review dates -> join -> fill -> project."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.config import CURATED_COLUMNS, DEFAULT_FILLS, LOAD_SEQ, ROW_ORDER
from folio.functions.exprs import column, epoch_to_timestamp
from folio.operators.dedupe import dedupe_first
from folio.operators.joins import find_hot_keys, lookup_join
from folio.operators.shaping import project_existing


def with_review_date(reviews: DataFrame, time_col: str = "review_time",
                     out: str = "review_date") -> DataFrame:
    """Add ``out`` (naive timestamp) from Unix seconds, only if ``time_col`` exists."""
    if time_col not in reviews.columns:
        return reviews
    return reviews.withColumn(out, epoch_to_timestamp(time_col))


def fill_defaults(df: DataFrame, fills: Mapping[str, object] = DEFAULT_FILLS) -> DataFrame:
    """Replace NULL with a per-column default (cast to the column's type).

    Columns named in ``fills`` but absent from ``df`` are ignored.  An empty
    string is not NULL and is kept.
    """
    types = dict(df.dtypes)
    return df.select(*[
        F.coalesce(column(c), F.lit(fills[c]).cast(types[c])).alias(c)
        if c in fills and fills[c] is not None else column(c)
        for c in df.columns
    ])


def curate(catalog: DataFrame, reviews: DataFrame, *, key: str = "title",
           catalog_order: Sequence[str | Column] | None = None,
           null_keys: str = "match",
           fills: Mapping[str, object] = DEFAULT_FILLS,
           columns: Sequence[str] = CURATED_COLUMNS,
           hot_keys: Sequence[object] | str | None = None,
           hot_share: float = 0.01, split_nulls: bool = False) -> DataFrame:
    """Curated reviews: one row per review whose ``key`` has a catalog row.

    The catalog is deduplicated first (first row per key by
    ``catalog_order``; without one as loaded, if the catalog has its load
    order, else by the content of the output columns), so the join is many-to-one and never multiplies reviews.  Only
    the catalog columns the output needs reach the join.

    ``hot_keys`` salts known heavy keys in the join; ``"auto"`` finds the
    keys holding at least ``hot_share`` of the reviews first (one grouped
    count, bounded result).  Without it, AQE's skew-join handling splits hot
    partitions at run time.  ``split_nulls`` joins NULL titles separately
    (see ``lookup_join``), so the title-partitioned dedupe output is joined
    without a second shuffle of the catalog.
    """
    if hot_keys == "auto":
        hot_keys = find_hot_keys(reviews, key, min_share=hot_share)
    if catalog_order is None and {LOAD_SEQ, ROW_ORDER} <= set(catalog.columns):
        catalog_order = [LOAD_SEQ, ROW_ORDER]
    wanted = [c for c in columns if c in catalog.columns and c not in reviews.columns]
    if catalog_order is None:
        # Without an order the pick is content-based; only the output columns
        # can tell duplicates apart, so order by those and let the scan skip
        # the rest (long descriptions, links).
        books = dedupe_first(catalog.select(key, *wanted), [key])
    else:
        books = dedupe_first(catalog, [key], catalog_order).select(key, *wanted)
    joined = lookup_join(with_review_date(reviews), books, key, null_keys=null_keys,
                         hot_keys=hot_keys, split_nulls=split_nulls)
    return project_existing(fill_defaults(joined, fills), columns)
