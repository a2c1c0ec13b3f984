"""Data-quality audits: counts, distributions, null profile, ranges, keys.

Each audit is a single aggregation pass per input table that returns a few
rows; only those rows ever leave the cluster.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio import config as C
from folio.config import SCORE_MAX, SCORE_MIN, VOLUME_THRESHOLDS
from folio.functions.exactmean import aggregate_with_mean
from folio.functions.exprs import epoch_in_range, epoch_to_date, inexact_values, ratio_percent
from folio.operators.joins import threshold_lookup
from folio.session import checkpoint_root


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``tabla, registros`` for each labelled table, largest first."""
    parts = [df.agg(F.count(F.lit(1)).alias("registros"))
             .select(F.lit(label).alias("tabla"), "registros")
             for label, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.desc("registros"))


def score_distribution(reviews: DataFrame, score: str = "review_score") -> DataFrame:
    """``score, cantidad, porcentaje`` over non-NULL scores, by score.

    The total is a scalar subquery, so no task sees all distinct scores.
    """
    scored = reviews.filter(F.col(score).isNotNull())
    counted = scored.groupBy(score).agg(F.count(F.lit(1)).alias("cantidad"))
    total = scored.agg(F.count(F.lit(1))).scalar()
    return (counted.select(score, "cantidad",
                           ratio_percent(F.col("cantidad"), total).alias("porcentaje"))
            .orderBy(score))


def null_profile(tables: Mapping[str, DataFrame],
                 metrics: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``metrica, valor``: NULL count per (label, table, column), one pass per table."""
    by_table: dict[str, list[tuple[str, str]]] = {}
    for label, table, column in metrics:
        by_table.setdefault(table, []).append((label, column))
    parts = []
    for table, items in by_table.items():
        cells = [F.struct(F.lit(label).alias("metrica"),
                          F.count_if(F.col(column).isNull()).alias("valor"))
                 for label, column in items]
        parts.append(tables[table].agg(F.array(*cells).alias("m")).select(F.inline("m")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def score_range(reviews: DataFrame, score: str = "review_score",
                low: float = SCORE_MIN, high: float = SCORE_MAX) -> DataFrame:
    """Min, max, mean (2 decimals, half-up) and out-of-range count of non-NULL scores."""
    return _score_summary(reviews.filter(F.col(score).isNotNull()), score, None, low, high)


def _score_summary(scored: DataFrame, score: str, weight: str | None, low: float, high: float) -> DataFrame:
    """The score range of non-NULL scores; ``weight`` counts a row's score so many times."""
    s = F.col(score)
    outside = ~s.between(low, high)
    rows = F.count_if(outside) if weight is None else total_when(outside, F.col(weight))
    others = {"score_minimo": (F.min(s).cast("double"), F.min), "score_maximo": (F.max(s).cast("double"), F.max),
              "fuera_de_rango": (rows, lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long"))}
    return aggregate_with_mean(scored, score, "score_promedio", weight, others=others).select(
        "score_minimo", "score_maximo", "score_promedio", "fuera_de_rango")


def date_range(reviews: DataFrame, time_col: str = "review_time") -> DataFrame:
    """First and last review date (UTC) and the number of timed reviews.

    The bounds skip times outside the representable range (years 1-9999);
    the count includes every non-NULL time.
    """
    t = F.col(time_col)
    valid = F.when(epoch_in_range(t), t)
    return (reviews.filter(t.isNotNull())
            .agg(F.min(valid).alias("_lo"), F.max(valid).alias("_hi"),
                 F.count(F.lit(1)).alias("total_resenas"))
            .select(epoch_to_date("_lo").alias("primera_resena"),
                    epoch_to_date("_hi").alias("ultima_resena"),
                    "total_resenas"))


def key_violations(df: DataFrame, key: str, count_col: str = "n_rows") -> DataFrame:
    """Keys that break uniqueness: NULL, or present more than once."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(key).isNull() | (F.col(count_col) > 1)))


def thresholds_frame(spark: SparkSession,
                     thresholds: Mapping[str, int] = VOLUME_THRESHOLDS) -> DataFrame:
    """``tabla, minimo``: one row per configured threshold, as literals in the plan."""
    rows = [F.struct(F.lit(k).alias("tabla"), F.lit(int(v)).cast("long").alias("minimo"))
            for k, v in thresholds.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def volume_gate(counts: DataFrame, thresholds: DataFrame) -> DataFrame:
    """``tabla, registros, minimo, ok``: every threshold, absent tables count 0."""
    return threshold_lookup(counts, thresholds, "tabla", "registros", "minimo", "ok")


def audit_report(sections: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Stack heterogeneous section frames by column name, tagged with ``seccion``."""
    out = None
    for label, df in sections:
        tagged = df.withColumn("seccion", F.lit(label))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def audit_partials(catalog: DataFrame, reviews: DataFrame, *,
                   null_metrics: Sequence[tuple[str, str, str]] = C.NULL_METRICS,
                   score: str = "review_score", time_col: str = "review_time") -> tuple[DataFrame, DataFrame]:
    """The aggregates all sections come from: reviews by score, and the catalog's one row.

    Partials of several parts of a table may be unioned: ``merge_partials`` adds them up.
    """
    rv_nulls = [c for _, t, c in null_metrics if t == "reviews"]
    cat_nulls = [c for _, t, c in null_metrics if t == "catalog"]
    in_range = F.when(epoch_in_range(time_col), F.col(time_col))
    by_score = reviews.groupBy(score).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_rn{i}") for i, c in enumerate(rv_nulls)],
        F.min(in_range).alias("_tmin"), F.max(in_range).alias("_tmax"), F.count(time_col).alias("_tn"),
        F.count_if(F.col(time_col).isNotNull() & ~epoch_in_range(time_col)).alias("_tbad"))
    cat = catalog.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_cn{i}") for i, c in enumerate(cat_nulls)])
    return by_score, cat


def merge_partials(by_score: DataFrame, cat: DataFrame, score: str = "review_score") -> tuple[DataFrame, DataFrame]:
    """Unions of ``audit_partials`` as the partials of the whole tables."""
    def added(frame: DataFrame) -> list[F.Column]:
        bounds = {"_tmin": F.min, "_tmax": F.max}
        return [bounds[c](c).alias(c) if c in bounds else F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
                for c in frame.columns if c != score]

    return by_score.groupBy(score).agg(*added(by_score)), cat.agg(*added(cat))


def audit_sections(catalog: DataFrame | None, reviews: DataFrame | None, *,
                   catalog_label: str = C.CATALOG_LABEL, reviews_label: str = C.REVIEWS_LABEL,
                   null_metrics: Sequence[tuple[str, str, str]] = C.NULL_METRICS,
                   score: str = "review_score", time_col: str = "review_time",
                   low: float = SCORE_MIN, high: float = SCORE_MAX,
                   materialize: bool = True,
                   partials: tuple[DataFrame, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All audit sections from one pass over each table.

    Reviews are aggregated once per distinct score (count, per-column NULL
    counts, time bounds) and the catalog once globally; every section is
    derived from those two small frames.  With ``materialize`` they are
    checkpointed (a reliable checkpoint in the session's shared checkpoint
    folder, which also cuts the lineage), so every later action -- gate,
    report, date range -- reads the aggregates, never the tables again:
    one scan per table in total.  Without it, each section re-plans its own
    pruned aggregate.  ``partials`` are used in place of the tables'.  Keys: ``counts``, ``distribution``, ``nulls``,
    ``score_range``, ``date_range`` and ``left_out`` (times no timestamp can
    hold; scores too large, or not finite, for a plain decimal).
    """
    s, n = F.col(score), F.col("_n")
    rv_nulls = [(label, c) for label, t, c in null_metrics if t == "reviews"]
    cat_nulls = [(label, c) for label, t, c in null_metrics if t == "catalog"]
    by_score, cat = partials or audit_partials(catalog, reviews, null_metrics=null_metrics, score=score, time_col=time_col)
    if materialize:
        checkpoint_root(by_score.sparkSession)
        by_score = by_score.checkpoint(eager=True)
        cat = cat.checkpoint(eager=True)

    def total(col: str) -> F.Column:
        return F.coalesce(F.sum(col), F.lit(0)).cast("long")

    counts = (cat.select(F.lit(catalog_label).alias("tabla"), n.alias("registros"))
              .unionByName(by_score.agg(total("_n").alias("registros"))
                           .select(F.lit(reviews_label).alias("tabla"), "registros"))
              .orderBy(F.desc("registros")))

    scored = by_score.filter(s.isNotNull())
    if materialize:
        # the aggregate is already written: read its total as one scalar, so
        # the shares need no single-partition window
        scored_total = F.lit(scored.agg(F.sum(n)).first()[0]).cast("long")
    else:
        scored_total = scored.agg(F.sum(n)).scalar()
    distribution = (scored.select(score, n.alias("cantidad"))
                    .select(score, "cantidad",
                            ratio_percent(F.col("cantidad"), scored_total).alias("porcentaje"))
                    .orderBy(score))

    parts = []
    if rv_nulls:
        cells = [F.struct(F.lit(label).alias("metrica"), total(f"_rn{i}").alias("valor"))
                 for i, (label, _) in enumerate(rv_nulls)]
        parts.append(by_score.agg(F.array(*cells).alias("m")).select(F.inline("m")))
    if cat_nulls:
        cells = [F.struct(F.lit(label).alias("metrica"), F.col(f"_cn{i}").alias("valor"))
                 for i, (label, _) in enumerate(cat_nulls)]
        parts.append(cat.select(F.array(*cells).alias("m")).select(F.inline("m")))
    nulls = parts[0]
    for p in parts[1:]:
        nulls = nulls.unionByName(p)

    score_rng = _score_summary(scored, score, "_n", low, high)

    dates = by_score.agg(F.min("_tmin").alias("_lo"), F.max("_tmax").alias("_hi"),
                         total("_tn").alias("total_resenas")).select(
        epoch_to_date("_lo").alias("primera_resena"),
        epoch_to_date("_hi").alias("ultima_resena"), "total_resenas")
    # times that the dates above leave out, and scores that the mean adds by exponent
    left_out = by_score.agg(total("_tbad").alias("times_out_of_range"),
                            inexact_values(s, n).alias("scores_not_exact"))
    return {"counts": counts, "distribution": distribution, "nulls": nulls,
            "score_range": score_rng, "date_range": dates, "left_out": left_out}


def total_when(cond: F.Column, value: F.Column) -> F.Column:
    """Aggregate: sum of ``value`` where ``cond`` holds, 0 when none."""
    return F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("long")


def fused_audit_report(catalog: DataFrame, reviews: DataFrame, **kwargs) -> DataFrame:
    """The four-section report from ``audit_sections`` (one scan per table)."""
    sec = audit_sections(catalog, reviews, **kwargs)
    return audit_report([
        (C.SECTION_COUNTS, sec["counts"]),
        (C.SECTION_DISTRIBUTION, sec["distribution"]),
        (C.SECTION_NULLS, sec["nulls"]),
        (C.SECTION_SCORE_RANGE, sec["score_range"]),
    ])
