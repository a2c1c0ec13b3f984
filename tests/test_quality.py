from __future__ import annotations

import datetime as dt

import pytest

from pyspark.sql import functions as F

from folio import config as C
from folio.operators import quality as QA
from folio.operators.joins import orphan_keys
from folio.plans.inspect import count_nodes


def _scores(spark, values):
    return spark.createDataFrame([(v,) for v in values], "review_score double")


def test_score_range_bounds_inclusive_and_null_ignored(spark):
    row = QA.score_range(_scores(spark, [0.0, 1.0, 5.0, 6.0, None])).first()
    assert row.fuera_de_rango == 2
    assert row.score_minimo == 0.0 and row.score_maximo == 6.0
    assert row.score_promedio == 3.0


def test_score_range_empty_input(spark):
    row = QA.score_range(_scores(spark, [])).first()
    assert row.score_minimo is None and row.score_maximo is None
    assert row.score_promedio is None and row.fuera_de_rango == 0


def test_mean_rounds_half_up(spark):
    # 1.125 -> 1.13 (half away from zero, exact decimal)
    row = QA.score_range(_scores(spark, [1.0, 1.25, 1.0, 1.25])).first()
    assert row.score_promedio == 1.13


def test_distribution_share_rounding(spark):
    values = [1.0] * 201 + [2.0] * (20000 - 201)
    out = {r.review_score: r for r in QA.score_distribution(_scores(spark, values)).collect()}
    assert out[1.0].cantidad == 201 and out[1.0].porcentaje == 1.01
    assert out[2.0].porcentaje == 99.0   # 98.995 rounds half up


def test_distribution_excludes_null_and_sorts(spark):
    out = QA.score_distribution(_scores(spark, [3.0, None, 1.0, 3.0])).collect()
    assert [(r.review_score, r.cantidad) for r in out] == [(1.0, 1), (3.0, 2)]
    assert abs(sum(r.porcentaje for r in out) - 100) < 0.01


def test_table_counts_sorted_desc(spark, catalog, reviews):
    out = QA.table_counts({C.CATALOG_LABEL: catalog, C.REVIEWS_LABEL: reviews}).collect()
    assert [(r.tabla, r.registros) for r in out] == [(C.REVIEWS_LABEL, 6), (C.CATALOG_LABEL, 5)]


def test_volume_gate_threshold_inclusive_and_absent_table(spark, catalog):
    counts = QA.table_counts({"t_equal": catalog})
    th = QA.thresholds_frame(spark, {"t_equal": 5, "t_absent": 1})
    got = {r.tabla: r for r in QA.volume_gate(counts, th).collect()}
    assert got["t_equal"].ok is True and got["t_equal"].registros == 5
    assert got["t_absent"].registros == 0 and got["t_absent"].ok is False


def test_null_profile_values_and_one_scan_per_table(spark, catalog, reviews, tmp_out):
    catalog.write.parquet(f"{tmp_out}/c")
    reviews.write.parquet(f"{tmp_out}/r")
    c, r = spark.read.parquet(f"{tmp_out}/c"), spark.read.parquet(f"{tmp_out}/r")
    out = QA.null_profile({"catalog": c, "reviews": r}, C.NULL_METRICS)
    got = {row.metrica: row.valor for row in out.collect()}
    assert got == {
        "books_rating.review_score nulos": 2, "books_rating.user_id nulos": 0,
        "books_rating.title nulos": 2, "books_rating.review_time nulos": 1,
        "books_data.title nulos": 2, "books_data.authors nulos": 2,
    }
    assert count_nodes(out, "Scan parquet") == 2


def test_date_range(spark, reviews):
    row = QA.date_range(reviews).first()
    assert row.primera_resena == dt.date(1969, 12, 31)
    assert row.ultima_resena == dt.date(1970, 1, 4)
    assert row.total_resenas == 5


def test_key_violations(catalog):
    got = {r.title: r.n_rows for r in QA.key_violations(catalog, "title").collect()}
    assert got == {"X": 2, None: 2}


def test_orphans_exempt_null(catalog, reviews):
    got = {r.title: r.n_reviews for r in orphan_keys(reviews, catalog, "title").collect()}
    assert got == {"Y": 1}


def test_audit_report_columns(spark, catalog, reviews):
    report = QA.audit_report([
        (C.SECTION_COUNTS, QA.table_counts({C.CATALOG_LABEL: catalog, C.REVIEWS_LABEL: reviews})),
        (C.SECTION_DISTRIBUTION, QA.score_distribution(reviews)),
        (C.SECTION_NULLS, QA.null_profile({"catalog": catalog, "reviews": reviews}, C.NULL_METRICS)),
        (C.SECTION_SCORE_RANGE, QA.score_range(reviews)),
    ])
    assert report.columns == ["tabla", "registros", "seccion", "review_score", "cantidad",
                              "porcentaje", "metrica", "valor", "score_minimo", "score_maximo",
                              "score_promedio", "fuera_de_rango"]
    assert dict(report.dtypes)["registros"] == "bigint"
    sections = {r.seccion: r["count"] for r in report.groupBy("seccion").count().collect()}
    assert sections == {C.SECTION_COUNTS: 2, C.SECTION_DISTRIBUTION: 4, C.SECTION_NULLS: 6,
                        C.SECTION_SCORE_RANGE: 1}
    assert report.filter(F.col("seccion") == C.SECTION_COUNTS).first().tabla is not None


def test_audit_job_one_scan_per_table_and_same_sections(spark, catalog, reviews, tmp_out):
    from folio.plans.inspect import plan_text
    from folio.plans.jobs import audit_job
    res = audit_job(spark, catalog, reviews, thresholds={C.CATALOG_LABEL: 5, C.REVIEWS_LABEL: 7},
                    report_path=f"{tmp_out}/report")
    assert res.gate == [(C.CATALOG_LABEL, 5, 5, True), (C.REVIEWS_LABEL, 6, 7, False)] or \
        sorted(res.gate) == sorted([(C.CATALOG_LABEL, 5, 5, True), (C.REVIEWS_LABEL, 6, 7, False)])
    assert res.passed is False and res.out_of_range == 0
    # sections equal the stand-alone audits
    key = lambda r: tuple((v is None, str(v)) for v in r)
    separate = QA.audit_report([
        (C.SECTION_COUNTS, QA.table_counts({C.CATALOG_LABEL: catalog, C.REVIEWS_LABEL: reviews})),
        (C.SECTION_DISTRIBUTION, QA.score_distribution(reviews)),
        (C.SECTION_NULLS, QA.null_profile({"catalog": catalog, "reviews": reviews}, C.NULL_METRICS)),
        (C.SECTION_SCORE_RANGE, QA.score_range(reviews)),
    ])
    assert res.report.columns == separate.columns
    assert sorted(res.report.collect(), key=key) == sorted(separate.collect(), key=key)
    assert sorted(res.date_range.collect()) == sorted(QA.date_range(reviews).collect())
    # the report reads the checkpointed aggregates, not the inputs
    assert "LocalTableScan" not in plan_text(res.report, "simple")
    back = spark.read.option("header", True).csv(f"{tmp_out}/report")
    assert back.count() == 2 + 4 + 6 + 1


def test_audit_sections_on_empty_reviews(spark, catalog):
    empty = spark.createDataFrame([], "title string, review_score double, review_time long, user_id string")
    sec = QA.audit_sections(catalog, empty)
    assert {r.tabla: r.registros for r in sec["counts"].collect()} == {C.CATALOG_LABEL: 5, C.REVIEWS_LABEL: 0}
    row = sec["score_range"].first()
    assert row.score_minimo is None and row.score_promedio is None and row.fuera_de_rango == 0
    assert sec["distribution"].count() == 0
    assert sec["date_range"].first().total_resenas == 0


def test_mean_survives_values_outside_decimal_range(spark):
    huge = _scores(spark, [1.0, 1e300, None])
    row = QA.score_range(huge).first()
    assert row.score_promedio == 5e299 and row.fuera_de_rango == 1
    inf = _scores(spark, [1.0, float("inf")])
    assert QA.score_range(inf).first().score_promedio == float("inf")
    sec = QA.audit_sections(spark.createDataFrame([], "title string, authors string"),
                            huge.selectExpr("review_score", "CAST(NULL AS STRING) AS user_id",
                                            "'t' AS title", "CAST(NULL AS BIGINT) AS review_time"),
                            materialize=False)
    assert sec["score_range"].first().score_promedio == 5e299


def test_weighted_mean_matches_plain_mean(spark):
    vals = [1.0, 1.25, 1.0, 1.25, 5.0, 3.5]
    plain = QA.score_range(_scores(spark, vals)).first().score_promedio
    sec = QA.audit_sections(spark.createDataFrame([], "title string, authors string"),
                            _scores(spark, vals).selectExpr(
                                "review_score", "CAST(NULL AS STRING) AS user_id", "'t' AS title",
                                "CAST(NULL AS BIGINT) AS review_time"), materialize=False)
    assert sec["score_range"].first().score_promedio == plain == 2.17


def test_exact_mean_is_rounded_once(spark):
    for values, mean in (([1.00495], 1.0), ([2.344995], 2.34), ([1.005, 1.005], 1.01), ([1e300, 1.0], None)):
        df = spark.createDataFrame([(v,) for v in values], "review_score double")
        got = QA.score_range(df).first()["score_promedio"]
        fused = QA.audit_sections(df.selectExpr("1 AS title", "2 AS authors"), df.selectExpr(
            "review_score", "'u' AS user_id", "'t' AS title", "CAST(9e17 AS BIGINT) AS review_time"), materialize=False)
        assert fused["score_range"].first()["score_promedio"] == got
        left_out = fused["left_out"].first()
        assert left_out["times_out_of_range"] == len(values)
        if mean is None:
            assert left_out["scores_not_exact"] == 1
        else:
            assert got == mean and left_out["scores_not_exact"] == 0


def test_hot_key_share_is_bounded(spark):
    from folio.operators.joins import find_hot_keys
    with pytest.raises(ValueError):
        find_hot_keys(spark.range(3), "id", min_share=1e-9)
