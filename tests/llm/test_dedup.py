"""Operators 5, 6 and 7 against plain Python."""

import brute
import pytest
from pyspark.sql import functions as F

from folio.llm import jaccard_join, line_dedup, substring_dedup
from folio.llm.components import connected_components


def _plain(corpus):
    return [(i, t) for i, t, _ in corpus]


def _as_dict(frame, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in frame.collect()}


def test_substring_dedup_equals_brute_force(docs, corpus):
    out = substring_dedup.cut_repeats(docs).withColumn("sha", F.sha2("_kept_text", 256))
    assert _as_dict(out, "_n_words", "_n_removed", "sha") == brute.cut_repeats(_plain(corpus))


def test_substring_spans_are_maximal_and_name_the_removed_words(docs, corpus):
    rows = substring_dedup.cut_repeats(docs).where("_n_removed > 0").collect()
    assert rows
    for r in rows:
        words = r["text"].encode().split()
        ends = [tuple(s) for s in r["_spans"]]
        assert all(b - a >= 50 for a, b in ends) and all(x[1] < y[0] for x, y in zip(ends, ends[1:]))
        kept = [w for i, w in enumerate(words) if not any(a <= i < b for a, b in ends)]
        assert b" ".join(kept).decode() == r["_kept_text"]


def test_substring_repeat_only_between_later_documents(spark):
    """The smallest holder of a seed differs from the documents that repeat each other around it."""
    body = [f"w{i}" for i in range(60)]
    docs = [(1, " ".join(["x"] * 3 + body[20:45] + [f"y{i}" for i in range(40)])), (2, " ".join(["p"] + body)),
            (3, " ".join(["q", "r"] + body)), (4, " ".join(body[:49])), (5, " ".join(body[5:]))]
    out = substring_dedup.cut_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    got = _as_dict(out.withColumn("sha", F.sha2("_kept_text", 256)), "_n_words", "_n_removed", "sha")
    assert got == brute.cut_repeats(docs)
    assert got[3][1] == 60 and got[4][1] == 0


def test_line_dedup_equals_brute_force(docs, corpus):
    out = line_dedup.dedup_lines(docs).withColumn("sha", F.sha2("text", 256))
    assert _as_dict(out, "_n_lines", "_n_dropped", "sha") == brute.dedup_lines(_plain(corpus))


@pytest.mark.parametrize("batches", [1, 7])
def test_line_dedup_does_not_depend_on_batches(docs, corpus, batches):
    out = line_dedup.dedup_lines(docs, batches=batches).withColumn("sha", F.sha2("text", 256))
    assert _as_dict(out, "_n_lines", "_n_dropped", "sha") == brute.dedup_lines(_plain(corpus))


def test_line_runs_are_compacted_and_hold_each_key_once(spark, docs, tmp_path):
    runs = line_dedup.LineRuns(spark, str(tmp_path / "runs"), fanout=2)
    line_dedup.dedup_lines(docs, runs, batches=5).count()
    assert all(len(level) < 2 for level in runs.level) and len(runs.level) >= 3
    keys = runs.read()
    assert keys.count() == keys.select("k1", "k2").distinct().count() > 0


def test_runs_persist_for_later_batches(spark, tmp_path):
    """A later delivery loses the lines that an earlier one brought."""
    runs = line_dedup.LineRuns(spark, str(tmp_path / "runs"))
    schema = "doc_id long, text string"
    line_dedup.dedup_lines(spark.createDataFrame([(1, "a line of text\nother")], schema), runs, 1).count()
    late = spark.createDataFrame([(7, "new words here\nA LINE of text ")], schema)
    assert line_dedup.dedup_lines(late, runs, 1).first()["text"] == "new words here"


def test_rows_of_one_id_lose_their_own_lines_only(spark):
    docs = [(1, "a line of text\nanother long line"), (2, "a line of text\nthe first text's own"),
            (2, "the second text's own\nanother long line"), (2, "a line of text\nthe first text's own"),
            (None, "seen without an id\nfor the first time"), (None, "other without an id\nseen without an id")]
    out = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(((r["doc_id"], r["text"], r["_n_dropped"]) for r in out.collect()), key=str) == sorted([
        (1, docs[0][1], 0), (2, "the first text's own", 1), (2, "the second text's own", 1), (2, "the first text's own", 1),
        (None, docs[4][1], 0), (None, docs[5][1], 0)], key=str)


def test_jaccard_components_equal_brute_force(docs, corpus):
    out = jaccard_join.similar_documents(docs)
    assert _as_dict(out, "n_shingles", "component_id") == brute.components(_plain(corpus))


def test_jaccard_needs_the_tree_join(spark):
    """The first of a branch links with none of the others, which link among themselves."""
    head = [f"h{i}" for i in range(60)]
    rows = [(0, " ".join(head + [f"a{i}" for i in range(14)]))]
    for k in range(1, 9):
        rows.append((k, " ".join(head + [f"b{i}" for i in range(12)] + [f"c{k}"])))
    rows += [(20 + k, " ".join([f"z{k}_{i}" for i in range(60)])) for k in range(3)]
    out = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert _as_dict(out, "n_shingles", "component_id") == brute.components(rows)


def test_jaccard_large_branches_are_tiled(docs, corpus, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", 3)
    monkeypatch.setattr(jaccard_join, "LEAF", 2)
    out = jaccard_join.similar_documents(docs)
    assert _as_dict(out, "n_shingles", "component_id") == brute.components(_plain(corpus))


def test_jaccard_order_of_frequent_shingles_does_not_matter(docs, corpus, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT_DOCS", 2)
    out = jaccard_join.similar_documents(docs)
    assert _as_dict(out, "n_shingles", "component_id") == brute.components(_plain(corpus))


def test_components_of_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(100, 180)]
    hub = [(5, i) for i in range(1000, 1100)]
    edges = spark.createDataFrame(path + hub + [(7, 7), (3, 2), (2, 3)], "a long, b long")
    found = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert {found[i] for i in range(100, 181)} == {100}
    assert {found[i] for i in range(1000, 1100)} | {found[5]} == {5}
    assert found[3] == found[2] == 2


def test_keep_one_of_each_group(spark, docs, corpus):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    expected = sorted(i for i, (n, c) in brute.components(_plain(corpus)).items() if c == i)
    assert sorted(r["doc_id"] for r in kept.collect()) == expected


def test_empty_tables(no_docs):
    assert substring_dedup.cut_repeats(no_docs).count() == 0
    assert line_dedup.dedup_lines(no_docs).count() == 0
    assert jaccard_join.similar_documents(no_docs).count() == 0
    assert jaccard_join.keep_one(no_docs).count() == 0


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(None, text, 1, "x"), (None, text, 2, "y"), (4, text, 3, "z"), (4, text, 3, "z"), (9, "short line here", 4, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _n_words int, token string")
    cut = substring_dedup.cut_repeats(docs).orderBy("token").collect()
    # rows without an id are one document and the smallest; repeated rows do not cut each other
    assert [(r["token"], r["_n_removed"]) for r in cut] == [("q", 0), ("x", 0), ("y", 0), ("z", 80), ("z", 80)]
    lines = line_dedup.dedup_lines(docs).orderBy("token").collect()
    assert [(r["token"], r["_n_dropped"]) for r in lines] == [("q", 0), ("x", 0), ("y", 0), ("z", 1), ("z", 1)]
    similar = jaccard_join.similar_documents(docs)
    assert similar.count() == 5
    assert {r["component_id"] for r in similar.where("doc_id = 4").collect()} == {None}
    kept = jaccard_join.keep_one(docs).orderBy("token").collect()
    assert [(r["token"], r["_n_words"]) for r in kept] == [("q", 4), ("z", 3)]


def test_unlike_texts_of_one_id_are_kept_apart(spark):
    text, other = (" ".join(f"{a}{i}" for i in range(60)) for a in "tu")
    rows = [(1, text, "a"), (2, text, "b"), (2, other, "c"), (3, other, "d"), (4, None, "e"), (4, "", "f"), (4, None, "g")]
    for at in range(2):
        docs = spark.createDataFrame([r for r in rows if at or r[0] < 3], "doc_id long, text string, __id string")
        kept = {r["__id"] for r in jaccard_join.keep_one(docs).collect()}
        assert "a" in kept and "b" not in kept
        assert len(kept & {"c", "d"}) == 1  # of the other text, one row
        assert not at or ("f" in kept and len(kept & {"e", "g"}) == 1)
