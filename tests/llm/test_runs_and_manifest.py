"""Operators 12 and 13 against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from folio.llm import merkle_manifest as M
from folio.llm import periodic_runs as P
from folio.llm import queries
from folio.llm.words import split_words, word_hashes


def texts(rng, k):
    out = []
    for _ in range(k):
        letters, n = rng.choice([1, 2, 2, 3, 6]), rng.randrange(0, 50)
        w = [f"w{rng.randrange(letters)}" for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randrange(3, 11)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("least", [(6, 4), (4, 2), (9, 3)])
def test_runs_equal_brute_force(least):
    rng = random.Random(11)
    for _ in range(120):
        own = texts(rng, 4)
        words = split_words([t.encode() for t in own])
        assert P.runs_of(word_hashes(words), words.ptr, *least) == [brute.periodic_runs(t.split(), *least) for t in own]


def test_a_long_text_of_one_word_and_a_long_one_of_many_phrases():
    rng = random.Random(2)
    phrases = " ".join(f"the common phrase of five words {rng.randrange(10 ** 9)}" for _ in range(8000))
    words = split_words([b"a " * 60_000, phrases.encode()])
    assert P.runs_of(word_hashes(words), words.ptr) == [[(0, 60_000, 1)], []]


@pytest.fixture
def on_table(spark, tmp_path):
    """Runs a registered query over a table of its own."""
    def run(name, rows, schema):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        return sorted(map(str, map(tuple, queries.QUERIES[name](spark, f"{tmp_path}/{name}").collect())))
    return run


def test_op12_equals_brute_force(on_table, corpus):
    rng = random.Random(5)
    rows = [(i, t) for i, t, _ in corpus] + [(1000 + i, t) for i, t in enumerate(texts(rng, 200))]
    rows += [(1000, "a repeat of an id"), (None, "x y " * 9), (None, None), (1003, " ")]
    assert on_table("op12_periodic_runs", rows, "doc_id long, text string") == sorted(
        str(brute.run_row(*r)) for r in rows)


def test_runs_leave_other_columns_alone_and_replace_clashing_ones(spark):
    frame = spark.createDataFrame([("k", "a a a a a a a b", 1, "x")], "id string, text string, _runs int, run string")
    row = P.find_runs(frame).first()
    assert (row["id"], row["run"], row["_n_words"], row["_collapsed"]) == ("k", "x", 8, "a b")
    assert [tuple(r) for r in row["_runs"]] == [(0, 7, 1)]
    assert P.find_runs(frame.limit(0)).count() == 0


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.fixture(scope="module")
def manifest_rows():
    rng = random.Random(9)
    rows = [(i, rng.choice(["s", None]), rng.choice(["en"] * 6 + ["fr", "é", "zz"]), rng.choice([None, i]),
             rng.choice([f"Text {i}", "", None, "ÀB ÉC"])) for i in rng.sample(range(5000), 700)]
    rows += [(9000 + i, "s", None, 1, "T") for i in range(8)] + [(9100, "s", "one", 1, "T"), (9200, "s", "", 1, "T")]
    rows += [rows[0], rows[0], (rows[1][0], *rows[2][1:]), (None, None, "en", None, None), (None, "x", "en", 1, "Y")]
    return rows


def test_op13_equals_brute_force(on_table, manifest_rows):
    assert on_table("op13_merkle_manifest", manifest_rows, DOCS) == sorted(map(str, brute.merkle(manifest_rows)))


@pytest.mark.parametrize("n", [0, 1, 8, 9])
def test_op13_small_tables(on_table, n):
    rows = [(i, "s", "en", 1, f"Text {i}") for i in range(n)]
    assert on_table("op13_merkle_manifest", rows, DOCS) == sorted(map(str, brute.merkle(rows)))


def test_positions_do_not_depend_on_tasks_and_windows_stay_in_blocks(spark, manifest_rows):
    rows = spark.createDataFrame(manifest_rows, DOCS).select(
        "lang", "doc_id", M.leaf_hash(F.col("doc_id"), F.col("text")).alias("leaf"), F.lit(1).alias("pos"),
        F.lit("x").alias("hash"))
    roots = {M.build(rows.repartition(n), "lang", "doc_id", "leaf", keep=["pos", "hash"]).root for n in (1, 7)}
    assert len(roots) == 1
    proofs = M.proofs(M.build(rows, "lang", "doc_id", "leaf", keep=["pos", "hash"]))
    assert proofs.columns == ["pos", "hash", "leaf", "subroot", "root", "path"]
    assert proofs.where(M.fold("leaf", "path") != F.col("root")).count() == 0
