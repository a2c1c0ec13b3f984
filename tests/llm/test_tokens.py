"""Operators 1 and 2: exact round trips and full re-encoding."""

import glob
import os

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folio.llm import queries
from folio.llm import token_counts as TC
from folio.llm import token_output as TO
from folio.llm import tokens

with open(tokens.VOCABULARY, "rb") as f:
    VOCABULARY = f.read()
ENCODE = tokens.encoder(VOCABULARY).encode_ordinary
END = tokens.end_of_text(VOCABULARY)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**40))
def test_permutation_is_a_bijection(size, key):
    out = TO.permute(np.arange(size), size, key)
    assert sorted(out.tolist()) == list(range(size))


def test_permutation_depends_on_the_key_and_mixes():
    a, b = (TO.permute(np.arange(5000), 5000, k) for k in (1, 2))
    assert (a != b).mean() > 0.99
    assert abs(np.corrcoef(a, np.arange(5000))[0, 1]) < 0.05
    assert np.array_equal(a[100:200], TO.permute(np.arange(100, 200), 5000, 1))


def test_records_round_trip_through_shards(spark, docs, corpus, tmp_path):
    made = TO.materialise(docs, seq_len=64, records_per_shard=100).cache()
    rows = made.orderBy("slot").collect()
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    assert {len(r["record"]) for r in rows} == {4 + 64 * 2}
    assert all(r["shard"] == r["slot"] // 100 and r["offset"] == r["slot"] % 100 * 132 for r in rows)
    uri = f"file://{tmp_path}/shards"
    shards = TO.write_shards(made, uri, 100).collect()
    assert sum(s["records"] for s in shards) == len(rows) and all(s["written"] for s in shards)
    read = TO.read_slots(uri, 0, len(rows), END, 64, 100)
    by_doc: dict = {}
    for r, ids in zip(rows, read):
        assert len(ids) == r["n_tokens"]
        by_doc.setdefault(r["doc_id"], {})[r["seq"]] = ids.tolist()
    texts = {i: t or "" for i, t, _ in corpus}
    assert by_doc.keys() == texts.keys()
    for i, parts in by_doc.items():
        assert sum((parts[k] for k in sorted(parts)), []) == ENCODE(texts[i]) + [END]
    # a seek to the middle gives the same as reading on from the start
    assert [x.tolist() for x in TO.read_slots(uri, 95, 10, END, 64, 100)] == [x.tolist() for x in read[95:105]]


def test_shards_resume(spark, docs, tmp_path):
    made = TO.materialise(docs, seq_len=64, records_per_shard=50).cache()
    uri = f"file://{tmp_path}/shards"
    TO.write_shards(made, uri, 50).collect()
    files = sorted(glob.glob(f"{tmp_path}/shards/*.bin"))
    before = [open(f, "rb").read() for f in files]
    os.truncate(files[1], 7)
    again = {r["shard"]: r["written"] for r in TO.write_shards(made, uri, 50).collect()}
    assert [k for k, v in again.items() if v] == [1]
    assert [open(f, "rb").read() for f in files] == before


def test_the_query_writes_the_shards(spark, docs, tmp_path, monkeypatch):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(TO.materialise, "__defaults__", (*TO.materialise.__defaults__[:3], 100, None))
    out = queries.op1_token_output(spark, str(tmp_path))
    rows = out.orderBy("slot").collect()
    files = sorted(glob.glob(f"{tmp_path}/shards/*"))
    assert len(files) == len({r["shard"] for r in rows}) > 1
    assert b"".join(open(f, "rb").read() for f in files) == b"".join(bytes(r["record"]) for r in rows)
    os.truncate(files[1], 7)
    kept = os.stat(files[0]).st_mtime_ns
    assert out.count() == len(rows) and os.stat(files[0]).st_mtime_ns == kept
    assert os.path.getsize(files[1]) == 100 * len(rows[0]["record"])


def test_shards_of_another_order_are_written_again(spark, tmp_path):
    rows = [(i, f"text number {i} " * (30 + i)) for i in range(60)]
    uri = f"file://{tmp_path}/shards"

    def run(rows, parts, key=TO.KEY):
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).repartition(parts, "doc_id")
        made = TO.materialise(docs, seq_len=16, key=key, records_per_shard=100, shards=uri).orderBy("slot").collect()
        files = sorted(glob.glob(f"{tmp_path}/shards/*.bin"))
        assert b"".join(open(f, "rb").read() for f in files) == b"".join(bytes(r["record"]) for r in made)
        return len(made), files

    total, files = run(rows, 2)
    os.remove(files[0])
    assert run(rows, 3)[0] == total  # other splits
    run(rows, 3, key=5)
    swapped = [(i, t.replace("text", "next")) for i, t in rows]  # other texts of the same length
    assert run(swapped, 3, key=5)[0] == total
    kept = os.stat(files[1]).st_mtime_ns
    os.remove(files[0])
    assert run(swapped, 3, key=5)[0] == total and os.stat(files[1]).st_mtime_ns == kept
    assert len(run(rows[:9], 3, key=5)[1]) < len(files)


def test_no_rows_no_shards(no_docs, tmp_path):
    made = TO.materialise(no_docs)
    assert made.count() == 0
    assert TO.write_shards(made, f"file://{tmp_path}/none").count() == 0


def test_cuts_are_token_boundaries():
    text = "It's don't  we'll 12 x é ü\n\n a b  c " * 40 + "ends's"
    pieces = TC.cut(text, 20)
    assert "".join(pieces) == text and len(pieces) > 5
    assert sum((ENCODE(p) for p in pieces), []) == ENCODE(text)


TEXT = st.text(alphabet="ab é'sx1 \n.", max_size=120)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 130), st.integers(0, 12), TEXT), max_size=5), TEXT)
def test_edited_trees_equal_full_encoding(text, raw, tail):
    text = (text + " word another " + tail) * 3
    edits, at = [], 0
    for start, size, new in sorted(raw):
        start = max(start, at)
        end = min(start + size, len(text))
        if start <= end:
            edits.append((start, end, new))
            at = end + 1
    pieces = TC.cut(text, 8)
    tree = TC.tree_of([len(ENCODE(p)) for p in pieces])
    new, chars, tree, _ = TC.update(text, [len(p) for p in pieces], tree, edits, lambda s: len(ENCODE(s)))
    assert new == TC.apply_edits(text, edits)
    assert tree[1] == len(ENCODE(new)) and sum(chars) == len(new)
    # a second round of edits on the edited tree
    more = [(len(new) // 2, len(new) // 2, " 'll x")]
    last, chars, tree, _ = TC.update(new, chars, tree, more, lambda s: len(ENCODE(s)))
    assert tree[1] == len(ENCODE(last)) and sum(chars) == len(last)
    assert all(tree[i] == tree[2 * i] + tree[2 * i + 1] for i in range(1, len(tree) // 2))


def test_only_touched_segments_are_encoded_again():
    text = "some words of a text " * 500
    pieces = TC.cut(text)
    tree = TC.tree_of([len(ENCODE(p)) for p in pieces])
    calls = []
    TC.update(text, [len(p) for p in pieces], tree, [(5000, 5003, "XYZ")], lambda s: calls.append(s) or len(ENCODE(s)))
    assert len(pieces) > 15 and len(calls) <= 3


def test_counts_of_documents_with_edits(spark, corpus):
    rows = [(i, (t or "") + f" mail me{i}@host.example.org or 555-010-{1000 + i} now") if t is not None else (i, t)
            for i, t, _ in corpus]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _tree string")
    out = TC.update_trees(TC.mask_edits(TC.build_trees(docs)))
    texts = dict(rows)
    for r in out.select("doc_id", F.col("_tree")[1].alias("a"), F.col("_new_tree")[1].alias("b"), "text", "_edits").collect():
        old = texts[r["doc_id"]] or ""
        edits = TC.find_masks(old)
        assert [tuple(e) for e in r["_edits"]] == edits
        assert r["a"] == len(ENCODE(old)) and r["b"] == len(ENCODE(TC.apply_edits(old, edits)))
        assert r["text"] == TC.apply_edits(old, edits)


def test_masks():
    text = "to a.b@c.org at 10.0.0.1 key sk_live_4eC39HqLyjWDarjtT1 call +44 20 7946 0958"
    assert TC.apply_edits(text, TC.find_masks(text)) == "to <EMAIL> at <IP> key <KEY> call <NUMBER>"


def test_packed_ranks_come_back():
    rng = np.random.default_rng(5)
    sizes = np.array([1, 3, 0, 256, 7, 1])
    for top in (1, 191, 193, 16_000, 16_321, 100_000, 1 << 23):
        ranks = rng.integers(0, top, sizes.sum())
        packed = TO.pack(ranks, sizes)
        assert len(packed) == len(sizes)
        assert TO.unpack(packed, sizes).tolist() == ranks.tolist()
        assert TO.unpack(packed.slice(3), sizes[3:]).tolist() == ranks[4:].tolist()
    edge = np.array([0, 191, 192, 447, 448, 192 + 63 * 256 - 1, 192 + 63 * 256, 192 + (1 << 24) - 1])
    assert TO.unpack(TO.pack(edge, np.array([8])), np.array([8])).tolist() == edge.tolist()
    assert len(TO.pack(edge[:0], sizes[:0])) == 0


def test_the_token_table_is_packed_at_a_high_level(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    monkeypatch.setattr(TO, "scratch_path", lambda spark, name: path)
    rows = spark.range(0, 400, 1, 1).selectExpr(
        "id AS doc_id", "array_join(transform(sequence(1, 300), x -> concat('w', pmod(xxhash64(id, x), 900))), ' ') AS text")
    TO.materialise(rows)
    spark.read.parquet(path).coalesce(1).write.option("compression", "zstd").parquet(f"{path}-plain")
    size = {p: sum(os.path.getsize(f) for f in glob.glob(f"{p}/part-*")) for p in (path, f"{path}-plain")}
    assert size[path] < 0.99 * size[f"{path}-plain"]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab é'sx1 \n.<|> ", max_size=80), st.text(max_size=40))
def test_ids_as_arrays_are_the_ordinary_ids(a, b):
    encode = tokens.encode(VOCABULARY)
    for text in (a, b, f"{a}<|endoftext|>{b}", "<|endoftext|>é" * 3, ""):
        text = text.encode("utf-8", "replace").decode()
        assert encode(text).tolist() == ENCODE(text)
    assert END == max(tokens.encoder(VOCABULARY)._mergeable_ranks.values()) + 1


def test_the_code_holds_all_ids_and_the_table_is_written_in_it(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    monkeypatch.setattr(TO, "scratch_path", lambda spark, name: path)
    words = "the and of to in is that it was for on are as with his they at be this from".split()
    rows = [(i, " ".join(words[(i * j + j) % len(words)] for j in range(700))) for i in range(300)]
    rows += [(1000, "über 中文 \U0001f600 <|endoftext|> rare Zyzzyva"), (1001, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")
    order = TO.frequent_first(docs)
    assert sorted(order.tolist()) == list(range(END + 1))
    assert set(ENCODE(" " + " ".join(words))) <= set(order[:TO.ONE].tolist())
    assert TO.frequent_first(docs.where("doc_id IS NULL")).tolist() == list(range(END + 1))
    made = TO.materialise(docs, records_per_shard=100)
    n_tokens, size = spark.read.parquet(path).agg(F.sum("n_tokens"), F.sum(F.length("ranks"))).first()
    assert size < 1.1 * n_tokens
    by_doc: dict = {}
    for r in made.orderBy("slot").collect():
        by_doc.setdefault(r["doc_id"], {})[r["seq"]] = np.frombuffer(r["record"], "<u2", offset=4)[:r["n_tokens"]].tolist()
    assert {i: sum((s[k] for k in sorted(s)), []) for i, s in by_doc.items()} == {i: ENCODE(t or "") + [END] for i, t in rows}


def test_shards_are_dealt_out_without_a_sampling_pass(spark, docs):
    made = TO.materialise(docs, seq_len=64, records_per_shard=50)
    assert "rangepartitioning" not in made._jdf.queryExecution().executedPlan().toString()
    parts = made.groupBy(F.spark_partition_id().alias("p")).agg(F.min("shard").alias("a"), F.max("shard").alias("b")).orderBy("p").collect()
    assert len(parts) > 1 and all(x["b"] < y["a"] for x, y in zip(parts, parts[1:]))
