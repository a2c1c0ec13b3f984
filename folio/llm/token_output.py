"""Token-ID output (1): training order by a keyed permutation, fixed-stride shards.

1. Texts are tokenised once; every document becomes its tokens, an end token
   and so ``ceil((n + 1) / seq_len)`` sequences.  The token table is written
   to shared storage, with each document's partition and place in it, which
   fixes the numbering whatever is retried later.  Its ids are in a code of
   one byte for the ids that come most often, two for the next and four for
   the rest.  All ids have a code; which are short is learned from one document
   in ``LEARN_ONE_IN``, by the hash of its id, and matters to the size alone.
2. Sequences are numbered 0..M-1: partitions in order, documents in order
   within them.  Only one count a partition is summed up for that.
3. A keyed Feistel network over the next even power of two permutes the
   numbers; values of M or more are fed in again until they fall below it
   (cycle walking), so every sequence has a slot of its own in 0..M-1.
4. Slots are partitioned at shard borders, which their number fixes, so nothing is
   sampled for that.  On the way the coded sequences are compressed one by one, with
   a dictionary of some of the documents.  Then every sequence becomes a record of
   fixed length, with plain ids, in slot order.  ``materialise`` returns the records as rows and,
   given a folder, writes them as plain files, one a shard, on the way;
   ``write_shards`` does that for rows that are there.  Record r of a shard starts
   at byte r * stride, so a reader seeks to any slot and reads on.  A file appears
   under its name only when whole (written aside, then moved).
5. The numbering follows the input's splits, so other splits, texts or keys give
   another order.  A manifest beside the shards names the order they are in (a
   digest of the numbered documents, the key and the lengths).  A run that finds
   its own manifest leaves shards of full length alone; with any other manifest,
   or none, the shards in the folder are removed and written anew.

A record is a little-endian uint32 with the number of tokens, then
``seq_len`` ids (uint16, or uint32 for vocabularies that need it), padded
with the end token's id.

Defined results: a null or empty text is one sequence with the end token
alone; repeated rows are sequences of their own; without rows there are no
shards.  Columns other than the id and the text do not matter.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm import tokens
from folio.llm.words import as_bytes, blocks, mix
from folio.session import scratch_path

SEQ_LEN = 256
RECORDS_PER_SHARD = 1 << 15
KEY = 20240229
ROUNDS = 6
#: Ranks below ONE take one byte; first bytes from ONE on, and below MORE, are the high bytes of two.
ONE, MORE = 192, 255
#: The code of the ids is learned from one document in so many.
LEARN_ONE_IN = 64
#: The dictionary for the shuffle, and what it is made of: so many bytes of so many documents at most.
DICTIONARY_BYTES, EXAMPLE_BYTES, EXAMPLES = 1 << 16, 1 << 12, 1000
PIECE_LEVEL = 3
BROADCAST_PARTS = 1_000_000
MANIFEST = ".manifest.json"
#: The token table, written once, is about as large as the shuffle: a high level pays.
TABLE_OPTIONS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}


def permute(numbers: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """A keyed bijection of 0..size-1 (balanced Feistel network with cycle walking)."""
    half = np.uint64(max(1, -(-max(1, (size - 1).bit_length()) // 2)))
    low = (np.uint64(1) << half) - np.uint64(1)
    keys = mix(np.arange(ROUNDS, dtype=np.uint64) + mix(np.array([key], dtype=np.uint64)))
    out = np.array(numbers, dtype=np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & low
        for k in keys:
            left, right = right, left ^ (mix(right + k) & low)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


def tokenise(docs: DataFrame, vocabulary: str = tokens.VOCABULARY, seq_len: int = SEQ_LEN,
             order: np.ndarray | None = None) -> DataFrame:
    """(part, first, doc_id, n_tokens, lengths, ranks, check): a document's ids with its end, the number of
    sequences that come before it in its partition, and a hash of the ids.

    ``ranks`` are the ids' places in ``order`` (see frequent_first), packed for each sequence;
    ``lengths`` are the bytes of each sequence there.
    """
    spark = docs.sparkSession
    shared = tokens.share(spark, vocabulary)
    order = frequent_first(docs, vocabulary) if order is None else order
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order))
    rank = spark.sparkContext.broadcast(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokens.encode(shared.value), tokens.end_of_text(shared.value)
        kind = _id_type(end)
        part, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for low, high in blocks(texts):
                ids, checks = [], []
                for text in texts[low:high]:
                    ids.append(np.append(encode((text or b"").decode("utf-8", "replace")), np.uint32(end)))
                    checks.append(xxhash.xxh3_64_intdigest(ids[-1].astype(kind)) >> 1)
                n_tokens = np.array([len(own) for own in ids], dtype=np.int64)
                n = -(-n_tokens // seq_len)
                row, seq = _rows(n)
                pieces = pack(rank.value[np.concatenate(ids)], np.minimum(n_tokens[row] - seq * seq_len, seq_len))
                offsets = np.frombuffer(pieces.buffers()[1], dtype=np.int32)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part), pa.int32()), pa.array(first + ends - n),
                     batch.column(0).slice(low, high - low), pa.array(n_tokens),
                     _binaries(np.diff(offsets).astype("<u4").view(np.uint8), 4 * n),
                     _binaries(np.frombuffer(pieces.buffers()[2], dtype=np.uint8), np.diff(offsets[np.append(0, ends)])),
                     pa.array(checks, pa.int64())],
                    names=["part", "first", "doc_id", "n_tokens", "lengths", "ranks", "check"])
                first += int(ends[-1])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "part int, first long, doc_id long, n_tokens long, lengths binary, ranks binary, check long")


def _rows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts[i] things of each row: the row of each, and its place there."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _id_type(largest: int) -> str:
    return "<u2" if largest < 1 << 16 else "<u4"


def frequent_first(docs: DataFrame, vocabulary: str = tokens.VOCABULARY) -> np.ndarray:
    """All ids, those first that come most often in one document in ``LEARN_ONE_IN``, then in their own order."""
    shared = tokens.share(docs.sparkSession, vocabulary)
    end = tokens.end_of_text(shared.value)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encode(shared.value)
        n = np.zeros(end + 1, dtype=np.int64)
        for batch in batches:
            for text in as_bytes(batch.column(0)):
                ids, held = np.unique(encode((text or b"").decode("utf-8", "replace")), return_counts=True)
                n[ids] += held
                n[end] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n)), pa.array(n[n > 0])], names=["id", "n"])

    rows = (docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(LEARN_ONE_IN)) == 0).select("text")
            .mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas())  # a row an id at most
    n = np.zeros(end + 1, dtype=np.int64)
    n[rows["id"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return np.argsort(-n, kind="stable")


def _first_of_two(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Marks the first of two kinds that take turns: n_a[0] of the one, n_b[0] of the other, n_a[1], ..."""
    return np.repeat(np.tile([True, False], len(n_a)), np.stack([n_a, n_b], axis=1).reshape(-1))


def _in_turns(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    if not len(b):
        return a
    own = _first_of_two(n_a, n_b)
    out = np.empty(len(own), dtype=np.uint8)
    out[own], out[~own] = a, b
    return out


def _held(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many of the sorted places ``at`` are in each run of ``sizes[i]``."""
    return np.diff(np.searchsorted(at, np.cumsum(sizes)), prepend=0)


def pack(ranks: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary for each run of ``sizes[i]`` ranks: their first bytes, then the second bytes of ranks
    from ``ONE`` on, then two more for those that a first byte of ``MORE`` marks."""
    wide = np.flatnonzero(ranks >= ONE)
    above = ranks[wide] - ONE
    high = np.minimum(ONE + (above >> 8), MORE)
    first = ranks.astype(np.uint8)
    first[wide] = high
    most = high == MORE
    n_wide, n_most = _held(wide, sizes), 2 * _held(wide[most], sizes)
    more = (above[most] >> 8).astype("<u2").view(np.uint8)
    rest = _in_turns((above & 255).astype(np.uint8), n_wide, more, n_most)
    return _binaries(_in_turns(first, sizes, rest, n_wide + n_most), sizes + n_wide + n_most)


def unpack(coded: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """The ranks of all runs, one after another."""
    if not len(coded):
        return np.empty(0, dtype=np.int32)
    coded = coded.cast(pa.large_binary())
    offsets = np.frombuffer(coded.buffers()[1], dtype=np.int64)[coded.offset:coded.offset + len(coded) + 1]
    data = np.frombuffer(coded.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    own = _first_of_two(sizes, np.diff(offsets) - sizes)
    first, rest = data[own], data[~own]
    out = first.astype(np.int32)
    wide = np.flatnonzero(first >= ONE)
    high = out[wide] - ONE
    most = first[wide] == MORE
    if most.any():
        low = _first_of_two(_held(wide, sizes), 2 * _held(wide[most], sizes))
        high[most] = np.frombuffer(rest[~low].tobytes(), "<u2")
        rest = rest[low]
    out[wide] = ONE + (high << 8) + rest
    return out


def _binaries(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """``data`` cut into binaries of these lengths."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    if offsets[-1] >> 31:
        raise ValueError("records of an Arrow batch exceed 2 GB; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def dictionary(tokenised: DataFrame) -> bytes:
    """A zstd dictionary for the packed sequences of a written token table; empty for a small table."""
    some = (tokenised.where(F.pmod(F.xxhash64("doc_id"), F.lit(LEARN_ONE_IN)) == 0)
            .select(F.substring("ranks", 1, EXAMPLE_BYTES).alias("ranks")).limit(EXAMPLES).collect())
    pieces = [bytes(r["ranks"][at:at + SEQ_LEN]) for r in some for at in range(0, len(r["ranks"]), SEQ_LEN)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:  # too few bytes to learn from
        return b""


def _with_dictionary(held: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(held)} if held else {}


def sequences(tokenised: DataFrame, size: int, held: Broadcast, seq_len: int = SEQ_LEN, key: int = KEY) -> DataFrame:
    """(slot, doc_id, seq, n_tokens, piece) of each of the ``size`` sequences of a written token table.

    ``piece`` is the sequence's part of ``ranks``, compressed with the dictionary ``held``.
    """
    # one row a partition of the token table
    parts = tokenised.groupBy("part").agg(F.sum(F.ceil(F.col("n_tokens") / seq_len)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("part", F.coalesce(before, F.lit(0)).cast("long").alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=PIECE_LEVEL, write_dict_id=False, **_with_dictionary(held.value)).compress
        for batch in batches:
            coded = batch.column(4).to_pylist()
            for low, high in blocks(coded):
                b = batch.slice(low, high - low)
                n_tokens = b.column(2).to_numpy(zero_copy_only=False)
                row, seq = _rows(-(-n_tokens // seq_len))
                slot = permute(b.column(0).to_numpy(zero_copy_only=False)[row] + seq, size, key)
                lengths = np.frombuffer(b"".join(b.column(3).to_pylist()), "<u4")
                ends = np.cumsum(lengths, dtype=np.int64)
                joint = memoryview(b"".join(coded[low:high]))  # documents end where their last sequences do
                pieces = [compress(joint[i:j]) for i, j in zip((ends - lengths).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), b.column(1).take(pa.array(row)), pa.array(seq, pa.int32()),
                     pa.array(np.minimum(n_tokens[row] - seq * seq_len, seq_len), pa.int32()), pa.array(pieces, pa.binary())],
                    names=["slot", "doc_id", "seq", "n_tokens", "piece"])

    # a row a task of the tokenising stage
    starts = F.broadcast(starts) if starts.count() <= BROADCAST_PARTS else starts.hint("merge")
    numbered = tokenised.join(starts, "part").select(
        (F.col("start") + F.col("first")).alias("first"), "doc_id", "n_tokens", "lengths", "ranks")
    return numbered.mapInArrow(run, "slot long, doc_id long, seq int, n_tokens int, piece binary")


def _digest(*columns: str) -> Column:
    """A digest of rows in any order: both halves of their hashes, summed."""
    h = F.xxhash64(*columns)
    return F.concat_ws(",", F.sum(F.shiftrightunsigned(h, 32)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))))


def claim(path: str, **order: object) -> None:
    """Make ``path`` the folder of the shards of ``order``: unless its manifest says so already, the shards
    that are there are removed, and the manifest is written.

    The removal comes first: a run that is lost in between leaves a folder without shards.
    """
    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root, recursive=True)
    name, wanted = f"{root}/{MANIFEST}", json.dumps(order, sort_keys=True).encode()
    if fs.get_file_info(name).type == pafs.FileType.File:
        with fs.open_input_file(name) as f:
            if f.read() == wanted:
                return
    for info in fs.get_file_info(pafs.FileSelector(root)):
        if re.fullmatch(r"shard-\d+\.bin|\.shard-\d+\.\d+", info.base_name):
            fs.delete_file(info.path)
    with fs.open_output_stream(f"{name}.new") as f:
        f.write(wanted)
    fs.move(f"{name}.new", name)


class ShardFiles:
    """A task's shards: ``put`` takes its records in slot order, ``close`` ends the open shard.

    (shard, records, bytes, written) of each whole shard come in ``done``.
    """

    def __init__(self, path: str, total: int, records_per_shard: int) -> None:
        self.fs, self.root = pafs.FileSystem.from_uri(path)
        self.fs.create_dir(self.root, recursive=True)
        self.total, self.records_per_shard = total, records_per_shard
        self.shard, self.out, self.aside, self.size = None, None, "", 0
        self.done: list[dict] = []

    def put(self, shard: int, record: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.out, self.size = shard, None, len(record)
            length = self.size * min(self.records_per_shard, self.total - shard * self.records_per_shard)
            info = self.fs.get_file_info(f"{self.root}/shard-{shard:06d}.bin")
            if info.type != pafs.FileType.File or info.size != length:
                self.aside = f"{self.root}/.shard-{shard:06d}.{TaskContext.get().taskAttemptId()}"
                self.out = self.fs.open_output_stream(self.aside)
        if self.out is not None:
            self.out.write(record)

    def close(self) -> None:
        if self.shard is not None:
            if self.out is not None:
                self.out.close()
                self.fs.move(self.aside, f"{self.root}/shard-{self.shard:06d}.bin")
            held = min(self.records_per_shard, self.total - self.shard * self.records_per_shard)
            self.done.append({"shard": self.shard, "records": held, "bytes": held * self.size, "written": self.out is not None})
            self.shard = None


def records(rows: DataFrame, total: int, held: Broadcast, end: int, order: np.ndarray, seq_len: int = SEQ_LEN,
            records_per_shard: int = RECORDS_PER_SHARD, shards: str | None = None) -> DataFrame:
    """The ``total`` sequences as records in slot order, partitioned at shard borders:
    slot, shard, offset (in the shard's bytes), doc_id, seq, n_tokens, record.

    With ``shards``, a folder that all executors reach, the shards are written there
    as these rows are computed.
    """
    n_shards = max(1, -(-total // records_per_shard))
    n_parts = min(n_shards, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kind = _id_type(end)
    width = np.dtype(kind).itemsize * seq_len
    order = rows.sparkSession.sparkContext.broadcast(order.astype(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = ShardFiles(shards, total, records_per_shard) if shards else None
        decompress = zstandard.ZstdDecompressor(**_with_dictionary(held.value)).decompress
        for b in (batch.slice(low, high - low) for batch in batches for low, high in blocks(batch.column(4).to_pylist())):
            slot, sizes = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 3))
            shard = slot // records_per_shard
            ids = np.full((b.num_rows, seq_len), end, dtype=kind)
            packed = pa.array([decompress(piece) for piece in b.column(4).to_pylist()], pa.binary())
            ids[np.arange(seq_len) < sizes[:, None]] = order.value[unpack(packed, sizes)]
            whole = np.empty((b.num_rows, 4 + width), dtype=np.uint8)
            whole[:, :4] = sizes.astype("<u4").view(np.uint8).reshape(-1, 4)
            whole[:, 4:] = ids.view(np.uint8).reshape(-1, width)
            made = _binaries(whole.reshape(-1), np.full(b.num_rows, 4 + width))
            if files:
                for number, record in zip(shard.tolist(), whole):
                    files.put(number, record.data)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(shard), pa.array(slot % records_per_shard * (4 + width)), *b.columns[1:4], made],
                names=["slot", "shard", "offset", "doc_id", "seq", "n_tokens", "record"])
        if files:
            files.close()

    part = F.expr(f"CAST(slot div {records_per_shard} * {n_parts} div {n_shards} AS INT)")
    return (rows.repartitionById(n_parts, part).sortWithinPartitions("slot")
            .mapInArrow(run, "slot long, shard long, offset long, doc_id long, seq int, n_tokens int, record binary"))


def materialise(docs: DataFrame, vocabulary: str = tokens.VOCABULARY, seq_len: int = SEQ_LEN, key: int = KEY,
                records_per_shard: int = RECORDS_PER_SHARD, shards: str | None = None) -> DataFrame:
    """Tokenise ``docs`` and put them in training order; see records() for the rows and ``shards``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-output")
    order = frequent_first(docs, vocabulary)
    tokenise(docs, vocabulary, seq_len, order).write.options(**TABLE_OPTIONS).parquet(path)
    end = tokens.end_of_text(tokens.share(spark, vocabulary).value)
    tokenised = spark.read.parquet(path)
    n = F.coalesce(F.sum(F.ceil(F.col("n_tokens") / seq_len)), F.lit(0)).cast("long")
    total, digest = tokenised.agg(n, _digest("part", "first", "doc_id", "n_tokens", "check")).first()
    if shards:
        claim(shards, documents=digest, total=total, key=key, seq_len=seq_len, end=end, records_per_shard=records_per_shard)
    held = spark.sparkContext.broadcast(dictionary(tokenised))
    return records(sequences(tokenised, total, held, seq_len, key), total, held, end, order, seq_len, records_per_shard, shards)


def write_shards(made: DataFrame, path: str, records_per_shard: int = RECORDS_PER_SHARD) -> DataFrame:
    """Write records as ``shard-NNNNNN.bin`` files under ``path``, a folder that all executors reach.

    Gives one row a shard: shard, records, bytes, written (False: it was there
    already).  The files are written when these rows are computed; a task that
    runs again writes the same bytes.
    """
    total, digest = made.agg(F.count("*"), _digest("slot", "record")).first()
    claim(path, records=digest, total=total, records_per_shard=records_per_shard)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = ShardFiles(path, total, records_per_shard)
        for b in batches:
            for number, record in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                files.put(number, record)
        files.close()
        if files.done:
            yield pa.RecordBatch.from_pylist(files.done)

    return (made.select("slot", "shard", "record").repartitionByRange("shard").sortWithinPartitions("slot")
            .mapInArrow(run, "shard long, records long, bytes long, written boolean"))


def read_slots(path: str, first: int, n: int, end: int, seq_len: int = SEQ_LEN,
               records_per_shard: int = RECORDS_PER_SHARD) -> list[np.ndarray]:
    """The ids of the n sequences from slot ``first`` on, by seeks in the shards."""
    fs, root = pafs.FileSystem.from_uri(path)
    kind = _id_type(end)
    stride = 4 + np.dtype(kind).itemsize * seq_len
    out = []
    while n > 0:
        shard, record = divmod(first, records_per_shard)
        take = min(n, records_per_shard - record)
        with fs.open_input_file(f"{root}/shard-{shard:06d}.bin") as f:
            f.seek(record * stride)
            data = f.read(take * stride)
        for at in range(0, len(data), stride):
            size = int.from_bytes(data[at:at + 4], "little")
            out.append(np.frombuffer(data[at + 4:at + stride], dtype=kind)[:size])
        first, n = first + take, n - take
    return out
