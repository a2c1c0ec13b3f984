from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, source string"


@pytest.fixture(scope="session")
def spark(spark, tmp_path_factory):
    """The suite's session, with a checkpoint folder."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    return spark


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{int(rng.paretovariate(0.8)) % vocabulary}{chr(97 + rng.randrange(26))}" for _ in range(n))


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="session")
def corpus() -> list[tuple[int | None, str | None, str | None]]:
    """Copies, near copies, shared passages and lines, and the edge rows every operator must take."""
    rng = random.Random(7)
    passage = prose(rng, 70)
    line = "A line that Many documents share"
    base = prose(rng, 220)
    rows: list[tuple[int | None, str | None, str | None]] = []
    for i in range(60):
        text = prose(rng, rng.choice([8, 60, 150, 300]))
        if i % 3 == 0:
            text = f"{text}\n{passage} {prose(rng, 5)}\n  {line if i % 2 else line.upper()}\t\n{prose(rng, 20)}"
        rows.append((i, text, f"src{i % 4}"))
    for i in range(60, 90):
        rows.append((i, base if i % 2 else edited(rng, base, 0.02), "src0"))
    for i in range(90, 110):  # a chain of edits: neighbours link, ends may not
        rows.append((i, edited(rng, rows[-1][1], 0.012), "src1"))
    rows += [(110, None, None), (111, "", "src1"), (112, " \n\t\n ", None), (113, "one", "src2"),
             (114, "ONE", "src2"), (115, prose(rng, 6000), "src3"), (116, "é" * 50 + " ü x " * 30, "src3"),
             (117, "same words here now\n" * 40, "src1"), (118, " ".join(["tie"] * 120), "src2"),
             (119, "### $$$ %%% " * 30, "src2")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
