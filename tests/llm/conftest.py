"""A small table of documents with every awkward case."""

from __future__ import annotations

import random

import pytest

WORDS = "river basin gauge storm rain flood stage crest delta marsh creek weir lock levee dam reach stream bank bed ford".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", ","]) for _ in range(n))


def edited(text: str, share: float, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


def awkward() -> list[tuple]:
    """doc_id, text, lang, source, n_chars."""
    texts: list[str | None] = [None, "", None, "", "  \n\t ", "a", "A", "Ab Cd", "aB cD", "12 34 !!", "…—", "word", "日本語 のテキスト", "naïve CAFÉ", "cc by 4.0", "x\x00y \x1c z", "🙂 smile 🙂", "line one\nline two\n\n line  three ", "<|endoftext|> is text"]
    texts += [prose(k, 30 + 5 * k) for k in range(12)]
    texts += [prose(1, 35), prose(1, 35).upper(), prose(2, 40), prose(2, 40)]
    texts += [edited(prose(9, 200), 0.01, k) for k in range(6)] + [prose(9, 200), edited(prose(9, 200), 0.3, 5)]
    texts += [prose(77, 30_000), "z" * 200_000]
    texts += ["copy of a line that many share and which is long enough"] * 40
    rows = [(k, t, ["en", "de", None][k % 3], f"s{k % 4}", len(t or "")) for k, t in enumerate(texts)]
    return rows + [rows[20], rows[20], (None, "no id", "en", "s0", 5), (None, "no id", "en", "s0", 5), (None, None, None, None, None)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """With extra columns whose names clash with those that operators use."""
    extra = ", shard int, label string, size string, bin int, tie int, row int, `_c` double"
    return spark.createDataFrame([(*r, 1, "l", "s", 2, 3, 4, 0.5) for r in awkward()], SCHEMA + extra).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def folder(spark, docs, tmp_path_factory):
    """The awkward documents as a folder of tables."""
    at = tmp_path_factory.mktemp("tables")
    docs.select("doc_id", "text", "lang", "source", "n_chars").coalesce(1).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(k, prose(1000 + k, 20 + k)) for k in range(8)] + [(90, None), (91, ""), (92, "short one")], "item_id long, text string").coalesce(1).write.parquet(f"{at}/benchmark.parquet")
    return str(at)
