"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a linear classifier over hashed byte n-grams (n = 1 to 3) is
trained to tell the languages with a one from those with a zero: ridge regression on +1 and -1, solved in closed
form. A text's distance to a codeword is the squared hinge loss of the bits' margins, each bit weighted by how much better
than chance it does on the training rows; the nearest codeword wins, and a small gap to the second flags ambiguity.

The classifiers are fitted on a bounded sample: at most ``PER_LANGUAGE`` training rows of each language
(about, and ``IN_ALL`` in all), chosen by a hash of doc_id and text and taken whole. Of more than ``MOST_LANGUAGES`` different
labels the most frequent ones are learned. All other steps cover all rows.

Defined results: null text and text without a letter get ``und`` and score 0, as does every text when there is no
labelled training row; a null doc_id counts as not held out; equal texts get equal results; equal distances go to
the language that sorts first; empty tables give no rows; texts of any length are read whole; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import LOWER_BYTES, id_residue, place_of, table, tidy

#: Training rows of each language, and of all together.
PER_LANGUAGE, IN_ALL = 800, 8000
#: Languages that are learned at most: the most frequent ones.
MOST_LANGUAGES = 1024
#: Hashed features: bytes, pairs and triples have a range each.
PAIRS, TRIPLES = 768, 1024
FEATURES = 256 + PAIRS + TRIPLES
RIDGE = 1e-3
#: Below this gap of mean weighted loss between the nearest two codewords, a text is flagged as ambiguous.
AMBIGUOUS = 0.02
#: How fast the score saturates with that gap.
SHARPNESS = 8.0
BLOCK = 1 << 20
UNKNOWN = "und"


def features(text: str) -> np.ndarray:
    """Square roots of n-gram frequencies, as a vector of length one."""
    data = np.frombuffer(text.encode().translate(LOWER_BYTES), np.uint8)
    counts = np.zeros(FEATURES)
    for a in range(0, len(data), BLOCK):
        x = data[a : a + BLOCK + 2].astype(np.uint32)
        own = x[:BLOCK]
        counts[:256] += np.bincount(own, minlength=256)
        pair = x[:-1] * np.uint32(257) + x[1:]
        counts[256 : 256 + PAIRS] += np.bincount((pair[:BLOCK] * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(PAIRS), minlength=PAIRS)
        triple = (pair[:-1] * np.uint32(257) + x[2:])[:BLOCK] if len(x) > 2 else pair[:0]
        counts[256 + PAIRS :] += np.bincount((triple * np.uint32(2246822519) >> np.uint32(15)) % np.uint32(TRIPLES), minlength=TRIPLES)
    return np.sqrt(counts / max(1.0, counts.sum())).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def codewords(n: int) -> np.ndarray:
    """n rows of +1 and -1: the exhaustive code up to 7 languages, beyond it the best of some random codes."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        bits = [(1, *b) for b in itertools.product((1, -1), repeat=n - 1) if -1 in b]
        return np.array(bits).T.astype(float)
    rng, width, best, most = np.random.default_rng(7), math.ceil(10 * math.log2(n)), None, -1
    for _ in range(50):
        code = np.where(rng.permuted(np.tile(np.arange(n) % 2, (width, 1)), axis=1).T == 0, 1.0, -1.0)
        alike = code @ code.T - 2 * width * np.eye(n)
        least = int((width - alike.max()) // 2)  # bits in which the closest two differ
        if least > most:
            best, most = code, least
    return best


@dataclass
class Decoder:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # features and a constant, by bit
    trust: np.ndarray  # by bit, adding up to 1

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of features -> index of the language, score and ambiguity."""
        margins = x @ self.weights[:-1] + self.weights[-1]
        loss = np.stack([(np.maximum(0, 1 - margins * c) ** 2) @ self.trust for c in self.code], axis=1)
        order = np.sort(loss, axis=1)
        gap = order[:, 1] - order[:, 0] if loss.shape[1] > 1 else np.full(len(x), 1.0)
        return loss.argmin(axis=1), 1 / (1 + np.exp(-SHARPNESS * np.minimum(gap, 10))), gap < AMBIGUOUS


def fit(x: np.ndarray, y: list[str]) -> Decoder:
    """Trains one classifier a bit."""
    languages = sorted(set(y))
    code = codewords(len(languages))
    target = code[[languages.index(v) for v in y]]
    full = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    # the rows of one language weigh as much as those of another
    share = np.array([y.count(v) for v in languages], np.float32)[[languages.index(v) for v in y]][:, None]
    a = (full.T @ (full / share)).astype(np.float64) + RIDGE * np.eye(full.shape[1])
    weights = np.linalg.solve(a, (full / share).T @ target)
    right = (np.sign(full @ weights) == target).mean(axis=0)
    trust = np.maximum(right - 0.5, 1e-3)
    return Decoder(languages, code, weights, trust / trust.sum())


def train(docs: DataFrame, label: str = "lang") -> Decoder | None:
    """Fits on a sample of the rows; None without labelled rows. The same rows give the same model, however they are split."""
    rows = docs.where(docs[label].isNotNull() & docs["text"].isNotNull()).select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs[label].cast("string").alias("lang"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()}
    if not counts:
        return None
    most = max(1, min(PER_LANGUAGE, IN_ALL // len(counts)))
    share = F.element_at(F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(min(1.0, most / n))) for k, n in counts.items())), F.col("lang"))
    # rows with equal ids are told apart by their text
    drawn = F.pmod(F.xxhash64("doc_id", "text", F.lit("language sample")), F.lit(1 << 20))
    sample = rows.where(F.col("lang").isin(list(counts))).withColumn("drawn", drawn).where(F.col("drawn") < share * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(lang, features(text).tobytes(), drawn) for lang, text, drawn in zip(*(c.to_pylist() for c in batch.columns), strict=True) if has_letter(text)]
            yield pa.RecordBatch.from_arrays([pa.array([k[j] for k in kept], t) for j, t in enumerate((pa.string(), pa.binary(), pa.int64()))], names=["lang", "x", "drawn"])

    # the limit only binds when very many rows share both doc_id and text; the order makes it the same rows each time
    got = sample.select("lang", "text", "drawn").mapInArrow(tidy(run), "lang string, x binary, drawn long").orderBy("drawn", "lang", "x").limit(int(1.5 * most * len(counts)) + 200).collect()
    got = sorted((r[0], bytes(r[1])) for r in got)
    return fit(np.stack([np.frombuffer(x, np.float32) for _, x in got]), [k for k, _ in got]) if got else None


def predictions(model: Decoder | None, texts: list[str | None]) -> list[tuple[str, float, bool]]:
    """Language, score and ambiguity of each text."""
    out = [(UNKNOWN, 0.0, False)] * len(texts)
    known = [i for i, t in enumerate(texts) if model and has_letter(t)]
    for a in range(0, len(known), 1000):
        at = known[a : a + 1000]
        for i, k, s, f in zip(at, *model(np.stack([features(texts[i]) for i in at])), strict=True):
            out[i] = model.languages[k], float(s), bool(f)
    return out


def predict(spark: SparkSession, docs: DataFrame, decoder: Decoder | None) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous. One pass, no shuffle."""
    shipped = spark.sparkContext.broadcast(decoder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(zip(*predictions(shipped.value, batch.column(1).to_pylist()), strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.bool_())], names=["doc_id", "lang_pred", "score", "ambiguous"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, lang_pred string, score double, ambiguous boolean")


def accepted(spark: SparkSession, docs: DataFrame, decoder: Decoder | None) -> DataFrame:
    """The rows that get a language, with all their columns as they are; ambiguous ones stay."""
    at, shipped = place_of(docs, "text"), spark.sparkContext.broadcast(decoder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([p[0] != UNKNOWN for p in predictions(shipped.value, batch.column(at).to_pylist())], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    decoder = train(docs.where(id_residue(F.col("doc_id"), 4) != 2))
    found = predict(spark, docs, decoder)
    return found.select("doc_id", (id_residue(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")
