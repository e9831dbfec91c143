"""Quality scores learned from preference pairs by the Bradley-Terry model.

Every pair of a document marked good and one marked bad says that the first is preferred. The model
gives a text the worth ``exp(w . f)`` for its features ``f``; the probability of a preference is the
logistic function of ``w . (f_good - f_bad)``, and ``w`` minimises the logistic loss over the pairs
with a small ridge. A text's latent score is ``w . f``.

The threshold is a quantile of the latent scores of the documents that were learned from: the share
that is marked bad lies below. Published scores are a logistic function of the latent score, moved
so that the threshold is at ``accept`` (0.7): a text is accepted when its score reaches that.

Features come from the text alone: shares of kinds of characters, lengths of words and lines, and
how much of its words, word pairs and lines is repetition. Each is cut into bins by the quantiles of
the learning sample, so a feature may matter at both ends.

The learning sample is at most ``FIT_ROWS`` labelled documents, those with the smallest CRC of their
id, and ``PAIRS`` pairs of them; this is all that reaches the driver. Scoring handles every document
in its own task and shuffles nothing.

Defined results: a null or empty text has features and a score like any other. Rows that repeat get
equal scores. Labels that are null, without a document or repeated do not matter beyond their rows.
Without both labels in the sample every text has the score ``accept``: nothing is rejected that
nothing speaks against. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tallyroom.llm.text import filled, table
from tallyroom.llm.wordhash import WordHasher, column_bytes, distinct_pairs, mix64, slices

FIT_ROWS = 4000
PAIRS = 20_000
BINS = 12
RIDGE = 1e-3
ACCEPT = 0.7
_KINDS = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".", b",", b"!",
    b"?", b":;", b"|", b"#", b"$", b"%", b"&", b"*", b"-_=+~", b"<>[]{}()", b"/\\@", b"'\"`",
)
_KIND = np.full(256, len(_KINDS), dtype=np.int64)  # control characters
for _i, _chars in enumerate(_KINDS):
    _KIND[list(_chars)] = _i
_KIND[128:] = len(_KINDS) + 1
N_KINDS = len(_KINDS) + 2


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct(text: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(distinct_pairs(text, value)[0], minlength=rows) if len(text) else np.zeros(rows)


def _most_frequent(text: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """The largest number of times that one value stands in each text."""
    out = np.zeros(rows)
    if len(text):
        order = np.lexsort((value, text))
        text, value = text[order], value[order]
        new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (value[1:] != value[:-1])])
        np.maximum.at(out, text[new], np.diff(np.r_[new, len(text)]))
    return out


def features(words: WordHasher, lines: WordHasher, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    owner = np.repeat(np.arange(rows), size)
    kinds = np.bincount(owner * N_KINDS + _KIND[data], minlength=rows * N_KINDS).reshape(rows, N_KINDS)
    word, word_of = words.words(data, offsets)
    line, line_of = lines.words(data, offsets)
    n_words, n_lines = (np.bincount(x, minlength=rows) if len(x) else np.zeros(rows) for x in (word_of, line_of))
    pair = mix64(word[:-1] * np.uint64(3) + word[1:]) if len(word) > 1 else word[:0]
    inside = word_of[:-1] == word_of[1:] if len(word) > 1 else np.zeros(0, bool)
    pair, pair_of = pair[inside], word_of[: len(inside)][inside]
    n_pairs = np.maximum(n_words - 1, 0)
    letters = kinds[:, 0] + kinds[:, 1] + kinds[:, -1]
    blank = kinds[:, 3] + kinds[:, 4]
    columns = [
        np.log1p(size),
        np.log1p(n_words),
        _share(size - blank, n_words),
        _share(n_words, n_lines),
        _share(letters, size - blank),
        _share(_distinct(word_of, word, rows), n_words),
        _share(_most_frequent(word_of, word, rows), n_words),
        _share(_distinct(pair_of, pair, rows), n_pairs),
        _share(_distinct(line_of, line, rows), n_lines),
        _share(kinds[:, 1], letters),
    ]
    return np.column_stack([*columns, *(_share(kinds[:, k], size) for k in range(N_KINDS))]).astype(np.float64)


class BradleyTerry:
    """Latent worth of texts from binned features."""

    def __init__(self, sample: np.ndarray, bins: int = BINS):
        grid = np.quantile(sample, np.linspace(0, 1, bins + 1)[1:-1], axis=0)
        # A bin of its own below each distinct cut; a constant feature has one bin.
        self.cuts = [np.unique(column) for column in grid.T]
        self.starts = np.concatenate([[0], np.cumsum([len(c) + 1 for c in self.cuts])])
        self.w = np.zeros(self.starts[-1])
        self.threshold, self.fitted = 0.0, False

    def bins(self, values: np.ndarray) -> np.ndarray:
        """The number of each feature's bin, counted over all features."""
        return np.column_stack(
            [start + np.searchsorted(cuts, column, side="left") for start, cuts, column in zip(self.starts, self.cuts, values.T)]
        )

    def latent(self, values: np.ndarray) -> np.ndarray:
        return self.w[self.bins(values)].sum(axis=1)

    def fit(self, values: np.ndarray, good: np.ndarray, pairs: int = PAIRS, steps: int = 300, seed: int = 0) -> BradleyTerry:
        better, worse = np.flatnonzero(good), np.flatnonzero(~good)
        if not len(better) or not len(worse):
            return self
        rng = np.random.default_rng(seed)
        first, second = rng.choice(better, pairs), rng.choice(worse, pairs)
        bins = self.bins(values)
        up, down = bins[first], bins[second]
        speed = np.zeros_like(self.w)
        for step in range(steps):
            margin = self.w[up].sum(axis=1) - self.w[down].sum(axis=1)
            pull = 1 / (1 + np.exp(np.clip(margin, -30, 30)))  # one less the probability of the preference
            each = np.repeat(pull, bins.shape[1])
            slope = np.bincount(up.ravel(), each, len(self.w)) - np.bincount(down.ravel(), each, len(self.w))
            speed = 0.9 * speed + slope / pairs - RIDGE * self.w
            self.w = self.w + speed * (1.0 - step / steps)
        latent = self.w[bins].sum(axis=1)
        self.threshold, self.fitted = self._between(latent, good), True
        return self

    @staticmethod
    def _between(latent: np.ndarray, good: np.ndarray) -> float:
        """The quantile at the share of the bad, halfway between the neighbours."""
        ordered = np.sort(latent)
        k = int((~good).sum())
        return float((ordered[k - 1] + ordered[min(k, len(ordered) - 1)]) / 2)

    def scores(self, values: np.ndarray, accept: float = ACCEPT) -> np.ndarray:
        if not self.fitted:
            return np.full(len(values), accept)
        moved = self.latent(values) - self.threshold + np.log(accept / (1 - accept))
        scores = 1 / (1 + np.exp(-np.clip(moved, -30, 30)))
        return np.where(moved >= np.log(accept / (1 - accept)), np.maximum(scores, accept), np.minimum(scores, np.nextafter(accept, 0)))


@cache
def _hashers() -> tuple[WordHasher, WordHasher]:
    """Of words and of lines, made once a worker."""
    return WordHasher(), WordHasher(b"\n\r")


def _mapped(docs: DataFrame, schema: str, make) -> DataFrame:
    """``make(features, batch)`` for the texts of every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, lines = _hashers()
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                yield make(features(words, lines, *column_bytes(part.column("text"))), part)

    return docs.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS) -> BradleyTerry:
    """Learns from at most ``rows`` of the labels ``id, good``, which name documents."""
    key = F.crc32(F.col("id").cast("string").cast("binary"))
    drawn = labels.filter("id is not null and good is not null").orderBy(key, "id", "good").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text"))
    marked = texts.join(F.broadcast(drawn), "id").select("id", "good", "text")  # at most ``rows`` labels

    def make(values: np.ndarray, part: pa.RecordBatch) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))
        return pa.RecordBatch.from_arrays([part.column("id"), part.column("good"), lists], ["id", "good", "f"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = _mapped(marked, f"id {kind}, good boolean, f array<double>", make).orderBy("id", "good", "f").limit(2 * rows).toArrow()
    if not found.num_rows:
        return BradleyTerry(np.zeros((1, 1)))
    values = np.array(found["f"].to_pylist())
    return BradleyTerry(values).fit(values, found["good"].to_numpy().astype(bool))


def score(docs: DataFrame, model: BradleyTerry, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(values: np.ndarray, part: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column("id"), pa.array(shared.value.scores(values))], ["id", "score"])

    read = docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text"))
    return _mapped(read, f"id {docs.schema[id_col].dataType.simpleString()}, score double", make)


def accepted(docs: DataFrame, model: BradleyTerry, text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """The documents that reach the threshold, with their columns as they came.

    Only the texts are sent to Python, and a verdict comes back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def reaches(text: pa.Array) -> pa.Array:
        words, lines = _hashers()
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        parts = [features(words, lines, *column_bytes(part.column("text"))) for part in slices(batch, "text", 2 << 20)]
        scores = [shared.value.scores(values, accept) for values in parts]
        return pa.array(np.concatenate(scores) >= accept if scores else [], pa.bool_())

    return docs.filter(F.arrow_udf(reaches, BooleanType())(filled(text_col)))


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: the CRC of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned(spark, docs: DataFrame, sf_dir: str) -> BradleyTerry:
    """The model of the table ``labels``, from rows that are not held out."""
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    return fit(docs, labels.select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("good")))


def op1_quality(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, learned(spark, docs, sf_dir))
    return scored.select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
