"""I-Match fingerprints over randomised lexicon subsets.

Terms are runs of letters, digits and bytes beyond ASCII, lower-cased. The lexicon holds the terms
whose share of distinct texts lies in a band: neither so frequent that they say nothing nor so rare
that a typing error makes one. A document keeps its distinct lexicon terms, sorted; a fingerprint part
is a hash of those that fall into one random subset of the lexicon. Subsets come at several rates,
from a half down to a 256th, so that short and long documents both have parts built on few terms,
which survive an edit that leaves those terms alone.

Copies count once for the shares, but near copies are distinct: a large group of them lifts all that
it shares above the band. A text with fewer lexicon terms than half of its own (or than ``ENOUGH``)
is therefore filled up to there with its terms nearest the band: by turns the least frequent of
those above it, and of those below it, which are not counted one by one, the smallest hashes.

*Likeness* of two fingerprints is the share of equal parts, taken from the sparsest rates up until
enough parts are filled on either side: with about one term to a part this estimates the overlap of
the two term sets.

The band bounds the lexicon: a term has to stand in at least ``min_share`` of all documents, so
there are at most (distinct terms of an average document) / ``min_share`` of them, however many
documents there are, those above the band included. That bound is what allows broadcasting it.

Texts whose hash is repeated are counted first; while those hashes are few enough to broadcast, only
their texts are shuffled to find the copies.

For the edited text a document needs the one after it. Documents are range-partitioned by id with
the texts shuffled once, into as many ranges as there are shuffle partitions; an id of very many
rows, or none, is cut further by the texts' hashes. The first document of each range is also sent to
the range before it.

Defined results: a null text is empty. A text without terms has a fingerprint from its whole text
instead, and its likeness to another is 1 if equal and 0 if not. Null ids come last; rows with
equal ids are ordered by a hash of the text. A single document is its own successor. An empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.text import filled, shuffle_partitions, table
from tallyroom.llm.wordhash import NOT_ALNUM, WordHasher, column_bytes, distinct_pairs, joined_bytes, mix64, slices
from tallyroom.plans.stages import fits_broadcast, staged

MIN_SHARE = 1 / 2000
MAX_SHARE = 1 / 5
FAMILIES = 16
RATES = 8  # subsets of rate 1/2, 1/4, ... 1/256
ENOUGH = 16  # filled parts that a likeness rests on, and terms that a text is filled up to


class Lexicon(NamedTuple):
    """Hashes of terms, each array sorted: those of the band, and those above it with their documents."""

    band: np.ndarray
    above: np.ndarray
    above_n: np.ndarray


def distinct_texts(docs: DataFrame, text_col: str) -> tuple[DataFrame, int]:
    """Every text once, as ``text``, and how many there are.

    Hashes that come more than once are counted first. While they are few enough to broadcast, only
    texts with such a hash are shuffled; beyond that all texts are.
    """
    texts = docs.select(filled(text_col).alias("text"))
    keyed = texts.withColumn("key", F.xxhash64("text"))
    repeated = staged(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    copies = repeated.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).first()["n"]
    rows, repeated = docs.count() - copies, repeated.select("key")
    once = lambda copies: copies.groupBy(F.unhex(F.sha2("text", 256))).agg(F.first("text").alias("text")).select("text")
    if not fits_broadcast(repeated, "key"):
        return once(texts), rows
    known = F.broadcast(repeated)
    single = keyed.join(known, "key", "left_anti").select("text")
    return single.unionByName(once(keyed.join(known, "key", "left_semi"))), rows


def lexicon(docs: DataFrame, text_col: str, min_share: float, max_share: float) -> Lexicon:
    """The terms whose share of distinct texts lies in the band, or above; at least two texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NOT_ALNUM)
        for batch in batches:
            terms = []
            for part in slices(batch, "text"):
                value, text = hasher.words(*column_bytes(part.column("text")))
                terms.append(distinct_pairs(text, value)[1])
            term, n = np.unique(np.concatenate(terms) if terms else np.empty(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], ["term", "n"])

    texts, rows = distinct_texts(docs, text_col)
    counted = texts.mapInArrow(count, "term bigint, n bigint")
    frequent = counted.groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(2, min_share * rows)).toArrow()
    term = frequent["term"].to_numpy().astype(np.int64).view(np.uint64)
    n = frequent["n"].to_numpy().astype(np.int64)
    order = np.argsort(term)
    term, n = term[order], n[order]
    above = n > max(2, max_share * rows)
    return Lexicon(term[~above], term[above], n[above])


def _places(known: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are known, and where those stand."""
    if not len(known):
        return np.zeros(len(value), dtype=bool), np.empty(0, np.int64)
    place = np.minimum(np.searchsorted(known, value), len(known) - 1)
    found = known[place] == value
    return found, place[found]


def _ranks(group: np.ndarray) -> np.ndarray:
    """Place of each row within its run of equal values."""
    if not len(group):
        return np.empty(0, np.int64)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    return np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))


def kept_terms(known: Lexicon, text: np.ndarray, value: np.ndarray, n_texts: int) -> np.ndarray:
    """Which of the distinct (text, term) pairs a fingerprint is built on."""
    kept = _places(known.band, value)[0]
    own = np.bincount(text, minlength=n_texts)
    lack = np.minimum(own, np.maximum(ENOUGH, own // 2)) - np.bincount(text[kept], minlength=n_texts)
    spare = np.flatnonzero(~kept & (lack[text] > 0))
    if not len(spare):
        return kept
    owner, term = text[spare], value[spare]
    above, place = _places(known.above, term)
    far = np.zeros(len(spare), dtype=np.int64)
    far[above] = known.above_n[place]
    # Per text, the terms above the band and those below it, each from the nearest on.
    order = np.lexsort((mix64(term), far, above, owner))
    turn = np.empty(len(spare), dtype=np.int64)
    turn[order] = 2 * _ranks(2 * owner[order] + above[order]) + ~above[order]
    order = np.lexsort((turn, owner))
    chosen = order[_ranks(owner[order]) < lack[owner[order]]]
    kept[spare[chosen]] = True
    return kept


def parts_of(hasher: WordHasher, known: Lexicon, texts: list[bytes]) -> np.ndarray:
    """Fingerprint parts, one row per text and ``FAMILIES * RATES`` columns; 0 where a part is empty."""
    out = np.zeros((len(texts), FAMILIES, RATES), dtype=np.uint16)
    value, text = hasher.words(*joined_bytes(texts))
    if not len(value):
        return out.reshape(len(texts), -1)
    text, value = distinct_pairs(text, value)
    kept = kept_terms(known, text, value, len(texts))
    text, value = text[kept], value[kept]
    for family in range(FAMILIES):
        draw = mix64(value + np.uint64(0x632BE59BD9B4E019 * (family + 1) % 2**64))
        owner, weight = text, mix64(draw ^ np.uint64(0xA5A5A5A5))
        for rate in range(RATES):
            # One more low bit has to be 0: each rate's subset lies inside the one before.
            chosen = (draw >> np.uint64(rate)) & np.uint64(1) == 0
            owner, weight, draw = owner[chosen], weight[chosen], draw[chosen]
            if not len(owner):
                break
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            folded = mix64(np.add.reduceat(weight, first)) % np.uint64(65535) + np.uint64(1)
            out[owner[first], family, rate] = folded.astype(np.uint16)
    return out.reshape(len(texts), -1)


def written(parts: np.ndarray, texts: list[bytes]) -> list[str]:
    """Fingerprints as strings."""
    return [
        row.astype(">u2").tobytes().hex() if row.any() else "text:" + hashlib.sha256(text).hexdigest()
        for row, text in zip(parts, texts, strict=True)
    ]


def likeness(a: np.ndarray, b: np.ndarray, same_text: np.ndarray) -> np.ndarray:
    """Row by row; ``same_text`` decides where neither side has a part."""
    a, b = (x.reshape(len(x), FAMILIES, RATES) for x in (a, b))
    filled_either = ((a != 0) | (b != 0)).sum(axis=1)[:, ::-1].cumsum(axis=1)
    equal = ((a == b) & (a != 0)).sum(axis=1)[:, ::-1].cumsum(axis=1)
    enough = filled_either >= ENOUGH
    level = np.where(enough.any(axis=1), enough.argmax(axis=1), RATES - 1)
    rows = np.arange(len(a))
    n = filled_either[rows, level]
    return np.where(n > 0, equal[rows, level] / np.maximum(n, 1), same_text.astype(float))


def _ranges(docs: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Where ranges of ids begin, and into how many parts each is cut by the texts' hashes.

    An id that more rows have than an average range holds, or no id, is a range of its own. There are
    fewer such ids than ranges; that and the ranges' bounds are all that comes to the driver.
    """
    most = max(docs.count() // buckets, 1)
    hot = docs.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > most).collect()
    cuts = docs.approxQuantile("id", [i / buckets for i in range(1, buckets)], 0.2 / buckets) if buckets > 1 else []
    alone = {row["key"]: -(-row["n"] // most) for row in hot}
    begins = {int(cut) for cut in cuts} | alone.keys() | {key + 1 for key in alone if key < (1 << 63) - 1}
    begins = np.array(sorted(begins), dtype=np.int64)
    return begins, np.array([1, *[alone.get(key, 1) for key in begins.tolist()]], dtype=np.int64)


def _laid_out(docs: DataFrame, buckets: int) -> DataFrame:
    """``id, text, tail`` sorted by descending id, then the text's hash, within ranges; heads repeated as tails."""
    key = F.coalesce(F.col("id").cast("bigint"), F.lit(-(1 << 63)))
    docs = docs.withColumns({"key": key, "h": F.xxhash64("text")})
    begins, parts = _ranges(docs, buckets)
    first = np.concatenate([[0], np.cumsum(parts)])

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series, h: pd.Series) -> pd.Series:
        at = np.searchsorted(begins, key.to_numpy(), side="right")
        part = np.floor((h.to_numpy().astype(np.float64) / 2.0**64 + 0.5) * parts[at]).astype(np.int64)
        # Rows come from the last range to the first, and in a range by ascending hash.
        return pd.Series((first[at] + parts[at] - 1 - np.minimum(part, parts[at] - 1)).astype(np.int32))

    # The order of hashes turned around: the largest is that of the first row.
    head = F.max(F.struct("key", F.bitwise_not("h").alias("not_h"))).alias("head")
    heads = docs.select("key", "h", bucket_of("key", "h").alias("bucket")).groupBy("bucket").agg(head).collect()
    order = sorted(heads, key=lambda r: r["bucket"])
    before = {(r["head"]["key"], ~r["head"]["not_h"]): order[(i + 1) % len(order)]["bucket"] for i, r in enumerate(order)}
    head_keys, head_hashes = (np.array([x[i] for x in before], dtype=np.int64) for i in (0, 1))

    @F.pandas_udf("int")
    def tail_of(key: pd.Series, h: pd.Series) -> pd.Series:
        out = pd.Series(pd.NA, index=key.index, dtype="Int32")
        for i in np.flatnonzero(np.isin(key.to_numpy(), head_keys) & np.isin(h.to_numpy(), head_hashes)):
            out.iloc[i] = before.get((int(key.iloc[i]), int(h.iloc[i])), pd.NA)
        return out

    placed = docs.withColumns({"bucket": bucket_of("key", "h"), "tail_of": tail_of("key", "h")})
    places = F.array_compact(
        F.array(
            F.struct(F.col("bucket"), F.lit(False).alias("tail")),
            F.when(F.col("tail_of").isNotNull(), F.struct(F.col("tail_of").alias("bucket"), F.lit(True).alias("tail"))),
        )
    )
    return (
        placed.select("id", "text", F.explode(places).alias("at"))
        .select("id", "text", "at.*")
        .repartitionById(int(first[-1]), F.col("bucket"))
        .sortWithinPartitions("bucket", "tail", key.desc(), F.xxhash64("text"), "text")
    )


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_share: float = MIN_SHARE,
    max_share: float = MAX_SHARE,
) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likeness.

    The edited text ends, in place of its last half, with as much of the beginning of the next
    document by descending id.
    """
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(lexicon(docs, text_col, min_share, max_share))
    read = docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def judged(hasher, rows: list, id_type) -> pa.RecordBatch:
        """Rows of ``(id, text)``, each followed by its successor; the last one is only that."""
        texts = [text.encode() for _, text, _ in rows]
        own = parts_of(hasher, known.value, texts)
        nexts = [i + 1 for i, row in enumerate(rows[:-1]) if not row[2]]
        here = np.array([i - 1 for i in nexts], dtype=np.int64)
        edited, counts = [], []
        for i in nexts:
            text, after = rows[i - 1][1], rows[i][1]
            half = len(text) // 2
            counts.append(len(text))
            edited.append((text[: len(text) - half] + after[:half]).encode())
        changed = parts_of(hasher, known.value, edited)
        mine, following = own[here], own[here + 1]
        own_texts = [texts[i] for i in here]
        columns = [
            pa.array([rows[i][0] for i in here], id_type),
            pa.array(counts, pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in edited], pa.string()),
            pa.array(written(mine, own_texts), pa.string()),
            pa.array(written(changed, edited), pa.string()),
            pa.array(likeness(mine, changed, np.array([a == b for a, b in zip(own_texts, edited, strict=True)], bool))),
            pa.array(
                likeness(mine, following, np.array([texts[i] == texts[i + 1] for i in here], bool))
            ),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NOT_ALNUM)
        pending = []  # rows whose successors have not come yet: (id, text, is a tail)
        for batch in batches:
            id_type = batch.schema.field("id").type
            for part in slices(batch, "text", 2 << 20):
                ids, texts, tails = (part.column(c).to_pylist() for c in ("id", "text", "tail"))
                pending += zip(ids, texts, tails, strict=True)
                if len(pending) > 1:
                    yield judged(hasher, pending, id_type)
                    pending = pending[-1:]

    laid = _laid_out(read, shuffle_partitions(spark)).select("id", "text", "tail")
    return laid.mapInArrow(run, schema)


def op7_imatch(spark, sf_dir) -> DataFrame:
    found = fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("id", "doc_id")
