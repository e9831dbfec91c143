"""Target-distribution importance resampling with segment deduplication.

Documents are drawn as a target collection would hold them: the n-grams of a text are its features,
dealt into buckets; a bucket's gain is the logarithm of how much more often the target holds it; a
document's weight is the sum of the gains of its features, and the largest weights plus Gumbel noise
are drawn, which is sampling without replacement in proportion to the exponentials of the weights.

*Segments.* Newlines cut a text into lines, and much of a corpus is lines that stand in many
documents. Occurrences are combined inside every task before the lines travel; every distinct line is
cut into words and features once, and what it gives, counts and gains, is multiplied by its
occurrences. N-grams that reach over a newline belong to no line; they are taken from the ends of
the lines of each document and added separately.

*Hot lines.* A document's lines are looked up by a 128-bit hash. A line with more occurrences than
an average partition has lines is looked up by a broadcast instead; there are fewer such lines than
partitions. The ranks of the drawn come from ranges of scores, not from one sorted partition.

Defined results: a null text has no words, no features and the weight 0. Repeated rows are documents
of their own. A null id is hashed as an empty text and is the last of a tie. Words in which A-Z differ
in case only are equal. An empty table gives an empty result, an empty target only the prior's gains.
Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.crc import CRC_SQL
from tallyroom.llm.ranks import placed
from tallyroom.llm.text import ascii_lower, filled, shuffle_partitions, table
from tallyroom.plans.stages import staged

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
HASH_RANGE = 1 << 32
KEPT_GRAMS = 1 << 18
# No byte of a character outside of ASCII is a blank, so words can be cut in UTF-8.
_BLANKED = bytes(b if b > 0x7F or chr(b).isalnum() and not chr(b).isupper() else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """The words of a lower-cased text, in UTF-8."""
    return text.translate(_BLANKED).split()


def grams_of(words: list[bytes], n: int) -> list[bytes]:
    return words if n == 1 else [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


class Buckets:
    """Deals n-grams into buckets; those seen last are kept at hand."""

    def __init__(self, count: int):
        self.count, self.known = count, {}

    def of(self, grams: list[bytes]) -> list[int]:
        if len(self.known) > KEPT_GRAMS:
            self.known = {}
        known, count = self.known, self.count
        out = []
        for gram in grams:
            bucket = known.get(gram)
            if bucket is None:
                bucket = known[gram] = zlib.crc32(gram) % count
            out.append(bucket)
        return out


def line_features(most: int, count: int):
    """The number of words of a line, and the buckets of its n-grams of 1 to ``most`` words."""

    def run(lines: pa.Array) -> pa.Array:
        buckets, sizes, found = Buckets(count), [], []
        for line in lines.cast(pa.binary()).to_pylist():
            words = words_of(line)
            sizes.append(len(words))
            found.append([b for n in range(1, most + 1) for b in buckets.of(grams_of(words, n))])
        columns = [pa.array(sizes, pa.int32()), pa.array(found, pa.list_(pa.int32()))]
        return pa.StructArray.from_arrays(columns, ["words", "features"])

    return F.arrow_udf(run, "words int, features array<int>")


def crossing_grams(text: bytes, most: int) -> list[bytes]:
    """The n-grams of a lower-cased text that reach over a newline.

    Only the first and last ``most - 1`` words of a line can be in one, and a line of fewer words
    can lie inside of one; so of a longer line only its ends are looked at.
    """
    reach, out = most - 1, []
    last: list[tuple[bytes, int]] = []  # the words so far that can still begin one, each with its line's number
    for number, line in enumerate(text.split(b"\n")):
        words = words_of(line)
        for word in words[:reach]:
            last.append((word, number))
            for n in range(2, most + 1):
                if n <= len(last) and last[-n][1] != number:
                    out.append(b" ".join(w for w, _ in last[-n:]))
        if len(words) > reach:
            last = [(word, number) for word in words[-reach:]]
        last = last[-most:]
    return out


def crossing(most: int, count: int):
    """The buckets of a text's n-grams over newlines, as a column function."""

    def run(texts: pa.Array) -> pa.Array:
        buckets = Buckets(count)
        found = [buckets.of(crossing_grams(t, most)) for t in texts.cast(pa.binary()).to_pylist()]
        return pa.array(found, pa.list_(pa.int32()))

    return F.arrow_udf(run, "array<int>")


class Segmented:
    """A collection as distinct lines: ``occurring`` by document, ``lines`` with their features.

    documents  ``rid, id``
    occurring  ``rid, a, b`` for every line with a word, ``a, b`` naming the line
    lines      ``a, b, words, features, occurrences``
    crossing   ``rid, crossing`` where n-grams of several words are asked for, else nothing
    """

    def __init__(self, docs: DataFrame, id_col: str | None, text_col: str, most: int, buckets: int):
        text = ascii_lower(filled(text_col)).alias("text")
        id_ = F.col(id_col) if id_col else F.lit(None).cast("bigint")
        docs = docs.select(F.monotonically_increasing_id().alias("rid"), id_.alias("id"), text)
        with_word = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
        # Hashes with two seeds: the first column is what the second hash starts from.
        names = F.transform(
            with_word, lambda x: F.struct(F.xxhash64(F.lit(1), x).alias("a"), F.xxhash64(F.lit(2), x).alias("b"))
        )
        over = crossing(most, buckets)("text") if most > 1 else F.array().cast("array<int>")
        cut = staged(docs.select("rid", "id", names.alias("names"), over.alias("crossing")))
        self.documents = cut.select("rid", "id")
        self.occurring = cut.select("rid", F.inline("names"))
        counted = docs.select(F.explode(with_word).alias("line")).groupBy("line").agg(F.count("*").alias("occurrences"))
        self.lines = staged(
            counted.select(
                F.xxhash64(F.lit(1), "line").alias("a"),
                F.xxhash64(F.lit(2), "line").alias("b"),
                line_features(most, buckets)("line").alias("found"),
                "occurrences",
            ).select("a", "b", "found.*", "occurrences")
        )
        self.crossing = cut.select("rid", "crossing") if most > 1 else None

    def counts(self) -> dict[int, int]:
        """How often the collection holds each bucket; as many rows as buckets come to the driver."""
        every = self.lines.select(F.explode("features").alias("bucket"), "occurrences")
        if self.crossing is not None:
            every = every.unionByName(self.crossing.select(F.explode("crossing").alias("bucket"), F.lit(1).cast("bigint").alias("occurrences")))
        return {r["bucket"]: r["n"] for r in every.groupBy("bucket").agg(F.sum("occurrences").alias("n")).collect()}

    def totals(self, gains: Column) -> DataFrame:
        """``rid, id, words, n_features, weight`` of every document."""
        worth = lambda features: F.aggregate(
            features, F.lit(0).cast("bigint"), lambda total, bucket: total + F.get(gains, bucket)
        )
        spark = self.lines.sparkSession
        lines = staged(
            self.lines.select("a", "b", "occurrences", "words", F.size("features").alias("features"), worth(F.col("features")).alias("worth"))
        )
        known = lines.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("n")).first()["n"]
        hot = lines.filter(F.col("occurrences") > max(known // shuffle_partitions(spark), 1)).select(
            "a", "b", *[F.col(c).alias(f"hot_{c}") for c in ("words", "features", "worth")]
        )
        values = ["rid", "words", "features", "worth"]
        marked = self.occurring.join(F.broadcast(hot), ["a", "b"], "left")
        of_hot = marked.filter("hot_words is not null").select("rid", *[F.col(f"hot_{c}").alias(c) for c in values[1:]])
        of_cold = marked.filter("hot_words is null").select("rid", "a", "b").join(lines, ["a", "b"]).select(*values)
        own = self.documents.select("rid", "id", *[F.lit(0).alias(c) for c in values[1:]])
        if self.crossing is not None:
            extra = self.crossing.select("rid", F.lit(0).alias("words"), F.size("crossing").alias("features"), worth(F.col("crossing")).alias("worth"))
            of_hot = of_hot.unionByName(extra)
        every = of_hot.unionByName(of_cold).unionByName(own, allowMissingColumns=True)
        return every.groupBy("rid").agg(
            F.max("id").alias("id"),
            F.sum("words").alias("words"),
            F.sum("features").alias("n_features"),
            F.sum("worth").alias("weight"),
        )


def gain_table(of_corpus: dict[int, int], of_target: dict[int, int], buckets: int, scale: int = 1000) -> Column:
    """The gains of all buckets as one constant array."""
    all_of_corpus, all_of_target = sum(of_corpus.values()), sum(of_target.values())

    def gain(bucket: int) -> int:
        more = float(of_target.get(bucket, 0) + 1) * float(all_of_corpus + buckets)
        less = float(of_corpus.get(bucket, 0) + 1) * float(all_of_target + buckets)
        return math.floor(scale * math.log(more / less))

    # One literal: a column of 10,000 literals would cost as many calls.
    return F.split(F.lit(",".join(str(gain(i)) for i in range(buckets))), ",").cast("array<bigint>")


def gumbel(id_: Column, seed: int, scale: int = 1000) -> Column:
    """Noise of a document that depends on its id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / HASH_RANGE))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    most: int = 1,
    buckets: int = BUCKETS,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """``id, words, n_features, weight, score, rank`` of every document; undrawn ones have no rank.

    Of the N documents with ``least_words`` words or more, ``N * percent / 100`` are drawn.
    """
    corpus = Segmented(docs, id_col, text_col, most, buckets)
    wanted = Segmented(target, None, target_text_col, most, buckets)
    gains = gain_table(corpus.counts(), wanted.counts(), buckets)
    scored = staged(
        corpus.totals(gains).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    )
    able = F.col("words") >= least_words
    draw = scored.filter(able).count() * percent // 100
    order = ["down", "no_id", "id"]
    ranked = placed(
        scored.withColumns({"able": able.cast("int"), "down": -F.col("score"), "no_id": F.col("id").isNull()}), ["able"], order
    )
    rank = F.when((F.col("able") == 1) & (F.col("pos") < draw), F.col("pos") + 1)
    return ranked.select("id", "words", "n_features", "weight", "score", rank.alias("rank"))


def op11_segment_resampling(spark, sf_dir) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


OP11_SQL = (
    """
WITH texts AS (
    SELECT 'd' AS side, doc_id, row_number() OVER () AS rid,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
    UNION ALL
    SELECT 'b', NULL, -row_number() OVER (),
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    FROM benchmark
), cut AS (
    SELECT side, rid, unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM texts
), """
    + CRC_SQL.format(words="cut")
    + """, dealt AS (
    SELECT side, rid, crc % 10000 AS bucket FROM cut JOIN crcs USING (word)
), counts AS (
    SELECT b.bucket,
           (SELECT count(*) FROM dealt WHERE side = 'd') AS all_s, (SELECT count(*) FROM dealt WHERE side = 'b') AS all_t,
           count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
    FROM dealt b GROUP BY b.bucket
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST(all_s AS DOUBLE) + 10000)
           / ((CAST(s AS DOUBLE) + 1) * (CAST(all_t AS DOUBLE) + 10000)))) AS BIGINT) AS gain
    FROM counts
), weights AS (
    SELECT rid, count(*) AS n, sum(gain) AS weight FROM dealt JOIN gains USING (bucket) WHERE side = 'd' GROUP BY rid
), hashed AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, rid,
           CAST(CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) AS h
    FROM texts LEFT JOIN weights USING (rid) WHERE side = 'd'
), scored AS (
    SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM hashed
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, rid) AS place,
           count(*) FILTER (n_features >= 20) OVER () AS able
    FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank
FROM ranked
"""
)
