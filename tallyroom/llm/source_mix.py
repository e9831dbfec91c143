"""Mixing sources to target weights by a low-discrepancy schedule.

1. *Targets.* Sources share all words by weight. A target stops at ``max_repeat`` times what its
   source holds, and the excess goes to the other sources by weight until none is above. Sorted by
   how soon they stop, the stopped sources are a prefix, so one running sum finds them.
2. *Schedule.* Slot ``i`` has the golden-ratio point ``i * 1640531527 mod 2^32``. The cumulative
   shares of the targets cut the same range into one interval per source, and the interval that
   holds the point names the slot's source. The slots of a source are ranked; rank ``k`` takes the
   source's block ``k``. Points miss an interval's share by a few slots at most; the blocks that
   are still missing close the schedule, and slots beyond a target are left out.
3. *Blocks.* The documents of a source are shuffled by a seeded hash and laid end to end, again and
   again up to ``max_repeat`` times. The stream up to the target is cut into blocks of equally many
   words (the last one ends at the target), and blocks and slots are joined.

Intervals are found through a grid of cells joined by equality, ranks and offsets through two
levels (inside a chunk or range, then over their totals), so no source, however large, has its slots
or its documents in one task. Only the table of sources, one row each, is sorted as a whole.

Defined results: a null text has no words. A document without words belongs to no block and takes
nothing. A null source is a source of its own, the last. Repeated rows are documents of their own.
A source without words has the target 0. An empty table gives empty results. Extra columns are
ignored, or carried along by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.llm.ranks import placed
from tallyroom.llm.stages import keyed_rows
from tallyroom.llm.text import filled, shuffle_partitions, table, word_count
from tallyroom.plans.stages import fits_broadcast, staged

POINTS = 1 << 32
# 2^32 divided by the square of the golden ratio.
STEP = 1640531527
SLOTS_PER_CHUNK = 1024
# Slots in a partition of mixed documents.
MIN_RANGE_SLOTS, MAX_RANGE_SLOTS = 64, 8192


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights dealt in turn to the sources by code point, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(w) for w in cycle])
    return sources.select("source", F.get(weights, place % len(cycle)).alias("weight"))


def targets(sizes: DataFrame, weights: DataFrame, max_repeat: int = 3) -> DataFrame:
    """``source, source_size, weight, target`` from ``source, source_size`` and ``source, weight``."""
    known = sizes.alias("s").join(
        weights.alias("w"), F.col("s.source").eqNullSafe(F.col("w.source")), "left"
    ).select("s.source", "source_size", F.coalesce("weight", F.lit(0)).alias("weight"))
    known = known.withColumns(
        {
            "cap": F.col("source_size") * max_repeat,
            "share": F.when(F.col("source_size") > 0, F.col("weight")).otherwise(0),
        }
    )
    soon = F.when(F.col("share") > 0, F.col("cap") / F.col("share")).asc_nulls_last()
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(soon, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumns(
        {
            "words": F.sum("source_size").over(whole),
            "shares": F.sum("share").over(whole),
            "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "share_before": F.coalesce(F.sum("share").over(before), F.lit(0)),
        }
    )
    # Doubles: with very many sources these products leave the range of a long.
    stops = F.col("cap").cast("double") * (F.col("shares") - F.col("share_before")) <= F.col("share").cast(
        "double"
    ) * (F.col("words") - F.col("cap_before"))
    known = known.withColumn("stops", stops & (F.col("share") > 0))
    stopped = lambda name: F.sum(F.when(F.col("stops"), F.col(name)).otherwise(0)).over(whole)
    level = (F.col("words") - stopped("cap")) / F.nullif(F.col("shares") - stopped("share"), F.lit(0))
    target = F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(
        F.coalesce(F.col("share") * level, F.lit(0.0))
    )
    return known.withColumn("target", target).select("source", "source_size", "weight", "target")


def shuffled_sizes(
    docs: DataFrame, seed: str, id_col: str, text_col: str, source_col: str, rid_col: str | None
) -> DataFrame:
    """One narrow row per document: ``rid, id, source, size, u`` with ``u`` its shuffle key."""
    return docs.select(
        (F.col(rid_col) if rid_col else F.monotonically_increasing_id()).alias("rid"),
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(filled(text_col)).alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("u"),
    )


def stream_offsets(sizes: DataFrame) -> DataFrame:
    """Where each document starts in its source's shuffled stream.

    The streams are cut into ranges that rows of one id, or without any, do not keep together.
    """
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("g")
    found = placed(sizes.select("*", key), ["g"], ["u", "id", "size", "rid"], F.col("size"))
    return found.select("rid", "id", "source", "size", F.col("pos").alias("offset"))


def schedule(goals: DataFrame, words: int, block_words: int) -> DataFrame:
    """``slot, source, block`` for every block that the targets hold, in the order of the mix."""
    spark = goals.sparkSession
    slots = -(-words // block_words)
    goals = goals.filter("quota > 0")
    upto = Window.orderBy(F.col("source").asc_nulls_last())
    total = F.nullif(F.sum("quota").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(0))
    high = F.sum("quota").over(upto.rowsBetween(Window.unboundedPreceding, 0)) / total * POINTS
    spans = goals.select(
        F.col("source"),
        F.ceil(F.col("quota") / block_words).alias("need"),
        high.alias("high"),
    ).withColumn("low", F.coalesce(F.lag("high").over(upto), F.lit(0.0)))
    count = max(goals.count(), 1)
    cells = 1 << (4 * count - 1).bit_length()
    width = POINTS // cells
    grid = spans.withColumn(
        "cell",
        F.explode(F.sequence(F.floor(F.col("low") / width), F.least(F.floor(F.col("high") / width), F.lit(cells - 1)))),
    )
    point = F.pmod(F.pmod(F.col("slot"), F.lit(POINTS)) * F.lit(STEP), F.lit(POINTS))
    points = spark.range(slots).select(F.col("id").alias("slot")).withColumn("point", point)
    points = points.withColumn("cell", F.floor(F.col("point") / width))
    placed = points.join(grid, "cell").filter((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
    placed = placed.select("slot", "source", "need", F.floor(F.col("slot") / SLOTS_PER_CHUNK).alias("chunk"))

    per_chunk = placed.groupBy("source", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_chunk.select(
        F.col("source").alias("b_source"),
        F.col("chunk").alias("b_chunk"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"),
    )
    rank = F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1
    same = F.col("source").eqNullSafe(F.col("b_source")) & (F.col("chunk") == F.col("b_chunk"))
    ranked = (
        placed.withColumn("rank", rank)
        .join(bases, same)
        .withColumn("block", F.col("base") + F.col("rank"))
        .filter(F.col("block") < F.col("need"))
        .select("slot", "source", "block")
    )
    counts = per_chunk.groupBy("source").agg(F.sum("n").alias("n"))
    closing = (
        spans.alias("g")
        .join(counts.alias("c"), F.col("g.source").eqNullSafe(F.col("c.source")), "left")
        .select("g.source", "need", F.coalesce("n", F.lit(0)).alias("n"))
        .filter("n < need")
        .select(F.lit(slots).cast("bigint").alias("slot"), "source", F.explode(F.sequence(F.col("n"), F.col("need") - 1)).alias("block"))
    )
    return ranked.unionByName(closing)


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    block_words: int = 2048,
    max_repeat: int = 3,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    rid_col: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``documents``, ``goals`` and ``pieces`` of the mix.

    documents  ``rid, id, source, size, offset``
    goals      ``source, source_size, weight, target, quota``
    pieces     ``slot, source, block, rid, epoch, start, length``: which words of which document
               stand in which slot, ``slot`` giving the order of training

    ``weights`` has ``source, weight``; without it the sources weigh 1, 2, 3 in turn. ``rid_col``
    names a column that numbers the rows; without it they are numbered here.
    """
    sizes = staged(shuffled_sizes(docs, seed, id_col, text_col, source_col, rid_col))
    words = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("words")).first()["words"]
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        weights = cycled_weights(per_source)
    goals = staged(
        targets(per_source, weights, max_repeat).withColumn("quota", F.floor(F.col("target") + 0.5))
    )
    documents = staged(stream_offsets(sizes))

    goal = goals.select(F.col("source").alias("g_source"), "source_size", "quota")
    copies = (
        documents.filter("size > 0")
        .join(goal, F.col("source").eqNullSafe(F.col("g_source")))
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))))
        .withColumn("begin", F.col("offset") + F.col("epoch") * F.col("source_size"))
        .filter(F.col("begin") < F.col("quota"))
        .withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("quota")))
    )
    cuts = copies.withColumn(
        "block",
        F.explode(F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words))),
    )
    first = F.greatest(F.col("begin"), F.col("block") * block_words)
    last = F.least(F.col("end"), (F.col("block") + 1) * block_words)
    cuts = cuts.select(
        F.col("source"), "block", "rid", "epoch", (first - F.col("begin")).alias("start"), (last - first).alias("length")
    )
    slots = schedule(goals, words, block_words).select(F.col("source").alias("s_source"), F.col("block").alias("s_block"), "slot")
    same = F.col("source").eqNullSafe(F.col("s_source")) & (F.col("block") == F.col("s_block"))
    pieces = cuts.join(slots, same).select("slot", "source", "block", "rid", "epoch", "start", "length")
    return documents, goals, pieces


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = 2048,
    stored: bool = False,
    **options,
) -> DataFrame:
    """The documents of the mix with their own columns: one row per document and repeat.

    The rows are in the order of the schedule: partitions are ranges of slots, and inside them each
    use of a document stands at its first slot. Slots hold equally many words, and so do the ranges.

    Texts stay whole: the use of a document that the target would end in is in the mix with all of
    its words, so a source exceeds its target by less than one document. A document without words
    adds nothing to a mix and is not in it. ``stored`` says that ``docs`` are the rows of a file
    table as they lie there (``stages.keyed_rows``).
    """
    rows = keyed_rows(docs, stored)
    _, goals, pieces = mix(
        rows.select("rid", *[f"row.{c}" for c in (id_col, text_col, source_col)]),
        id_col=id_col, text_col=text_col, source_col=source_col, rid_col="rid", block_words=block_words, **options,
    )
    words = goals.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    slots = -(-words // block_words)
    ranges = max(1, -(-slots // MAX_RANGE_SLOTS), min(shuffle_partitions(docs.sparkSession), slots // MIN_RANGE_SLOTS))
    uses = staged(pieces.groupBy("rid", "epoch").agg(F.min("slot").alias("slot")))
    # Few uses travel to the texts; else both meet by the row's key, and the texts move twice.
    known = F.broadcast(uses) if fits_broadcast(uses, "rid") else uses
    return (
        rows.join(known, "rid")
        .withColumn("range", F.least(F.floor(F.col("slot") * ranges / max(slots, 1)), F.lit(ranges - 1)).cast("int"))
        .repartitionById(ranges, F.col("range"))
        .sortWithinPartitions("slot", "epoch", "rid")
        .select("row.*")
    )


def op4_source_mix(spark, sf_dir) -> DataFrame:
    """``first_slot`` and ``n_slots`` tell where in the order of training a document stands, and how often."""
    documents, goals, pieces = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    by_slot = pieces.groupBy("rid", "slot").agg(F.sum("length").alias("taken"))
    taken = by_slot.groupBy("rid").agg(
        F.sum("taken").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("n_slots")
    )
    goal = goals.select(F.col("source").alias("g_source"), "source_size", "target")
    return (
        documents.join(taken, "rid", "left")
        .join(goal, F.col("source").eqNullSafe(F.col("g_source")), "left")
        .select(
            F.col("id").alias("doc_id"),
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
            "first_slot",
            F.coalesce("n_slots", F.lit(0)).cast("bigint").alias("n_slots"),
        )
    )


# Words come from running sums: the blocks 0, 1, 2, ... up to the target are what every schedule must
# take. Slots come from the points of the schedule.
OP4_SQL = """
WITH sizes AS (
    SELECT doc_id, source, md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS u,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
), weighed AS (
    SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM sources
), known AS (
    SELECT *, source_size * 3 AS cap, CASE WHEN source_size > 0 THEN weight ELSE 0 END AS share FROM weighed
), running AS (
    SELECT *,
           CAST(sum(source_size) OVER () AS BIGINT) AS words,
           CAST(sum(share) OVER () AS BIGINT) AS shares,
           CAST(coalesce(sum(cap) OVER earlier, 0) AS BIGINT) AS cap_before,
           CAST(coalesce(sum(share) OVER earlier, 0) AS BIGINT) AS share_before
    FROM known
    WINDOW earlier AS (ORDER BY CASE WHEN share > 0 THEN cap / share END NULLS LAST, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), stopping AS (
    SELECT *, share > 0 AND CAST(cap AS DOUBLE) * (shares - share_before) <= CAST(share AS DOUBLE) * (words - cap_before) AS stops FROM running
), goals AS (
    SELECT source, source_size,
           CASE WHEN stops THEN CAST(cap AS DOUBLE)
                ELSE coalesce(share * ((words - CAST(coalesce(sum(cap) FILTER (stops) OVER (), 0) AS BIGINT))
                     / nullif(shares - CAST(coalesce(sum(share) FILTER (stops) OVER (), 0) AS BIGINT), 0)), 0.0) END AS target
    FROM stopping
), placed AS (
    SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY u, doc_id, size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off
    FROM sizes
), quotas AS (
    SELECT source, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS quota FROM goals
), spans AS (
    SELECT source, (quota + 2047) // 2048 AS need,
           coalesce(CAST(sum(quota) OVER before AS DOUBLE), 0) / CAST(sum(quota) OVER () AS DOUBLE) * 4294967296 AS low,
           CAST(sum(quota) OVER upto AS DOUBLE) / CAST(sum(quota) OVER () AS DOUBLE) * 4294967296 AS high
    FROM quotas WHERE quota > 0
    WINDOW before AS (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           upto AS (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), points AS (
    SELECT slot, slot * 1640531527 % 4294967296 AS point
    FROM range((SELECT CAST((coalesce(sum(size), 0) + 2047) // 2048 AS BIGINT) FROM sizes)) r(slot)
), ranked AS (
    SELECT slot, source, need, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS block
    FROM points JOIN spans ON point >= low AND point < high
), slots AS (
    SELECT slot, source, block FROM ranked WHERE block < need
    UNION ALL
    SELECT (SELECT count(*) FROM points), s.source, unnest(range(coalesce(n, 0), need))
    FROM spans s LEFT JOIN (SELECT source, count(*) AS n FROM ranked GROUP BY source) c ON c.source IS NOT DISTINCT FROM s.source
    WHERE coalesce(n, 0) < need
), uses AS (
    SELECT p.*, g.source_size, g.target,
           p.off + e.epoch * g.source_size AS begins, least(p.off + e.epoch * g.source_size + p.size, g.quota) AS ends
    FROM placed p
    JOIN quotas g ON p.source IS NOT DISTINCT FROM g.source
    CROSS JOIN (VALUES (0), (1), (2)) AS e(epoch)
), blocks AS (
    SELECT doc_id, source, off, u, size, unnest(range(begins // 2048, (ends - 1) // 2048 + 1)) AS block
    FROM uses WHERE size > 0 AND begins < ends
), stands AS (
    SELECT b.doc_id, b.source, b.off, b.u, b.size, min(slot) AS first_slot, count(DISTINCT slot) AS n_slots
    FROM blocks b JOIN slots s ON s.source IS NOT DISTINCT FROM b.source AND s.block = b.block
    GROUP BY ALL
)
SELECT x.doc_id, x.size, x.source_size, x.target, x.taken, first_slot, coalesce(n_slots, 0) AS n_slots
FROM (SELECT doc_id, source, off, u, size, source_size, target,
             CAST(sum(greatest(0, ends - begins)) AS BIGINT) AS taken
      FROM uses GROUP BY ALL) x
LEFT JOIN stands s ON s.doc_id IS NOT DISTINCT FROM x.doc_id AND s.source IS NOT DISTINCT FROM x.source
                  AND s.off = x.off AND s.u = x.u AND s.size = x.size
"""
