"""Merkle manifest of a dataset by butterfly exchange.

A row's leaf is the digest of its fields. The leaves of a source, in order, are the bottom of its
tree: every ``fanout`` consecutive nodes become their digest until one is left, the subroot, and the
subroots of all sources, in order, make the root the same way. Every row gets its proof: the
siblings on the way up.

1. *Places.* The leaves are sorted by ranges and numbered (``ranks.placed``), so no task holds a
   source.
2. *Partitions.* ``fanout ** depth`` consecutive leaves, aligned, are a partition of the manifest. It
   is built where it lies: windows over its aligned runs give every row its siblings below the
   partition's root.
3. *Butterfly exchange.* Then partitions meet in groups of ``fanout``. In round ``r`` a partition
   meets those whose number differs from its own in the ``r``-th digit to the base ``fanout`` only,
   all of them show the root of the aligned subtree they stand in, and every one of them hashes the
   common ancestor itself. The shown roots are its siblings on that level. So after the last round
   each partition holds its whole upper proof, and nothing is handed down again. In the last,
   incomplete subtree of a level fewer partitions stand in for the missing ones, in turn.

A group of a round is ``fanout`` narrow rows, whatever the source's size, and a partition takes part
in each round once. The stand-ins of a level at most double its rows. The same code runs over the
table of subroots, one row per source.

Defined results: a null field is ``-`` in the leaf. Leaves ascend by id (a null id first), then by
digest. Rows that are equal throughout are leaves of their own with equal digests, which of them
takes which place cannot be told apart, so which proof goes to which cannot either. A null source is a source of its own, the first. The only row
of a table has an empty proof and is the root. An empty table gives an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.llm.crc import CRC_SQL
from tallyroom.llm.ranks import placed
from tallyroom.llm.text import ascii_lower, table
from tallyroom.plans.stages import staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
DEPTH = 3
NO_LEVELS = "CAST(array() AS array<struct<left: string, right: string>>)"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def source_key(source: Column) -> Column:
    """A text that is never null and sorts as the source does, null first."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _risen(nodes: Column, place: Column, fanout: int, there: Column) -> tuple[Column, Column]:
    """The parent of the node at ``place`` of its run, and the siblings on both sides of it."""
    left = F.array_join(F.slice(nodes, F.lit(1), place), "")
    right = F.array_join(F.slice(nodes, place + 2, F.lit(fanout)), "")
    parent = F.when(there, F.sha2(F.array_join(nodes, ""), 256)).otherwise(F.col("node"))
    level = F.when(there, F.array(F.struct(left.alias("left"), right.alias("right")))).otherwise(F.expr(NO_LEVELS))
    return parent, level


def _inside(rows: DataFrame, fanout: int, depth: int) -> DataFrame:
    """``rows`` (``key, pos, n, node``) with ``node`` their partition's root and ``levels`` up to it."""
    rows = rows.withColumn("block", F.expr(f"pos div {fanout**depth}")).repartition("key", "block")
    rows = rows.withColumn("levels", F.expr(NO_LEVELS))
    for level in range(depth):
        width = fanout**level
        run = Window.partitionBy("key", "block", F.expr(f"pos div {width * fanout}")).orderBy("pos")
        run = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # The first leaf below a node stands for it.
        rows = rows.withColumn("run", F.collect_list(F.when(F.expr(f"pos % {width} = 0"), F.col("node"))).over(run))
        place = F.expr(f"CAST(pos div {width} % {fanout} AS int)")
        parent, siblings = _risen(F.col("run"), place, fanout, F.col("n") > width)
        rows = rows.withColumns({"node": parent, "levels": F.concat("levels", siblings)}).drop("run")
    return rows


def _exchanged(blocks: DataFrame, round_: int, fanout: int, depth: int) -> DataFrame:
    """One round: ``blocks`` (``key, block, n, node, levels``) one level higher."""
    reach = fanout**round_
    there = F.col("n") > fanout**depth * reach
    subtree, lane = F.expr(f"block div {reach}"), F.expr(f"block % {reach}")
    total = F.expr(f"(n + {fanout**depth - 1}) div {fanout**depth}")
    held = F.least(F.lit(reach).cast("bigint"), total - subtree * reach)
    lanes = F.when(there, F.sequence(lane, F.lit(reach - 1).cast("bigint"), held)).otherwise(F.array(lane))
    shown = blocks.withColumns({"subtree": subtree, "lane": lane}).withColumn("meets", F.explode(lanes))
    group = Window.partitionBy("key", F.expr(f"subtree div {fanout}"), "meets").orderBy("subtree")
    group = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    met = shown.withColumn("run", F.collect_list("node").over(group)).filter("lane = meets")
    parent, siblings = _risen(F.col("run"), F.expr(f"CAST(subtree % {fanout} AS int)"), fanout, there)
    return met.withColumns({"node": parent, "levels": F.concat("levels", siblings)}).select(*blocks.columns)


def _partitions(rows: DataFrame, fanout: int, depth: int) -> DataFrame:
    """``key, block, n, node, levels``: every partition with its tree's root and its upper proof."""
    blocks = staged(
        _inside(rows.select("key", "pos", "n", "node"), fanout, depth)
        .filter(f"pos % {fanout**depth} = 0")
        .select("key", "block", "n", "node")
        .withColumn("levels", F.expr(NO_LEVELS))
    )
    most = blocks.agg(F.max("n")).first()[0] or 0
    round_ = 0
    while fanout ** (depth + round_) < most:
        blocks = staged(_exchanged(blocks, round_, fanout, depth))
        round_ += 1
    return blocks


def manifest(
    leaves: DataFrame, fanout: int = FANOUT, depth: int = DEPTH
) -> DataFrame:
    """Every row of ``leaves`` (``key, id, leaf``, others carried) with ``subroot, root, levels``.

    ``levels`` holds, from the bottom up, the digests left and right of the row's way to the root,
    each side as one text. ``fold`` goes that way from any leaf.
    """
    if fanout < 2 or depth < 1:
        raise ValueError("a tree needs a fanout of 2 and a depth of 1 at least")
    rows = staged(placed(leaves, ["key"], ["id", "leaf"]).withColumn("node", F.col("leaf")))
    blocks = _partitions(rows, fanout, depth)

    subroots = staged(blocks.filter("block = 0").select(F.lit("").alias("key"), F.col("key").alias("source"), "node"))
    sources = staged(placed(subroots, ["key"], ["source"]))
    tops = _partitions(sources, fanout, depth).select(
        "key", "block", F.col("node").alias("root"), F.col("levels").alias("above")
    )
    sources = (
        _inside(sources.withColumn("subroot", F.col("node")), fanout, depth)
        .join(tops, ["key", "block"])
        .select(F.col("source").alias("key"), "subroot", "root", F.concat("levels", "above").alias("top"))
    )
    upper = staged(
        blocks.join(sources, "key").select("key", "block", "subroot", "root", F.concat("levels", "top").alias("upper"))
    )
    return (
        _inside(rows, fanout, depth)
        .join(upper, ["key", "block"])
        .withColumn("levels", F.concat("levels", "upper"))
        .drop("key", "pos", "n", "node", "block", "upper")
    )


def fold(leaf: Column, levels: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(levels, leaf, lambda node, x: F.sha2(F.concat(x.left, node, x.right), 256))


def proof_digest(levels: Column) -> Column:
    return F.sha2(F.array_join(F.transform(levels, lambda x: F.concat(x.left, x.right)), ""), 256)


def document_leaves(docs: DataFrame, tampered: Column | None = None, id_col: str = "doc_id", source_col: str = "source", fields: tuple[str, ...] = FIELDS, text_col: str = "text") -> DataFrame:
    """``key, id, leaf`` of the documents, and ``changed``: the leaf where ``tampered`` lowered the text."""
    was = [F.col(name) for name in fields]
    now = [ascii_lower(F.col(name)) if name == text_col else F.col(name) for name in fields]
    changed = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf_digest(now))
    return docs.select(
        F.col(id_col).alias("id"),
        source_key(F.col(source_col)).alias("key"),
        leaf_digest(was).alias("leaf"),
        changed.alias("changed"),
    )


def op13_merkle_manifest(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return verified(manifest(staged(document_leaves(docs, tampered))))


def verified(found: DataFrame) -> DataFrame:
    """Digests of the proofs, and what the leaf that is there now gives with them."""
    return found.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("levels")).alias("proof_sha256"),
        fold(F.coalesce("changed", "leaf"), F.col("levels")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_tree(rows: str, levels: int, name: str) -> str:
    """CTEs that climb from ``rows`` (``g, n, pos, digest``): nodes by level, and each run's digests."""
    parts = [f"{name}0 AS (SELECT g, n, pos, digest FROM {rows})"]
    for level in range(levels):
        there = f"n > {FANOUT**level}"
        parts.append(
            f"{name}r{level} AS (SELECT g, pos // {FANOUT} AS up, list(digest ORDER BY pos) AS run "
            f"FROM {name}{level} WHERE {there} GROUP BY ALL)"
        )
        parts.append(
            f"{name}{level + 1} AS (SELECT g, n, pos // {FANOUT} AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest "
            f"FROM {name}{level} WHERE {there} GROUP BY g, n, pos // {FANOUT} "
            f"UNION ALL SELECT g, n, pos, digest FROM {name}{level} WHERE NOT {there})"
        )
    return ",\n".join(parts)


def _sql_path(rows: str, levels: int, name: str, tree: str, result: str) -> str:
    """CTEs that walk every row of ``rows`` (``g, pos, proof, folded``) up, level by level."""
    parts, before = [], rows
    for level in range(levels):
        at = f"(x.pos // {FANOUT**level})"
        left, right = f"array_to_string(run[1:{at} % {FANOUT}], '')", f"array_to_string(run[{at} % {FANOUT} + 2:], '')"
        parts.append(
            f"{name}{level} AS (SELECT x.* EXCLUDE (proof, folded), "
            f"CASE WHEN run IS NULL THEN proof ELSE proof || {left} || {right} END AS proof, "
            f"CASE WHEN run IS NULL THEN folded ELSE sha256({left} || folded || {right}) END AS folded "
            f"FROM {before} x LEFT JOIN {tree}r{level} r ON r.g = x.g AND r.up = {at} // {FANOUT})"
        )
        before = f"{name}{level}"
    return ",\n".join([*parts, f"{result} AS (SELECT * FROM {before})"])


def _sql_field(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    return f"coalesce(CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text}, '-')"


# Levels enough for 16^6 documents a source and as many sources.
_SQL_LEVELS = 6
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP13_SQL = f"""
WITH words AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS word FROM documents WHERE doc_id IS NOT NULL),
{CRC_SQL.format(words="words").strip()},
leaves AS (
    SELECT doc_id, coalesce('=' || source, '') AS g, coalesce(crc % 5 = 0, false) AS tampered,
           sha256({" || ".join(map(_sql_field, FIELDS))}) AS leaf,
           sha256({" || ".join(map(_sql_field, (*FIELDS[:-1], _LOWERED)))}) AS changed
    FROM documents LEFT JOIN crcs ON word = CAST(doc_id AS VARCHAR)
), numbered AS (
    SELECT *, leaf AS digest, count(*) OVER (PARTITION BY g) AS n,
           row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM leaves
),
{_sql_tree("numbered", _SQL_LEVELS, "t")},
subroots AS (
    SELECT g AS key, digest AS subroot, digest, '' AS g, count(*) OVER () AS n,
           row_number() OVER (ORDER BY encode(g)) - 1 AS pos
    FROM t{_SQL_LEVELS}
),
{_sql_tree("subroots", _SQL_LEVELS, "s")},
starts AS (SELECT *, '' AS proof, CASE WHEN tampered THEN changed ELSE leaf END AS folded FROM numbered),
{_sql_path("starts", _SQL_LEVELS, "p", "t", "up")},
tops AS (
    SELECT s.g, s.pos, s.subroot, x.doc_id, x.leaf, x.proof, x.folded FROM up x JOIN subroots s ON s.key = x.g
),
{_sql_path("tops", _SQL_LEVELS, "q", "s", "ended")}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM ended CROSS JOIN (SELECT digest AS root FROM s{_SQL_LEVELS})
"""
