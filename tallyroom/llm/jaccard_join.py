"""N-gram Jaccard join with filters under several global token orders.

A document is the set of its word shingles, kept as 64-bit hashes. Sets linked at a similarity of
``percent`` share a token among the first ``n - ceil(percent * n) + 1`` tokens of each (its prefix)
under every global order of the tokens. Candidates come from an index of the prefixes under the
first order, must share as many of its tokens as their sizes require, and must also share a prefix
token under each further order, which is seen from the prefixes alone; only for the pairs that all
filters leave do whole sets travel, and are verified.

*Orders.* Tokens that a task saw in several documents come last, by their summed counts, so that
shared passages hardly enter a prefix; all others are ordered by a seeded hash. Any order gives the
same links, the counts only make the prefixes rare. At most ``MAX_FREQUENT`` tokens are kept for
that, which bounds what is broadcast.

*Classes.* Documents with equal sets are one class and are indexed once.

*Hot groups.* All near copies of one text share many tokens, and writing out their pairs would grow
with the square of the group. Only links between different components matter, so every group of
the index first pairs its members with single leaders, and the links found are merged into
components. Then only pairs across components are left: each holds a member outside the most
frequent component of its group, and only those members are joined with the rest. While that would
still be many pairs, further leaders are tried; in the end all that are left are verified, so no
link is lost.

Defined results: a null text or one without words has an empty set, links with nothing and is its
own component. Fewer words than a shingle make one shingle. Repeated rows are rows of one class, and
rows with equal ids and different texts keep a component each. A row without an id has a null
component, links nothing, and stays when one of each component is kept. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyroom.llm.components import compact, components
from tallyroom.llm.stages import keyed_rows
from tallyroom.llm.text import filled, table
from tallyroom.llm.wordhash import WordHasher, column_bytes, distinct_pairs, mix64, slices
from tallyroom.plans.stages import fits_broadcast, staged

ORDERS = (1, 2, 3)  # seeds; the first is the order of the index
MAX_FREQUENT = 1 << 20
SEEN_IN_TASK = 3
FREQUENT = 10
LEADERS = 4
MAX_LEADER_ROUNDS = 4
CROSS_PER_ROW = 64
_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)


def shingles(hasher: WordHasher, data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text as (text, hash), sorted by both."""
    value, text = hasher.words(data, offsets)
    steps = [np.uint64(_STEPS[j % len(_STEPS)] + 2 * (j // len(_STEPS))) for j in range(words)]
    texts, hashes = [], []
    if len(value) >= words:
        last = len(value) - words + 1
        whole = text[:last] == text[words - 1 :]
        total = np.zeros(last, dtype=np.uint64)
        for j, step in enumerate(steps):
            total += value[j : last + j] * step
        texts.append(text[:last][whole])
        hashes.append(mix64(total[whole]))
    count = np.bincount(text, minlength=len(offsets) - 1) if len(text) else np.zeros(len(offsets) - 1, dtype=np.int64)
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        first = np.searchsorted(text, short)
        total = mix64(count[short].astype(np.uint64) + np.uint64(words << 32))
        for j in range(words - 1):
            there = count[short] > j
            total[there] += value[first[there] + j] * steps[j]
        texts.append(short)
        hashes.append(mix64(total))
    if not texts:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return distinct_pairs(np.concatenate(texts), np.concatenate(hashes))


class Orders:
    """Sort keys of tokens under the global orders."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        by = np.argsort(tokens)
        self.tokens, self.counts = tokens[by], np.minimum(counts[by], (1 << 30) - 1).astype(np.uint64)

    def keys(self, token: np.ndarray, seed: int) -> np.ndarray:
        key = mix64(token ^ mix64(np.array([seed], dtype=np.uint64)))
        if not len(self.tokens):
            return key >> np.uint64(1)
        place = np.minimum(np.searchsorted(self.tokens, token), len(self.tokens) - 1)
        frequent = self.tokens[place] == token
        last = (np.uint64(1) << np.uint64(63)) | (self.counts[place] << np.uint64(32)) | (key >> np.uint64(32))
        return np.where(frequent, last, key >> np.uint64(1))


def prefixes(text: np.ndarray, token: np.ndarray, size: np.ndarray, key: np.ndarray, percent: int):
    """The prefix rows ``(text, token, position)`` under the order of ``key``; ``size`` by text."""
    order = np.lexsort((key, text))
    text, token = text[order], token[order]
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    position = np.arange(len(text)) - start[text]
    n = size[text]
    kept = position < n - (percent * n + 99) // 100 + 1
    return text[kept], token[kept], position[kept]


def _classes(text: np.ndarray, token: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and class of each text's set; texts with equal sets have equal classes."""
    size = np.bincount(text, minlength=rows) if len(text) else np.zeros(rows, dtype=np.int64)
    ends = np.cumsum(size)
    names = [
        int.from_bytes(hashlib.blake2b(token[end - n : end].tobytes(), digest_size=8).digest(), "little", signed=True)
        for n, end in zip(size, ends, strict=True)
    ]
    return size.astype(np.int64), np.array(names, dtype=np.int64)


def _shingled(batches: Iterator[pa.RecordBatch], words: int):
    hasher = WordHasher()
    for batch in batches:
        for part in slices(batch, "text"):
            text, token = shingles(hasher, *column_bytes(part.column("text")), words)
            size, name = _classes(text, token, part.num_rows)
            yield part, text, token, size, name


def _sets(docs: DataFrame, words: int) -> tuple[DataFrame, Orders]:
    """``id, n, c`` and the further columns for every document, and the orders that the counts give."""
    further = [name for name in docs.columns if name not in ("id", "text")]
    kinds = [to_arrow_type(docs.schema[name].dataType) for name in further]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = []
        names = ["id", "n", "c", "token", "seen", *further]
        for part, _, token, size, name in _shingled(batches, words):
            none = pa.nulls(part.num_rows, pa.int64())
            own = [part.column(name) for name in further]
            yield pa.RecordBatch.from_arrays([part.column("id").cast(pa.int64()), pa.array(size), pa.array(name), none, none, *own], names)
            counts.append(np.unique(token, return_counts=True))
            if sum(len(t) for t, _ in counts) > 1 << 22:
                counts = [_merged(counts, SEEN_IN_TASK)]
        if counts:
            token, seen = _merged(counts, SEEN_IN_TASK)
            none = pa.nulls(len(token), pa.int64())
            own = [pa.nulls(len(token), kind) for kind in kinds]
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(token.view(np.int64)), pa.array(seen), *own], names)

    schema = "id bigint, n bigint, c bigint, token bigint, seen bigint"
    schema += "".join(f", {name} {docs.schema[name].dataType.simpleString()}" for name in further)
    found = staged(docs.mapInArrow(run, schema))
    often = (
        found.filter("token is not null")
        .groupBy("token")
        .agg(F.sum("seen").alias("seen"))
        .filter(F.col("seen") >= FREQUENT)
        .orderBy(F.col("seen").desc(), "token")
        .limit(MAX_FREQUENT)
        .toArrow()
    )
    orders = Orders(
        often["token"].to_numpy().astype(np.int64).view(np.uint64), often["seen"].to_numpy().astype(np.int64)
    )
    return found.filter("token is null").select("id", "n", "c", *further), orders


def _merged(counts: list, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum counts by token and keep those of at least ``least``."""
    token = np.concatenate([t for t, _ in counts])
    token, back = np.unique(token, return_inverse=True)
    seen = np.zeros(len(token), dtype=np.int64)
    np.add.at(seen, back, np.concatenate([n for _, n in counts]))
    return token[seen >= least], seen[seen >= least]


def _index(docs: DataFrame, words: int, percent: int, orders) -> DataFrame:
    """``token, c, n, position`` of the first order's prefixes, each class once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for _, text, token, size, name in _shingled(batches, words):
            fresh = np.zeros(len(name), dtype=bool)
            for i, c in enumerate(name.tolist()):
                if size[i] and c not in done:
                    done.add(c)
                    fresh[i] = True
            wanted = fresh[text]
            number = np.cumsum(fresh) - 1
            text, token = number[text[wanted]], token[wanted]
            size, name = size[fresh], name[fresh]
            key = orders.value.keys(token, ORDERS[0])
            text, token, position = prefixes(text, token, size, key, percent)
            columns = [token.view(np.int64), name[text], size[text], position]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["token", "c", "n", "position"])

    return docs.mapInArrow(run, "token bigint, c bigint, n bigint, position bigint")


def _shared(index: DataFrame) -> DataFrame:
    """Index rows of tokens that more than one class has, each class once.

    Rows come sorted by token and class, so of the rows so far a task holds only the last one, and
    that its token has been met in another class already; a token of any number of classes streams through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "c", "n", "position"]
        held, met = np.empty((4, 0), np.int64), False  # the last row, not written unless ``met``
        for batch in batches:
            rows = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
            rows = np.concatenate([held, rows], axis=1)
            if not rows.shape[1]:
                continue
            token, c = rows[0], rows[1]
            new = np.ones(len(token), dtype=bool)
            new[1:] = (token[1:] != token[:-1]) | (c[1:] != c[:-1])
            rows = rows[:, new]
            token = rows[0]
            same = token[1:] == token[:-1]
            more = np.zeros(len(token), dtype=bool)
            more[1:] |= same
            more[:-1] |= same
            if met:
                more[0] = False  # written with the batch before
            met = bool(more[-1]) or (met and len(token) == 1)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows[:, more]], names)
            held = rows[:, -1:]

    laid = index.repartition("token").sortWithinPartitions("token", "c")
    return laid.mapInArrow(run, "token bigint, c bigint, n bigint, position bigint")


def _near_in_size(a: Column, b: Column, percent: int) -> Column:
    small, large = F.least(a, b), F.greatest(a, b)
    return 100 * small >= percent * large


def _leader_pairs(rows: DataFrame, percent: int, seeds: list[int], total: int) -> DataFrame:
    """Pairs of each group's leaders, one a seed, with the members of other components."""

    def leader(seed: int):
        # Tokens of a document's own come first in its order, so the member with most tokens after
        # the shared one has the fewest of its own: the text that the others are copies of.
        rank = F.col("position") - F.col("n") if seed == 0 else F.xxhash64("c", F.lit(seed))
        return F.min(F.struct(rank.alias("rank"), F.col("n"), F.col("c"), F.col("root")))

    picked = rows.groupBy("token").agg(F.array(*[leader(seed) for seed in seeds]).alias("leaders"))
    leaders = compact(picked, total)
    apart = lambda x: (x.root != F.col("root")) & _near_in_size(F.col("n"), x.n, percent)
    return (
        rows.join(leaders, "token")
        .select("c", F.explode(F.filter("leaders", apart)).alias("x"))
        .select(F.least("c", "x.c").alias("a"), F.greatest("c", "x.c").alias("b"))
        .distinct()
    )


def _with_root(groups: DataFrame, roots: DataFrame, total: int) -> DataFrame:
    named = roots.select(F.col("v").alias("c"), F.col("root"))
    return compact(groups.join(named, "c", "left").withColumn("root", F.coalesce("root", "c")), total)


def _minor_rows(rows: DataFrame, total: int) -> DataFrame:
    """Rows outside their group's most frequent component, and that group's number of rows."""
    per_root = rows.groupBy("token", "root").agg(F.count("*").alias("k"))
    major = compact(
        per_root.groupBy("token")
        .agg(F.max_by("root", F.struct("k", "root")).alias("major"), F.sum("k").alias("rows"), F.count("*").alias("roots"))
        .filter("roots > 1")
        .drop("roots"),
        total,
    )
    return compact(rows.join(major, "token").filter("root <> major"), total)


def _cross_pairs(rows: DataFrame, minor: DataFrame, percent: int) -> DataFrame:
    """All pairs across components that the positions of a shared token do not rule out."""
    left = minor.select("token", F.col("c").alias("x"), F.col("n").alias("xn"), F.col("position").alias("xp"), F.col("root").alias("xr"), "major")
    right = rows.select("token", F.col("c").alias("y"), F.col("n").alias("yn"), F.col("position").alias("yp"), F.col("root").alias("yr"))
    # Both outside the major component: once only.
    once = (F.col("yr") == F.col("major")) | (F.col("x") < F.col("y"))
    reach = 1 + F.least(F.col("xn") - 1 - F.col("xp"), F.col("yn") - 1 - F.col("yp"))
    needed = F.ceil(percent * (F.col("xn") + F.col("yn")) / F.lit(100 + percent))
    apart = (F.col("xr") != F.col("yr")) & once & _near_in_size(F.col("xn"), F.col("yn"), percent) & (reach >= needed)
    return (
        left.join(right, (left["token"] == right["token"]) & apart)
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )


def _counted(pairs: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Pairs that share enough prefix tokens of the index.

    Tokens past the shorter-reaching of two prefixes are at most ``n`` less the prefix length on one
    side, so what the overlap needs beyond that has to be shared inside the prefixes.
    """
    for end in ("a", "b"):
        side = shared.select(F.col("c").alias(end), F.col("n").alias(f"{end}_n"), F.col("tokens").alias(f"{end}_tokens"))
        pairs = pairs.join(side, end)
    overlap = F.ceil(percent * (F.col("a_n") + F.col("b_n")) / F.lit(100 + percent))
    beyond = F.ceil(percent * F.greatest("a_n", "b_n") / F.lit(100)) - 1
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return pairs.filter((common > 0) & (common >= overlap - beyond)).select("a", "b")


def _candidate_sets(texts: DataFrame, words: int, percent: int, orders) -> DataFrame:
    """``c, tokens`` and, for every further order, ``order_K``: the prefix in halves of its hashes.

    Half of a hash is enough for a filter: equal halves of different tokens only let a pair through.
    """
    names = [f"order_{seed}" for seed in ORDERS[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # rows that repeat an id come once a task
        for _, text, token, size, name in _shingled(batches, words):
            fresh = np.zeros(len(name), dtype=bool)
            fresh[[i for c, i in {c: i for i, c in enumerate(name.tolist())}.items() if c not in done]] = True
            done |= set(name[fresh].tolist())
            wanted, number = fresh[text], np.cumsum(fresh) - 1
            text, token, size, name = number[text[wanted]], token[wanted], size[fresh], name[fresh]
            ends = np.cumsum(size)
            columns = [pa.array(name), pa.array([token[e - n : e].tobytes() for n, e in zip(size, ends, strict=True)], pa.binary())]
            for seed in ORDERS[1:]:
                owner, first, _ = prefixes(text, token, size, orders.value.keys(token, seed), percent)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(size)))])
                halves = (first >> np.uint64(32)).astype(np.uint32).view(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(halves)))
            yield pa.RecordBatch.from_arrays(columns, ["c", "tokens", *names])

    schema = "c bigint, tokens binary" + "".join(f", {name} array<int>" for name in names)
    return staged(texts.mapInArrow(run, schema))


def _in_all_orders(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that share a prefix token under every further order; only prefixes travel."""
    names = [f"order_{seed}" for seed in ORDERS[1:]]
    for end in ("a", "b"):
        side = sets.select(F.col("c").alias(end), *[F.col(name).alias(f"{end}_{name}") for name in names])
        pairs = pairs.join(side, end)
    for name in names:
        pairs = pairs.filter(F.arrays_overlap(f"a_{name}", f"b_{name}"))
    return pairs.select("a", "b")


def _verified(pairs: DataFrame, found: DataFrame, docs: DataFrame, words: int, percent: int, orders) -> DataFrame:
    """The linked ones among pairs of classes, as ``a, b``: further orders first, then whole sets."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    ids = found.join(wanted, "c", "left_semi").groupBy("c").agg(F.min("id").alias("id")).select("id")
    ids = compact(ids, 2 * pairs.count())
    texts = docs.join(F.broadcast(ids) if fits_broadcast(ids, "id") else ids, "id", "left_semi")
    sets = _candidate_sets(texts, words, percent, orders)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(t.as_buffer(), np.uint64) for t in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    both = _in_all_orders(pairs, sets)
    both = both.join(sets.select(F.col("c").alias("a"), F.col("tokens").alias("x")), "a")
    both = both.join(sets.select(F.col("c").alias("b"), F.col("tokens").alias("y")), "b")
    # Not in fewer tasks than the join gives: its rows are wide, and adaptive execution sizes them.
    return staged(both.select("a", "b", "x", "y").mapInArrow(verify, "a bigint, b bigint"))


def _rows_with_root(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``id, n, c, root`` and the further columns for the rows of ``id, text`` and further columns.

    ``root`` names the component and is null for an empty set.
    """
    found, counts = _sets(docs, words)
    docs = docs.select("id", "text")
    orders = docs.sparkSession.sparkContext.broadcast(counts)
    groups = staged(_shared(_index(docs, words, percent, orders)))
    total = groups.count()
    shared = groups.groupBy("c").agg(F.first("n").alias("n"), F.collect_list("token").alias("tokens"))
    shared = compact(shared, total)

    def linked(pairs: DataFrame) -> DataFrame:
        counted = compact(_counted(compact(pairs, total), shared, percent), total)
        return _verified(counted, found, docs, words, percent, orders)

    links = linked(_leader_pairs(groups.withColumn("root", F.col("c")), percent, [0], total))
    roots = components(links)
    for attempt in range(MAX_LEADER_ROUNDS + 1):
        rows = _with_root(groups, roots, total)
        minor = _minor_rows(rows, total)
        left = minor.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
        last = left <= CROSS_PER_ROW * total or attempt == MAX_LEADER_ROUNDS
        if last:
            pairs = _cross_pairs(rows, minor, percent)
        else:
            pairs = _leader_pairs(rows, percent, [attempt * LEADERS + i + 1 for i in range(LEADERS)], total)
        more = linked(pairs)
        if not more.isEmpty():
            links = links.unionByName(more)
            roots = components(links)
        if last:
            break

    named = roots.select(F.col("v").alias("c"), "root")
    return staged(found.join(named, "c", "left").withColumn("root", F.when(F.col("n") > 0, F.coalesce("root", "c"))))


def similar(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75
) -> DataFrame:
    """``id, n_shingles, class, component_id`` for every document.

    ``component_id`` is the smallest id that links reach; a pair is linked when
    ``100 * intersection >= percent * union``.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), filled(text_col).alias("text"))
    placed = _rows_with_root(docs, words, percent)
    # Staged, so that the join below shuffles both sides and a large component's rows can be split.
    smallest = staged(placed.filter("n > 0").groupBy("root").agg(F.min("id").alias("component_id")))
    return placed.join(smallest, "root", "left").select(
        "id", F.col("n").alias("n_shingles"), F.col("c").alias("class"), F.coalesce("component_id", "id").alias("component_id")
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75, stored: bool = False
) -> DataFrame:
    """One row of every component, that with the smallest id, with its columns as they came.

    Rows are told apart by a key of their own (``stages.keyed_rows``), not by their ids: different
    texts under one id stay, near copies under one id leave one. Rows without an id or without words
    stay.
    """
    rows = keyed_rows(docs, stored)
    texts = rows.select("rid", F.col(f"row.{id_col}").cast("bigint").alias("id"), filled(F.col(f"row.{text_col}")).alias("text"))
    placed = _rows_with_root(texts, words, percent).filter("n > 0 AND id IS NOT NULL").select("root", "id", "rid")
    kept = staged(
        placed.groupBy("root").agg(F.min(F.struct("id", "rid")).alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    )
    others = staged(
        placed.join(kept.select("root", F.col("first.rid").alias("stays")), "root").filter("rid <> stays").select("rid")
    )
    gone = F.broadcast(others) if fits_broadcast(others, "rid") else others
    return rows.join(gone, "rid", "left_anti").select("row.*")


def op2_jaccard_join(spark, sf_dir) -> DataFrame:
    found = similar(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


OP2_SQL = """
WITH RECURSIVE cut AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT rid, doc_id,
           CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s
    FROM cut
), documents_of AS (
    SELECT rid, doc_id, len(s) AS n, md5(array_to_string(s, chr(10))) AS c FROM sets
), shingles AS (
    SELECT c, n, unnest(s) AS shingle
    FROM (SELECT md5(array_to_string(s, chr(10))) AS c, len(s) AS n, any_value(s) AS s FROM sets WHERE len(s) > 0 GROUP BY ALL)
), links AS (
    SELECT a.c AS a, b.c AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.c <> b.c
    GROUP BY a.c, b.c, a.n, b.n
    HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
    SELECT DISTINCT c, c AS r FROM shingles
    UNION
    SELECT reach.c, b FROM reach JOIN links ON a = r
), named AS (
    SELECT reach.c, min(doc_id) AS component_id FROM reach JOIN documents_of d ON d.c = r WHERE n > 0 GROUP BY reach.c
)
SELECT doc_id, n AS n_shingles, CASE WHEN n > 0 AND doc_id IS NOT NULL THEN component_id ELSE doc_id END AS component_id
FROM documents_of LEFT JOIN named USING (c)
"""
