"""Secret scan with corpus-wide ownership frequency.

Base findings are three patterns, matched from the left without overlaps. Beside them every long
run of mixed letters and digits is a candidate, as is the value of each base finding. Candidates
are hashed, and the hashes are aggregated over the corpus by distinct repository and owner: a value
seen under many owners is an example that people copy, one that stays with a single owner and does
not look like a placeholder is a live credential. Spans of live values are added as kind ``live``;
base spans stay whatever the corpus says.

Positions come from the pieces between the matches: a match starts where the pieces and matches
before it end. They are counted in code points, the end is exclusive.

The texts are read once. What is found is kept as a narrow table; counting combines inside every
task first, by (hash, owner, repository), then by (hash, owner), then by hash, so a value that a
third of all documents share arrives as few rows, and adaptive execution can split its join.

Defined results: a null text is empty, has no spans and the digest of the empty list. A null owner
or repository counts as one of its own. Repeated rows keep their own result rows. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.text import filled, table
from tallyroom.plans.stages import staged

# The base patterns. The length of a whole run decides for access and hex, so it is
# part of the pattern there; a short value of an assignment still uses up its text.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
MIN_ASSIGNED = 8

KINDS = ("assign", "access", "hex", "live")
OPAQUE = "[A-Za-z0-9+/_-]{20,}={0,2}"
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|redacted|your|xxxx|0{8}|1234567|abcdef|(.)\1{5}"
BLOCK = 256


def prefix_sums(values: Column) -> Column:
    """Sum of all elements before each, block by block so that long arrays stay cheap."""

    def inside(block: Column, base: Column) -> Column:
        start = F.struct(base.alias("sum"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            block,
            start,
            lambda a, x: F.struct((a.sum + x).alias("sum"), F.concat(a.out, F.array(a.sum)).alias("out")),
            lambda a: a.out,
        )

    total = lambda block: F.aggregate(block, F.lit(0).cast("bigint"), lambda a, x: a + x)
    steps = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values), F.lit(BLOCK))).otherwise(
        F.array().cast("array<int>")
    )
    blocks = F.transform(steps, lambda at: F.slice(values, at, F.lit(BLOCK)))
    bases = inside(F.transform(blocks, total), F.lit(0).cast("bigint"))
    return F.flatten(F.zip_with(blocks, bases, inside))


def matches(text: Column, pattern: str, kind: str, group: int = 0) -> Column:
    """All matches as ``start, rank, kind, end, value``; ``value`` is the given group."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    lengths = F.zip_with(
        F.split(text, pattern),
        whole,
        lambda gap, hit: F.struct(
            F.char_length(gap).cast("bigint").alias("gap"),
            F.coalesce(F.char_length(hit), F.lit(0)).cast("bigint").alias("hit"),
        ),
    )
    before = prefix_sums(F.transform(lengths, lambda x: x.gap + x.hit))
    starts = F.zip_with(before, lengths, lambda b, x: F.struct((b + x.gap).alias("start"), (b + x.gap + x.hit).alias("end")))
    found = F.zip_with(
        F.slice(starts, F.lit(1), F.size(whole)),
        value,
        lambda at, v: F.struct(
            at.start.alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            F.lit(kind).alias("kind"),
            at.end.alias("end"),
            v.alias("value"),
        ),
    )
    return F.when(F.rlike(text, F.lit(pattern)), found).otherwise(
        F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,value:string>>")
    )


def base_spans(text: Column) -> Column:
    assigned = F.filter(matches(text, ASSIGN, "assign", 2), lambda m: F.char_length(m.value) >= MIN_ASSIGNED)
    return F.concat(assigned, matches(text, ACCESS, "access"), matches(text, HEX, "hex"))


def candidates(text: Column, base: Column) -> Column:
    """Values to hash, ``start, end, value``: those of the base findings and opaque runs."""
    has_digit = F.rlike(text, F.lit("[0-9]"))
    runs = F.when(has_digit, matches(text, OPAQUE, "live")).otherwise(F.slice(base, 1, 0))
    mixed = F.filter(
        runs, lambda m: F.rlike(m.value, F.lit("[0-9]")) & F.rlike(m.value, F.lit("[A-Za-z]"))
    )
    # A base match ends with its value, apart from a closing quote that it never holds.
    spans = F.transform(
        F.concat(base, mixed),
        lambda m: F.struct((m.end - F.char_length(m.value)).alias("start"), m.end.alias("end"), m.value.alias("value")),
    )
    return F.array_distinct(spans)


def span_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda m: F.concat_ws(":", m.kind, m.start.cast("string"), m.end.cast("string"))), ","
    )


def ownership(found: DataFrame) -> DataFrame:
    """``hash, owners, repositories`` from rows of ``hash, owner, repository``."""
    return (
        found.groupBy("hash", "owner", "repository")
        .agg(F.lit(1).alias("one"))
        .groupBy("hash", "owner")
        .agg(F.count("*").alias("repositories"))
        .groupBy("hash")
        .agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "doc_id",
    max_live_owners: int = 1,
    min_example_owners: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """``rows``: one row per document with its spans; ``verdicts``: one row per candidate hash.

    A candidate of at most ``max_live_owners`` owners that is no placeholder is live, one of
    ``min_example_owners`` or more is a widely copied example.
    """
    text = F.col("text")
    read = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(id_col).alias("id"),
        F.col(owner_col).alias("owner"),
        F.col(repository_col).alias("repository"),
        filled(text_col).alias("text"),
    ).withColumn("base", base_spans(text))
    hashed = F.transform(
        candidates(text, F.col("base")),
        lambda c: F.struct(
            c.start.alias("start"),
            c.end.alias("end"),
            F.sha2(c.value, 256).alias("hash"),
            F.rlike(c.value, F.lit(PLACEHOLDER)).alias("placeholder"),
        ),
    )
    spans = F.transform(
        F.array_sort("base"), lambda m: F.struct(m.start.alias("start"), m.rank.alias("rank"), m.kind.alias("kind"), m.end.alias("end"))
    )
    found = staged(read.select("rid", "id", "owner", "repository", spans.alias("base"), hashed.alias("candidates")))

    seen = found.select("rid", "owner", "repository", F.explode("candidates").alias("c"))
    seen = seen.select("rid", "owner", "repository", "c.*")
    state = (
        F.when(F.col("owners") >= min_example_owners, "example")
        .when(F.col("owners") <= max_live_owners, "live")
        .otherwise("unsure")
    )
    verdicts = staged(ownership(seen).withColumn("state", state))
    judged = seen.join(verdicts.select("hash", "state"), "hash")
    live = (F.col("state") == "live") & ~F.col("placeholder")
    per_row = judged.groupBy("rid").agg(
        F.collect_set(
            F.when(
                live,
                F.struct("start", F.lit(KINDS.index("live")).alias("rank"), F.lit("live").alias("kind"), "end"),
            )
        ).alias("live"),
        F.count_if(F.col("state") == "example").alias("n_copied"),
    )
    none = F.slice("base", 1, 0)
    rows = found.join(per_row, "rid", "left").select(
        "id",
        "base",
        F.array_sort(F.concat("base", F.coalesce("live", none))).alias("spans"),
        F.coalesce("n_copied", F.lit(0).cast("bigint")).alias("n_copied"),
    )
    return rows, verdicts


def op3_secret_scan(spark, sf_dir) -> DataFrame:
    rows, _ = scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    count = lambda kind: F.size(F.filter("spans", lambda m: m.kind == kind)).cast("bigint")
    return rows.select(
        F.col("id").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        "n_copied",
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def _either_case(word: str) -> str:
    """SQL's ``(?i)`` also folds letters outside of ASCII."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_WORDS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either_case("api") + "_?" + _either_case("key")
_SQL_PATTERNS = {
    "assign": (f"""({_WORDS})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2),
    "access": (ACCESS, 0),
    "hex": (HEX, 0),
    "live": (OPAQUE, 0),
}
# SQL's patterns have no back reference: six equal characters, one alternative for each.
_SAME = "|".join(
    f"{_either_case(c) if c.isalpha() else '[' + c + ']'}{{6}}" for c in "abcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
)
_DUMMY = "|".join(_either_case(w) for w in ("example", "sample", "dummy", "placeholder", "changeme", "redacted", "your", "xxxx", "abcdef"))
_HITS = " UNION ALL ".join(
    f"SELECT rid, '{kind}' AS kind, {KINDS.index(kind)} AS rank, generate_subscripts(hits, 1) AS i, "
    f"unnest(hits) AS hit, unnest(vals) AS val, unnest(gaps[1:len(hits)]) AS gap "
    f"FROM (SELECT rid, regexp_extract_all(text, '{pattern}') AS hits, regexp_extract_all(text, '{pattern}', {group}) AS vals, "
    f"string_split_regex(text, '{pattern}') AS gaps FROM texts)"
    for kind, (pattern, group) in _SQL_PATTERNS.items()
)

OP3_SQL = f"""
WITH texts AS (
    SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), hits AS ({_HITS}), placed AS (
    SELECT rid, kind, rank, val, length(hit) AS long,
           CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY rid, kind ORDER BY i) AS BIGINT) AS e
    FROM hits
), base AS (
    SELECT rid, kind, rank, val, e - long AS s, e FROM placed
    WHERE kind <> 'live' AND (kind <> 'assign' OR length(val) >= {MIN_ASSIGNED})
), candidates AS (
    SELECT rid, e - length(val) AS s, e, val FROM base
    UNION
    SELECT rid, e - long, e, val FROM placed
    WHERE kind = 'live' AND regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Za-z]')
), owned AS (
    SELECT val, count(DISTINCT coalesce('=' || source, '')) AS owners FROM candidates JOIN texts USING (rid) GROUP BY val
), live AS (
    SELECT DISTINCT rid, 'live' AS kind, {KINDS.index("live")} AS rank, s, e FROM candidates JOIN owned USING (val)
    WHERE owners = 1 AND NOT regexp_matches(val, '{_DUMMY}|0{{8}}|1234567|{_SAME}')
), copied AS (
    SELECT rid, count(*) AS n_copied FROM candidates JOIN owned USING (val) WHERE owners >= 3 GROUP BY rid
), spans AS (
    SELECT rid, kind, rank, s, e, true AS of_base FROM base UNION ALL SELECT rid, kind, rank, s, e, false FROM live
), listed AS (
    SELECT rid, {", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in KINDS)},
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, kind, e) FILTER (of_base) AS base_spans,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, kind, e) AS spans
    FROM spans GROUP BY rid
)
SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in KINDS)}, coalesce(n_copied, 0) AS n_copied,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (rid) LEFT JOIN copied USING (rid)
"""
