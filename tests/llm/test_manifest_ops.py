"""Resampling over distinct lines, weak supervision, and the Merkle manifest, against plain Python."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tallyroom.llm import merkle, segments, weak_rules
from tallyroom.llm.ranks import placed
from tests.llm.brute import sha
from tests.llm.edges import ROWS, clashing, frame, sorted_rows
from tests.parity import duck, duck_rows, spark_rows

A_TO_Z = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("name", ["op11_segment_resampling", "op13_merkle_manifest"])
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_same_rows_as_sql(spark, name, scale):
    folder = f"/root/testdata/{scale}"
    found = spark_rows(registry.queries()[name](spark, folder))
    assert found == duck_rows(duck(folder), registry.oracle_sql()[name])


# Places


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_places_of_hot_groups_and_ties(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = [("hot", i % 3) for i in range(400)] + [("a", 1), ("b", 2), ("b", 1)]
        found = placed(spark.createDataFrame(rows, "g string, x int").repartition(5), ["g"], ["x"]).collect()
        for g, n in Counter(g for g, _ in rows).items():
            own = sorted((r.pos, r.x) for r in found if r.g == g)
            assert [pos for pos, _ in own] == list(range(n))
            assert [x for _, x in own] == sorted(x for _, x in own)
            assert {r.n for r in found if r.g == g} == {n}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# Resampling


def grams(text: str, most: int):
    words = WORD.findall((text or "").translate(A_TO_Z))
    return words, [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def plain_resampling(docs, target, most=1, buckets=10_000, percent=10, least=20, seed=2024):
    dealt = lambda text: [zlib.crc32(g.encode()) % buckets for g in grams(text, most)[1]]
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(dealt(text))
    for text in target:
        t.update(dealt(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets))))
        for b in range(buckets)
    ]
    out = []
    for doc_id, text in docs:
        words, _ = grams(text, most)
        features = dealt(text)
        h = int(sha(f"{seed}:{'' if doc_id is None else doc_id}")[:8], 16)
        weight = sum(gain[b] for b in features)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(words), len(features), weight, score, None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: len(able) * percent // 100]):
        row[5] = place + 1
    return sorted((tuple(r) for r in out), key=repr)


LINES = ["the hot line of all", "A line", "x", "", " .. ", "one two three four five six", "Ärger 7 mal"]


@pytest.mark.parametrize(("most", "buckets", "percent"), [(1, 10_000, 10), (2, 50, 50), (4, 1000, 100)])
def test_resampling_is_that_of_whole_texts(spark, most, buckets, percent):
    rng = random.Random(most)
    texts = ["\n".join(rng.choices(LINES, k=rng.randint(0, 12))) for _ in range(120)]
    docs = [(i if i % 40 else None, t) for i, t in enumerate(texts)] + [(r[0], r[1]) for r in ROWS]
    docs += [(500 + i, "The hot LINE of all\nthe hot line of all") for i in range(150)]
    target = ["the hot line of six", None, "", "two three\nfour five", "a\nline"]
    found = segments.resample(
        clashing(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)),
        spark.createDataFrame([(t,) for t in target], "text string"),
        most=most, buckets=buckets, percent=percent, least_words=5,
    )
    assert found.columns == ["id", "words", "n_features", "weight", "score", "rank"]
    wanted = plain_resampling(docs, target, most, buckets, percent, least=5)
    # Rows that tie in score and id share the ranks between them.
    assert Counter(r[:5] for r in wanted) == Counter(tuple(r)[:5] for r in found.collect())
    ranked = lambda rows: sorted((r[5], r[4], repr(r[0])) for r in rows if r[5] is not None)
    assert ranked(wanted) == ranked([tuple(r) for r in found.collect()])


def test_ngrams_over_newlines():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choices(["a ", "b ", "c ", "\n", "\n\n", ". "], k=rng.randint(0, 25)))
        for most in (2, 3, 5):
            inside = Counter(g for line in text.split("\n") for g in grams(line, most)[1])
            over = Counter(grams(text, most)[1]) - inside
            assert Counter(g.decode() for g in segments.crossing_grams(text.encode(), most)) == over


def test_words_of_bytes_are_those_of_text():
    text = "".join(map(chr, [*range(0x300), 0x85, 0xA0, 0x2028, 0x1F600])).translate(A_TO_Z) + " ab1 é\u00a0x"
    assert [w.decode() for w in segments.words_of(text.encode())] == WORD.findall(text)


def test_resampling_of_nothing(spark, nothing):
    empty = spark.createDataFrame([], "text string")
    assert segments.resample(nothing, empty).count() == 0
    assert segments.resample(frame(spark), empty).count() == len(ROWS)


def test_a_distinct_line_is_cut_once(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "concat('shared words here\\nown ', id % 5) AS text")
    corpus = segments.Segmented(docs, "doc_id", "text", 1, 100)
    assert sorted((r.words, r.occurrences) for r in corpus.lines.collect()) == [(2, 100)] * 5 + [(3, 500)]


# Weak supervision


def plain_statistics(text):
    data = (text or "").encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    return {
        "n_words": len(words),
        "word_chars": sum(len(w.decode()) for w in words),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_capitals": len(re.findall("[A-Z]", text or "")),
        "n_letters": len(re.findall(r"[A-Za-z]", text or "")) + sum(c >= 0xC0 for c in data),
        "n_stopped": sum(w[-1:] in b".,;:!?#*$%&|<>" for w in words),
        "n_distinct": len(set(words)),
    }


def plain_posteriors(votes):
    """Expectation-maximisation over rows, not over counted combinations."""
    rules = len(votes[0])

    def posterior(row):
        good, bad = share, 1 - share
        for v, a, b in zip(row, on_good, on_bad, strict=True):
            good *= {0: 1, 1: a, 2: 1 - a}[v]
            bad *= {0: 1, 1: 1 - b, 2: b}[v]
        return good / (good + bad)

    p, before = [0.95 * 0.4 ** row.count(2) for row in votes], None
    for _ in range(500):
        on_good, on_bad = [], []
        for j in range(rules):
            given = [(q, row[j]) for q, row in zip(p, votes, strict=True) if row[j]]
            a = (sum(q for q, v in given if v == 1) + 0.95) / (sum(q for q, _ in given) + 1)
            b = (sum(1 - q for q, v in given if v == 2) + 0.5) / (sum(1 - q for q, _ in given) + 1)
            a = min(max(a, 0.01), 0.99)
            on_good.append(a)
            on_bad.append(min(max(b, 1 - a), 0.99))
        share = min(max((sum(p) + 0.95) / (len(p) + 1), 0.01), 0.99)
        now = [share, *on_good, *on_bad]
        if before and max(abs(x - y) for x, y in zip(before, now, strict=True)) < 1e-9:
            break
        before, p = now, [posterior(row) for row in votes]
    return [posterior(row) for row in votes]


def test_statistics_against_plain_python():
    import pyarrow as pa

    rng = random.Random(1)
    parts = ["one", "Two", "é😀", "#*", "END.", "a", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x85", "\xa0", "\x1c"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(300)]
    texts += ["", " ", "a b c d e a b c d e", "a a a a a a a a", "x\nx\n\nx", "word" * 50_000, " ".join(["w"] * 30_000)]
    found = weak_rules._statistics(pa.array(texts)).to_pylist()
    assert found == [plain_statistics(t) for t in texts]


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found, trust = weak_rules.judged(docs)
    return docs.collect(), {r.id: r for r in found.collect()}, trust


def test_query_against_brute_force(spark, judged):
    docs, found, _ = judged
    statistics = {d.doc_id: plain_statistics(d.text) for d in docs}
    assert {i: {n: r[n] for n in weak_rules.STATISTICS} for i, r in found.items()} == statistics
    votes = {i: weak_rules.digits(np.array([r.votes]), len(weak_rules.RULES))[0].tolist() for i, r in found.items()}
    names = list(weak_rules.RULES)
    for i, s in statistics.items():
        short = 100 * s["n_symbols"] <= s["n_words"]
        wanted = 0 if not s["n_words"] else 2 if s["n_words"] >= 20 and 10 * s["n_symbols"] > s["n_words"] else int(short)
        assert votes[i][names.index("symbols")] == wanted
    expected = dict(zip(votes, plain_posteriors(list(votes.values())), strict=True))
    for i, p in expected.items():
        assert found[i].posterior == pytest.approx(p, abs=1e-6)
    rows = {r.doc_id: r for r in registry.queries()["op12_weak_rules"](spark, "/root/testdata/sf0.01").collect()}
    for i, s in statistics.items():
        failed = s["n_words"] < 10 or 100 * s["n_repeat_words"] > 20 * s["n_words"]
        assert rows[i].base_failed == failed and rows[i].kept == (not failed and found[i].posterior >= 0.5)
        assert all(rows[i][name] == s[name] for name in weak_rules.STATISTICS[:5])


def test_verdicts_agree_with_labels_never_seen(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = registry.queries()["op12_weak_rules"](spark, folder).join(labels, "doc_id").filter("NOT base_failed").collect()
    for quality in (0, 1):
        own = [r.kept for r in rows if r.quality == quality]
        assert np.mean([kept == bool(quality) for kept in own]) > 0.97


def test_hidden_accuracies_are_found():
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.7
    right = np.array([0.95, 0.9, 0.85, 0.75, 0.9])
    correct = rng.random((len(truth), 5)) < right
    votes = np.where(correct == truth[:, None], 1, 2) * (rng.random(correct.shape) < 0.8)
    seen, counts = np.unique(votes, axis=0, return_counts=True)
    trust = weak_rules.fitted(seen, counts.astype(float))
    assert trust.share == pytest.approx(0.7, abs=0.02)
    assert trust.on_good == pytest.approx(right, abs=0.03) and trust.on_bad == pytest.approx(right, abs=0.05)


def test_accepted_rows_come_as_they_were(spark, awkward, nothing):
    wide = clashing(awkward)
    found, _ = weak_rules.judged(wide)
    good = found.filter(~weak_rules.fails() & (F.col("posterior") >= 0.5))
    kept = weak_rules.accepted(wide)
    assert kept.columns == wide.columns
    assert sorted_rows(kept.select("doc_id")) == sorted_rows(good.select("id"))
    assert found.count() == len(ROWS)
    assert weak_rules.accepted(nothing).count() == 0 and weak_rules.judged(nothing)[0].count() == 0


# Merkle manifest


def h(*parts):
    return sha("".join(parts))


def plain_field(value):
    if value is None:
        return "-"
    return f"{len(str(value).encode())}:{value}"


def climb(nodes, fanout):
    """The root, and the siblings (left, right) of every node on its way."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + fanout, len(nodes))) for i in range(0, len(nodes), fanout)]
        for run in runs:
            for i in run:
                for leaf in under[i]:
                    paths[leaf].append(("".join(nodes[run[0] : i]), "".join(nodes[i + 1 : run[-1] + 1])))
        under = [[leaf for i in run for leaf in under[i]] for run in runs]
        nodes = [h(*nodes[run[0] : run[-1] + 1]) for run in runs]
    return nodes[0], paths


def plain_manifest(rows, fanout):
    sources = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = h(*map(plain_field, (doc_id, source, lang, n_chars, text)))
        lowered = None if text is None else text.translate(A_TO_Z)
        changed = h(*map(plain_field, (doc_id, source, lang, n_chars, lowered)))
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        sources.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, changed if tampered else leaf, doc_id))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort()
        trees[s] = climb([x[2] for x in sources[s]], fanout)
    root, tops = climb([trees[s][0] for s in order], fanout)
    out = []
    for s, top in zip(order, tops, strict=True):
        for (_, _, leaf, now, doc_id), path in zip(sources[s], trees[s][1], strict=True):
            folded = now
            for left, right in path + top:
                folded = h(left, folded, right)
            proof = h(*[x for level in path + top for x in level])
            out.append((doc_id, leaf, trees[s][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def tampered():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


# Equal rows differ in their proofs only by which has which; one of them stands for all here.
SINGLE = list(dict.fromkeys(ROWS))
MANY = [(i, f"Text {i}", "en", f"s{i % 23}" if i % 3 else "hot", i) for i in range(130)]


@pytest.mark.parametrize(("fanout", "depth"), [(2, 1), (3, 1), (2, 3), (16, 1), (16, 3)])
def test_manifest_against_plain_python(spark, fanout, depth):
    rows = SINGLE + [(1000 + r[0], *r[1:]) for r in MANY]
    docs = clashing(frame(spark, rows).repartition(5))
    found = merkle.verified(merkle.manifest(merkle.document_leaves(docs, tampered()), fanout, depth))
    assert sorted_rows(found) == plain_manifest(rows, fanout)


@pytest.mark.parametrize("n", [1, 2, 5, 16, 17, 65])
def test_sizes_around_full_subtrees(spark, n):
    """Stand-ins of the last subtree: one source of every size, rounds of two and four."""
    rows = [(i, "x", "en", "only", i) for i in range(n)]
    for fanout in (2, 4):
        found = merkle.verified(merkle.manifest(merkle.document_leaves(frame(spark, rows), tampered()), fanout, 1))
        assert sorted_rows(found) == plain_manifest(rows, fanout)


def test_equal_rows_and_nothing(spark, nothing):
    docs = frame(spark, [(1, "a", "en", "s", 1)] * 5)
    found = merkle.verified(merkle.manifest(merkle.document_leaves(docs), 2, 1)).collect()
    assert len(found) == 5 and all(r.verified for r in found) and len({r.root for r in found}) == 1
    assert merkle.verified(merkle.manifest(merkle.document_leaves(nothing))).count() == 0
    with pytest.raises(ValueError, match="fanout"):
        merkle.manifest(merkle.document_leaves(nothing), fanout=1)


def test_a_round_at_most_doubles_the_rows(spark):
    """The stand-ins: what a round shows, against the partitions there are."""
    for blocks in (17, 33, 255, 257):
        n = 16 * blocks
        rows = spark.range(blocks).selectExpr("'s' AS key", "id AS block", f"{n}L AS n", "sha2(string(id), 256) AS node")
        rows = rows.withColumn("levels", F.expr(merkle.NO_LEVELS))
        round_ = 0
        while 16 ** (1 + round_) < n:
            reach = 16**round_
            held = [min(reach, blocks - q * reach) for q in range(-(-blocks // reach))]
            shown = sum(len(range(lane, reach, c)) for c in held for lane in range(c))
            assert shown <= 2 * blocks
            rows = merkle._exchanged(rows, round_, 16, 1)
            round_ += 1
        assert rows.count() == blocks and rows.select("node").distinct().count() == 1
