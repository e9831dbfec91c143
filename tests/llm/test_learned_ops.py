"""Quality, similarity, packing, personal data, fingerprints and the pipeline."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as registry
import corpus_pipeline
from tallyroom.llm import imatch, jaccard_join, packing, personal_data, quality
from tallyroom.llm.components import components
from tallyroom.llm.lstm_crf import LstmCrf
from tallyroom.llm.registry import ORACLE_SQL, QUERIES
from tallyroom.llm.wordhash import WordHasher, joined_bytes
from tests.llm.brute import base_personal, joined, sha
from tests.llm.edges import ROWS, clashing, frame, sorted_rows
from tests.parity import duck, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
A_TO_Z = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == duck_rows(duck(SF), ORACLE_SQL[name])


def test_every_operator_has_a_query():
    names = registry.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in names


def words_of(text):
    return WORD.findall((text or "").translate(A_TO_Z))


def test_word_hashes_follow_the_words():
    texts = ["", "Aa aA", "x" * 3_000_000 + " aa", " \t\n", "é É", "aa"]
    value, text = WordHasher().words(*joined_bytes([t.encode() for t in texts]))
    told = [(i, w) for i, t in enumerate(texts) for w in words_of(t)]
    assert text.tolist() == [i for i, _ in told]
    by_word = {}
    for (_, word), v in zip(told, value.tolist(), strict=True):
        assert by_word.setdefault(word, v) == v
    assert len(set(by_word.values())) == len(by_word)
    # Windows cut between words change nothing.
    many = " ".join(f"w{i}" for i in range(300_000)).encode()
    whole = WordHasher().words(*joined_bytes([many]))[0]
    single = WordHasher().words(*joined_bytes(many.split()))[0]
    assert (whole == single).all() and len(np.unique(whole)) == 300_000


def similar_brute(rows, percent=75, n=5):
    sets = []
    for i, text in rows:
        words = words_of(text)
        sets.append((i, {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(a)] = find(b)
    smallest = {}
    for a, (i, x) in enumerate(sets):
        if x:
            smallest[find(a)] = min(smallest.get(find(a), i), i)
    return sorted((i, len(x), smallest[find(a)] if x else i) for a, (i, x) in enumerate(sets))


@pytest.fixture(scope="module")
def near_copies():
    """A large group of near copies, chains at the threshold, shared passages, one-word changes."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(5000)}"
    base = [word() for _ in range(60)]
    passage = [word() for _ in range(50)]
    rows = []
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            copy[rng.randrange(60)] = word()
        rows.append(" ".join(copy))
    rows += [" ".join([*passage, *(word() for _ in range(rng.choice([2, 10, 60])))]) for _ in range(120)]
    chain = [word() for _ in range(80)]
    for _ in range(40):
        rows.append(" ".join(chain))
        chain = [*chain[rng.choice([5, 9, 10, 11, 12]) :]]
        chain += [word() for _ in range(80 - len(chain))]
    rows += ["a b c d", "A b C d", "a b c", "x", "", "   ", None, "a b c d e", "a b c d e f"]
    rng.shuffle(rows)
    return [(1000 - i, text) for i, text in enumerate(rows)]


@pytest.mark.parametrize("limits", [{}, {"CROSS_PER_ROW": 0, "MAX_LEADER_ROUNDS": 2, "FREQUENT": 2, "SEEN_IN_TASK": 1}])
def test_components_match_all_pairs(spark, monkeypatch, near_copies, limits):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard_join, name, value)
    docs = frame(spark, [(i, text, "en", "s", None) for i, text in near_copies])
    found = jaccard_join.similar(clashing(docs.repartition(5)))
    assert sorted(tuple(r) for r in found.select("id", "n_shingles", "component_id").collect()) == similar_brute(near_copies)
    kept = jaccard_join.one_of_each(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for *_, c in similar_brute(near_copies)})


def test_similarity_of_awkward_rows(awkward, nothing):
    found = jaccard_join.similar(clashing(awkward)).collect()
    assert len(found) == len(ROWS)
    parts = {r.id: (r.n_shingles, r.component_id) for r in found}
    assert parts[1] == (0, 1) and parts[2] == (0, 2) and parts[3] == (0, 3)
    assert parts[4] == (1, 4) and parts[5] == (1, 4) and parts[7][1] == 6 and parts[8][1] == 8 and parts[9][1] == 9
    assert parts[None][1] is None
    assert jaccard_join.similar(nothing).count() == 0
    kept = jaccard_join.one_of_each(clashing(awkward))
    assert kept.columns == clashing(awkward).columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 2, 3, 4, 6, 8, 9, None], key=repr)


@pytest.mark.parametrize("stored", [False, True])
def test_one_of_each_keeps_different_texts_under_one_id(spark, tmp_path, stored):
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, base), (2, base + " near"), (2, other), (3, other + " a"), (3, other + " b"), (7, "x"), (7, "x"), (None, base)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    if stored:
        docs.repartition(3).write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    kept = sorted(tuple(r) for r in jaccard_join.one_of_each(clashing(docs), stored=stored).select("doc_id", "text").collect() if r.doc_id)
    assert kept == sorted([(1, base), (2, other), (7, "x")])
    assert clashing(docs).columns == jaccard_join.one_of_each(clashing(docs), stored=stored).columns


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    names = rng.sample(range(10**9), 400)
    edges = [(names[i], names[i + 1]) for i in range(150)] + [(names[200], names[i]) for i in range(201, 400)]
    found = {r.v: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert set(found[names[i]] for i in range(151)) == {min(names[:151])}
    assert set(found[names[i]] for i in range(200, 400)) == {min(names[200:])}


def test_sequences_hold_every_id_once(spark, awkward, nothing, monkeypatch):
    monkeypatch.setattr(packing, "WINDOW_TOKENS", 20_000)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = [(20, "a<|endoftext|>b <|endoftext|>", "en", "a", None), (21, "x" * 5000, "en", "a", None)]
    docs = frame(spark, [*ROWS, *odd, *[(100 + i, "word " * (i * 13), "en", "a", None) for i in range(200)]])
    pieces = packing.pack(clashing(docs.repartition(4))).collect()
    ids = {}
    for doc_id, text, *_ in [tuple(r) for r in docs.collect()]:
        ids.setdefault(doc_id, []).append(np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4"))
    for doc_id, expected in ids.items():
        mine = sorted((p for p in pieces if p.id == doc_id), key=lambda p: p.start)
        if len(expected) == 1:
            assert b"".join(bytes(p.ids) for p in mine) == expected[0].tobytes()
            assert [p.start for p in mine] == list(np.cumsum([0, *[p.length for p in mine]])[:-1])
        assert sum(p.length for p in mine) == sum(map(len, expected))
        assert all(p.doc_tokens == len(expected[0]) for p in mine)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == list(np.cumsum([0, *[p.length for p in parts]])[:-1])
        size = sum(p.length for p in parts)
        assert size == parts[0].context and size <= 1024 and size & (size - 1) == 0
        assert len({p.step_group for p in parts}) == 1
    assert sum(1 for parts in sequences.values() if parts[0].context < 128) <= 4 * 7
    assert packing.pack(nothing).count() == 0


def test_step_groups_are_balanced(spark):
    rng = random.Random(2)
    docs = frame(spark, [(i, "word " * rng.randrange(1, 1500), "en", "a", None) for i in range(400)]).coalesce(1)
    loads = packing.pack(docs, step_tokens=8192).groupBy("step_group").agg(F.sum("length").alias("n"), F.countDistinct("context").alias("tiers")).collect()
    assert max(r.n for r in loads) - min(r.n for r in loads) <= 1024 and max(r.tiers for r in loads) > 1


PERSONAL = [
    "mail a.b+c%d@x-y.example.com, z", "@b.c@d.e", "a@b.c@d.e", "x@y", "a@b..c q@r.s.", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.002.3.4 1..2.3.4",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111 1111 1111 1111 2", "+1 (988) 555-2485 and +1 (988) 555-2485 4041894974608795",
    "+12345678 +123456789", "é😀 +44 20 7946 0958 é@x.de", "9" * 50_000, "a" * 50_000 + "@", "1." * 20_000, "5" * 9 + ".1.1.1",
    "+" * 3000 + "1" + "-" * 30_000, "1 " * 9 + "x",
]


def test_base_personal_data(spark, awkward):
    docs = frame(spark, [*[(i, text, "en", "a", None) for i, text in enumerate(PERSONAL)], *[r for r in ROWS if r[0]]])
    found = personal_data.find(clashing(docs)).collect()
    told = sorted((r.id, joined((s.start, s.rank, s.kind, s.end) for s in r.base)) for r in found)
    assert told == sorted((r[0], joined(base_personal(r[1] or ""))) for r in docs.collect())
    for row in found:
        assert [s for s in row.spans if not s.kind.startswith("lstm_")] == list(row.base)
        for s in row.spans:
            assert not s.kind.startswith("lstm_") or all(s.end <= b.start or s.start >= b.end for b in row.base)
    assert sorted(repr(r.id) for r in personal_data.find(awkward).collect()) == sorted(repr(r[0]) for r in ROWS)


def test_no_spans_no_model(nothing, awkward):
    assert personal_data.find(nothing).count() == 0
    assert personal_data.train(*personal_data.training_windows(awkward.selectExpr("coalesce(text, '') AS text"), 10)) is None


def test_training_windows_are_distinct(spark):
    """A text with more copies than there are windows to draw does not fill the sample."""
    rows = [f"{'a' * i} 555" for i in range(1, 30)] + ["the one copied text 12345, mail a.b@example.org"] * 500
    docs = spark.createDataFrame([(text,) for text in rows], "text string").repartition(4)
    symbols, tags = personal_data.training_windows(docs, 20)
    windows = np.vstack([symbols, tags]).T
    assert len(windows) == 20 and len(np.unique(windows, axis=0)) == 20 and tags.any()


def test_rare_spans_are_drawn(spark):
    """Every kind that the corpus holds is among the windows, however many hold digits only."""
    rows = [" ".join("x" * (i >> s & 7) + str(s) for s in range(0, 12, 3)) for i in range(4096)]
    rows += ["mail a.b@example.org now", "host 10.20.30.40 is up", "call +49 30 1234567", "card 4111 1111 1111 1111 paid"]
    docs = spark.createDataFrame([(text,) for text in rows], "text string").repartition(4)
    symbols, tags = personal_data.training_windows(docs, 100)
    assert symbols.shape[1] == 100 and set(np.unique((tags[tags > 0] - 1) // 2)) == {0, 1, 2, 3}
    assert personal_data.train(symbols, tags, steps=1) is not None


def test_gradients():
    rng = np.random.default_rng(0)
    model = LstmCrf(6, 5, 3, 4)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    symbols, tags = rng.integers(0, 6, (7, 3)), rng.integers(0, 5, (7, 3))
    grads = model.loss_and_grads(symbols, tags)[1]
    for name, values in model.p.items():
        at = (int(symbols[2, 0]), 1) if name == "embed" else tuple(n // 2 for n in values.shape)
        before, found = values[at], []
        for step in (1e-3, -1e-3):
            values[at] = before + step
            found.append(model.loss_and_grads(symbols, tags)[0])
        values[at] = before
        assert grads[name][at] == pytest.approx((found[0] - found[1]) / 2e-3, rel=2e-2, abs=1e-4)


def test_decoding_is_the_best_path():
    rng = np.random.default_rng(1)
    model = LstmCrf(3, 3)
    model.p["trans"], model.p["start"] = rng.normal(size=(3, 3)), rng.normal(size=3)
    scores = rng.normal(size=(5, 2, 3))
    for b in range(2):
        paths = [tuple(np.unravel_index(k, (3,) * 5)) for k in range(3**5)]
        worth = lambda p: model.p["start"][p[0]] + sum(scores[t, b, p[t]] for t in range(5)) + sum(model.p["trans"][p[t], p[t + 1]] for t in range(4))  # noqa: E731, B023
        assert tuple(model.decode(scores)[:, b]) == max(paths, key=worth)


def test_span_model_on_held_out_windows(spark):
    """Trained on one part of the windows, it finds the spans of the other."""
    texts = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text")
    symbols, tags = personal_data.training_windows(texts, 1200)
    n = symbols.shape[1] * 3 // 4
    model = personal_data.train(symbols[:, :n], tags[:, :n])
    found, truth = model.decode(model.emissions(symbols[:, n:])), tags[:, n:]
    # Whether sixteen digits pass the Luhn sum cannot be seen in kinds of characters.
    card = np.isin(truth, (5, 6)) | np.isin(found, (5, 6))
    assert ((found > 0) & (truth > 0))[~card].sum() > 0.95 * (truth > 0)[~card].sum()
    assert ((found == truth) & (truth > 0))[~card].sum() > 0.95 * (found > 0)[~card].sum()
    assert ((found > 0) & (truth > 0)).sum() > 0.85 * (truth > 0).sum()


def test_fingerprints(spark, awkward, nothing):
    docs = frame(spark, [*ROWS, *[(100 + i, f"term{i % 7} common text {i}", "en", "a", None) for i in range(30)]])
    found = imatch.fingerprints(clashing(docs.repartition(3))).collect()
    order = sorted([(r[0] is not None, r[0] or 0, r[1] or "") for r in docs.collect()], key=lambda r: (not r[0], -r[1], r[2]))
    assert len(found) == len(order)
    prints = {}
    expected = []
    for i, (known, doc_id, text) in enumerate(order):
        after = order[(i + 1) % len(order)][2]
        half = len(text) // 2
        expected.append((doc_id if known else None, len(text), sha(text[: len(text) - half] + after[:half])))
    assert sorted((r.id, r.n_chars, r.edited_sha256) for r in found if r.id) == sorted(e for e in expected if e[0])
    for row in found:
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    for row in found:
        for known, doc_id, text in order:
            if row.id == doc_id and known:
                prints.setdefault(text, set()).add(row.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert imatch.fingerprints(nothing).count() == 0
    alone = imatch.fingerprints(frame(spark, [(1, "one two", "en", "a", None)])).collect()
    assert [(r.id, r.near_next) for r in alone] == [(1, 1.0)]
    assert len(imatch.fingerprints(awkward).collect()) == len(ROWS)


def test_edited_texts_are_nearer_than_the_next(spark):
    found = imatch.fingerprints(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert np.mean([r.near_edited for r in found]) > 10 * np.mean([r.near_next for r in found])
    assert np.mean([r.near_edited > r.near_next for r in found]) > 0.9


# Two near copies share about 0.9 and 0.4 of their terms.
@pytest.mark.parametrize(("differing", "alike"), [(3, 0.5), (30, 0.15)])
def test_near_copies_of_a_third_of_the_rows_stay_alike(spark, differing, alike):
    """What the group shares stands in a third of all texts, above the band."""
    rng = random.Random(1)
    some = lambda n, words: [f"w{rng.randrange(words)}" for _ in range(n)]
    shared = [f"shared{i}" for i in range(120)]
    rows = [(i, " ".join(some(120, 2000))) for i in range(400)]
    for i in range(200):
        words = list(shared)
        for j in rng.sample(range(120), differing):
            words[j] = some(1, 2000)[0]
        rows.append((1000 + i, " ".join(words)))
    found = imatch.fingerprints(frame(spark, [(i, text, "en", "a", None) for i, text in rows]).repartition(4)).collect()
    near = [r for r in found if r.id > 1000]
    assert np.mean([r.near_next for r in near]) > alike
    assert np.mean([r.near_edited for r in near]) > alike
    assert np.mean([r.near_next for r in found if r.id < 399]) < 0.1


def test_texts_of_rare_terms_are_compared_by_them(spark):
    rows = [(i, " ".join(f"rare{i}x{j}" for j in range(40)), "en", "a", None) for i in range(60)]
    found = imatch.fingerprints(frame(spark, rows)).collect()
    assert np.mean([r.near_edited for r in found]) > 0.2
    assert max(r.near_next for r in found) < 0.1 and not any(r.fingerprint.startswith("text:") for r in found)


@pytest.mark.parametrize("few", [True, False])
def test_copies_count_once_for_the_lexicon(spark, monkeypatch, few):
    monkeypatch.setattr(imatch, "fits_broadcast", lambda *_: few)
    texts = [f"own{i} common" for i in range(6)] + ["copied text"] * 5 + [None, "", ""]
    docs = frame(spark, [(i, text, "en", "a", None) for i, text in enumerate(texts)]).repartition(5)
    distinct, rows = imatch.distinct_texts(docs, "text")
    assert sorted(r.text for r in distinct.collect()) == sorted({t or "" for t in texts}) and rows == 8
    known = imatch.lexicon(docs, "text", 0.1, 0.5)
    assert len(known.band) == 0 and known.above_n.tolist() == [6]


@pytest.mark.parametrize("partitions", ["2", "8"])
def test_ids_of_very_many_rows(spark, partitions):
    """A third of the rows has no id and a third one id: both are cut by the texts, every row has its successor."""
    rows = [(None if i % 3 == 0 else 77 if i % 3 == 1 else i, f"text {i // 2} of {i % 5}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    order = [(r.doc_id, r.text) for r in docs.orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text").collect()]
    expected = []
    for i, (doc_id, text) in enumerate(order):
        after, half = order[(i + 1) % len(order)][1], len(text) // 2
        expected.append((doc_id, sha(text[: len(text) - half] + after[:half])))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = imatch.fingerprints(docs)
        assert Counter((r.id, r.edited_sha256) for r in found.collect()) == Counter(expected)
        read = docs.select(F.col("doc_id").alias("id"), "text")
        laid = imatch._laid_out(read, int(partitions)).filter("NOT tail").withColumn("p", F.spark_partition_id())
        largest = max(r["count"] for r in laid.groupBy("p").count().collect())
        assert largest <= 2 * 300 // int(partitions)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# I-Match in plain Python: numbers of 64 bits, one term at a time.

WORD_64 = (1 << 64) - 1


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & WORD_64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & WORD_64
    return x ^ x >> 31


def plain_terms(text):
    values = [mixed((b + 1) * 0xD1B54A32D192ED03 & WORD_64) for b in range(256)]
    out = set()
    for term in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.translate(A_TO_Z)):
        total, power = 0, 1
        for byte in term.encode():
            total += values[byte] * power
            power = power * 0x9E3779B97F4A7C13 & WORD_64
        out.add(mixed(total + len(term.encode()) & WORD_64))
    return out


def plain_lexicon(texts):
    distinct = set(texts)
    seen = Counter(term for text in distinct for term in plain_terms(text))
    low, high = max(2, imatch.MIN_SHARE * len(distinct)), max(2, imatch.MAX_SHARE * len(distinct))
    counted = {t: n for t, n in seen.items() if n >= low}
    return {t for t, n in counted.items() if n <= high}, {t: n for t, n in counted.items() if n > high}


def plain_parts(text, band, above):
    terms = plain_terms(text)
    kept = terms & band
    lack = min(len(terms), max(imatch.ENOUGH, len(terms) // 2)) - len(kept)
    if lack > 0:
        high = sorted((t for t in terms - band if t in above), key=lambda t: (above[t], mixed(t)))
        low = sorted((t for t in terms - band if t not in above), key=mixed)
        turns = [(2 * i, t) for i, t in enumerate(high)] + [(2 * i + 1, t) for i, t in enumerate(low)]
        kept |= {t for _, t in sorted(turns)[:lack]}
    parts = {}
    for family in range(imatch.FAMILIES):
        for term in kept:
            draw = mixed(term + (0x632BE59BD9B4E019 * (family + 1)) & WORD_64)
            weight = mixed(draw ^ 0xA5A5A5A5)
            for rate in range(imatch.RATES):
                if draw >> rate & 1:
                    break
                parts[family, rate] = parts.get((family, rate), 0) + weight & WORD_64
    return {at: mixed(total) % 65535 + 1 for at, total in parts.items()}


def plain_likeness(a, b, same):
    filled = equal = 0
    for rate in reversed(range(imatch.RATES)):
        for family in range(imatch.FAMILIES):
            x, y = a.get((family, rate), 0), b.get((family, rate), 0)
            filled += x != 0 or y != 0
            equal += x == y != 0
        if filled >= imatch.ENOUGH:
            break
    return equal / filled if filled else float(same)


def test_fingerprints_against_plain_python(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()][:70]
    rows += [(9000 + i, t) for i, t in enumerate(["", "  ", "one", "the the THE", rows[0][1], "é ß 日本 " * 9])]
    band, above = plain_lexicon([t for _, t in rows])
    order = sorted(rows, reverse=True)
    parts = [plain_parts(t, band, above) for _, t in order]
    written = lambda p, t: "".join(f"{p.get((f, r), 0):04x}" for f in range(imatch.FAMILIES) for r in range(imatch.RATES)) if p else "text:" + sha(t)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r.id: r for r in imatch.fingerprints(docs).collect()}
    for i, (doc_id, text) in enumerate(order):
        after, half = order[(i + 1) % len(order)][1], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        changed, row = plain_parts(edited, band, above), found[doc_id]
        assert (row.fingerprint, row.edited_fingerprint) == (written(parts[i], text), written(changed, edited))
        assert row.near_edited == pytest.approx(plain_likeness(parts[i], changed, text == edited))
        assert row.near_next == pytest.approx(plain_likeness(parts[i], parts[(i + 1) % len(order)], text == after))


def test_quality_on_held_out_documents(spark):
    found = {r.doc_id: r for r in QUERIES["op1_quality"](spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    held = [(found[r.doc_id], r.quality) for r in labels if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(r.held_out for r, _ in held) and len(held) > 500
    good, bad = ([r.score for r, q in held if q == k] for k in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.99
    assert np.mean([r.predicted == q for r, q in held]) > 0.97
    assert all((r.score >= 0.7) == (r.predicted == 1) and 0 <= r.score <= 1 for r in found.values())


def test_held_out_labels_teach_nothing(spark, tmp_path):
    docs = [(i, "good words here " * (i % 5 + 2) if i % 3 else "#### !!!! " * (i % 5 + 2), "en", "a", None) for i in range(60)]
    frame(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    scores = []
    for flip in (0, 1):
        held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
        labels = [(i, int(bool(i % 3)) ^ (flip if held(i) else 0), 0) for i in range(60)]
        path = str(tmp_path / f"labels{flip}")
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(path + "/labels.parquet")
        model = quality.learned(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), path)
        scores.append(sorted_rows(quality.score(frame(spark, docs), model)))
    assert scores[0] == scores[1]
    assert all((score >= 0.7) == bool(i % 3) for i, score in scores[0])


def test_quality_of_awkward_rows(spark, awkward, nothing):
    labels = lambda *rows: spark.createDataFrame(rows, "id bigint, good boolean")
    for marks in (labels((4, True), (6, False), (None, True), (5, None), (99, True)), labels((4, True)), labels()):
        model = quality.fit(clashing(awkward), marks)
        rows = quality.score(clashing(awkward), model).collect()
        assert sorted(repr(r.id) for r in rows) == sorted(repr(r[0]) for r in ROWS)
        assert all(0 <= r.score <= 1 for r in rows)
        kept = quality.accepted(clashing(awkward), model)
        assert kept.columns == clashing(awkward).columns and kept.count() == sum(r.score >= 0.7 for r in rows)
    assert quality.score(nothing, model).count() == 0 and quality.fit(nothing, labels((1, True))).fitted is False


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF).write.parquet(str(tmp_path / str(k)))
        seen.append(spark.read.parquet(str(tmp_path / str(k))))
    assert all(df.dtypes == docs.dtypes for df in seen[:-1])
    accepted, exact, near, mixed, pieces = ({r.doc_id: r for r in df.collect()} for df in seen[1:])
    assert all(i in accepted for i, q in labels.items() if q == 1)
    texts = [(i, r.text.translate(A_TO_Z)) for i, r in accepted.items()]
    assert set(exact) == {max(i for i, t in texts if t == text) for _, text in texts}
    assert set(near) == {c for *_, c in similar_brute([(i, r.text) for i, r in exact.items()])}
    assert set(mixed) <= set(near) and all(near[i].text == r.text for i, r in mixed.items())
    assert set(pieces) == set(mixed)
    assert seen[-1].count() == registry.queries()["pipeline"](spark, SF).count()


def test_pipeline_of_awkward_documents(spark, tmp_path):
    """Null and repeated ids, null texts and sources, long texts and clashing columns, stage by stage."""
    good = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text) > 800][:12]
    rows = [*ROWS, (5, good[0], "en", "b", 1), (5, good[1], "en", None, None), (None, good[2], "en", "a", 3)]
    rows += [(20 + i, t, "en", "a", None) for i, t in enumerate(good)] + [(40, good[3] + " end", "en", "b", 0), (40, good[4], "de", "a", 1)]
    seen = [clashing(frame(spark, rows).repartition(3))]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF).write.parquet(str(tmp_path / str(k)))
        seen.append(spark.read.parquet(str(tmp_path / str(k))))
    assert all(df.dtypes == seen[0].dtypes for df in seen[:-1])
    plain = [[(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()] for df in seen[:-1]]
    whole = Counter((r[0], r[1]) for r in rows)
    accepted, exact, near, mixed = plain[1:]
    # quality: row by row, by the score of the text
    model = quality.learned(spark, seen[0], SF)
    marks = {r.id: r.score for r in quality.score(spark.createDataFrame(list(enumerate(t for _, t in plain[0])), "doc_id bigint, text string"), model).collect()}
    assert Counter(accepted) == Counter(row for i, row in enumerate(plain[0]) if marks[i] >= 0.7)
    # exact: the largest id of equal texts, one row
    best = {}
    for i, t in accepted:
        norm = (t or "").translate(A_TO_Z)
        best[norm] = max(best.get(norm, (-1,)), (-1 if i is None else i,))
    assert sorted(((-1 if i is None else i), (t or "").translate(A_TO_Z)) for i, t in exact) == sorted((b[0], n) for n, b in best.items())
    # near: components of rows, the smallest id of each
    numbered = [(n, t) for n, (i, t) in enumerate(sorted(exact, key=lambda r: (r[0] is None, r[0] or 0))) if i is not None]
    ordered = sorted(exact, key=lambda r: (r[0] is None, r[0] or 0))
    stay = {c for *_, c in similar_brute(numbered)}
    assert Counter(near) == Counter(ordered[n] for n in stay) + Counter(r for r in exact if r[0] is None)
    # mix: whole texts only; packing: all of their ids
    assert set(mixed) <= set(near) and all(whole[row] for row in mixed)
    pieces = seen[-1].select("doc_id", "start", "length", "doc_tokens").collect()
    assert Counter(p.doc_id for p in pieces if p.start == 0) == Counter(i for i, _ in mixed)
    assert sum(p.length for p in pieces) == sum(p.doc_tokens for p in pieces if p.start == 0)


def test_pipeline_of_no_documents(spark, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0


def plain_features(text: str) -> list[float]:
    """The features of a text one by one, with words and lines themselves in place of their hashes."""
    data = text.encode()
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    words, lines = lower.split(), [x for x in re.split(rb"[\n\r]+", lower) if x]
    kinds = [sum(b in chars for b in data) for chars in quality._KINDS]
    kinds += [sum(b < 128 and not any(b in chars for chars in quality._KINDS) for b in data), sum(b >= 128 for b in data)]
    size, blank = len(data), kinds[3] + kinds[4]
    letters = kinds[0] + kinds[1] + kinds[-1]
    share = lambda part, whole: part / max(whole, 1)
    return [
        np.log1p(size), np.log1p(len(words)), share(size - blank, len(words)), share(len(words), len(lines)),
        share(letters, size - blank), share(len(set(words)), len(words)), share(max(Counter(words).values(), default=0), len(words)),
        share(len(set(zip(words, words[1:], strict=False))), max(len(words) - 1, 0)), share(len(set(lines)), len(lines)),
        share(kinds[1], letters), *[share(k, size) for k in kinds],
    ]


def test_quality_scores_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(9000 + i, t) for i, t in enumerate(["", " \n", "One", "É ß\r\n\x00!!", "a b a b a b\na b"])]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id bigint, text string"))
    model = quality.learned(spark, docs, SF)
    found = {r.id: r.score for r in quality.score(docs, model).collect()}
    for doc_id, text in [tuple(r) for r in docs.collect()]:
        latent = 0.0
        for start, cuts, value in zip(model.starts, model.cuts, plain_features(text or ""), strict=False):
            latent += model.w[start + sum(cut < value for cut in cuts)]
        moved = latent - model.threshold + np.log(0.7 / 0.3)
        score = 1 / (1 + np.exp(-moved))
        assert found[doc_id] == pytest.approx(score, abs=1e-9)
        assert (found[doc_id] >= 0.7) == (latent >= model.threshold)
