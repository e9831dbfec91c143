"""Personal data: patterns, and a character-level BiLSTM-CRF that adds what they miss.

*Base.* Four patterns, matched from the left without overlaps per kind; a match that fails its check
(number of digits, Luhn sum, parts up to 255) is dropped and its text is used up.

*Model.* It is trained on windows of the corpus that the base spans label, some of them rewritten
(no country prefix, blanks around the at sign, other separators), so that it learns the shape and
surroundings of an address or number rather than the pattern. At most ``MAX_WINDOWS`` distinct windows
are drawn, those with the smallest hash; a tenth of them is kept for each kind of span, and for windows
without any, as far as the corpus holds so many. A task hands on as many of each at most, and so do
all together to the driver.

*Decoding.* Windows of ``WINDOW`` characters start every ``STRIDE`` characters, so each character lies
in two. Only windows with a digit or an at sign are scored: no span of the four kinds is without.
Where windows overlap their scores are averaged, weighted towards a window's middle, and every
stretch of adjoining windows is decoded as one sequence by the CRF. A decoded span is added, as kind
``lstm_email`` and so on, when it touches no base span and holds what its kind needs.

Every document is handled inside its task, nothing is shuffled but the training windows.

Defined results: a null or empty text has no spans; a corpus without any base span trains no model
and adds nothing; repeated rows keep their own results; an empty table gives an empty result. Extra
columns are ignored. A very long text is scored in batches of windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.lstm_crf import LstmCrf
from tallyroom.llm.text import filled, table
from tallyroom.llm.wordhash import slices
from tallyroom.plans.stages import staged

KINDS = ("email", "ip", "card", "phone")
TRIGGER = re.compile("[0-9@]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9.]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")

WINDOW, STRIDE = 64, 32
MAX_WINDOWS = 1500
TRAINING_STEPS = 300
BATCH = 512
# Symbols: classes of characters, and the punctuation that matters on its own.
OWN = "@.+-()_%:/,"
SYMBOLS = 8 + len(OWN)  # padding, blank, line end, digit, lower, upper, beyond ASCII, other
# Tags: nothing, then beginning and inside of every kind.
TAGS = 1 + 2 * len(KINDS)

Span = tuple[int, int, str, int]  # start, rank of the kind, kind, end


def luhn(digits: str) -> bool:
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign with a domain to the left as far as the characters allow: linear time."""
    last = 0
    for domain in _DOMAIN.finditer(text):
        start = domain.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < domain.start():
            last = domain.end()
            yield start, last


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Four parts at a time of every row of dotted numbers: linear time."""
    for run in _DOTTED.finditer(text):
        at, parts = run.start(), []
        for part in [*run[0].split("."), ""]:
            if part:
                parts.append((at, at + len(part)))
                if len(parts) == 4:
                    numbers = [text[s:e].lstrip("0") for s, e in parts]
                    if all(len(n) <= 3 and int(n or 0) <= 255 for n in numbers):
                        yield parts[0][0], parts[3][1]
                    parts = []
            else:
                parts = []
            at += len(part) + 1


def _digits(text: str) -> str:
    return _NOT_DIGIT.sub("", text)


def base_spans(text: str) -> list[Span]:
    """Sorted by start, then by the order of the kinds."""
    if not TRIGGER.search(text):
        return []
    found = [(s, 0, "email", e) for s, e in _emails(text)] if "@" in text else []
    found += [(s, 1, "ip", e) for s, e in _ips(text)]
    for match in _CARD.finditer(text):
        digits = _digits(match[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((match.start(), 2, "card", match.end()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_digits(match[0])) <= 15:
                found.append((match.start(), 3, "phone", match.end()))
    return sorted(found)


def holds(kind: str, text: str) -> bool:
    """What a decoded span needs to be one of its kind."""
    if kind == "email":
        return "@" in text and "." in text.rpartition("@")[2]
    digits = _digits(text)
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def symbols_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return _CLASS[np.minimum(points, 128)]


def _classes() -> np.ndarray:
    out = np.full(129, 7, dtype=np.int64)
    out[[0x20, 0x09]] = 1
    out[[0x0A, 0x0D]] = 2
    out[ord("0") : ord("9") + 1] = 3
    out[ord("a") : ord("z") + 1] = 4
    out[ord("A") : ord("Z") + 1] = 5
    out[128] = 6
    for i, char in enumerate(OWN):
        out[ord(char)] = 8 + i
    return out


_CLASS = _classes()


def window_starts(symbols: np.ndarray) -> np.ndarray:
    """Starts, multiples of the stride, of the windows that hold a digit or an at sign."""
    hits = np.flatnonzero((symbols == 3) | (symbols == _CLASS[ord("@")]))
    if not len(hits):
        return hits
    last = np.unique(hits // STRIDE)
    return np.unique(np.concatenate([last, last - 1]).clip(0)) * STRIDE


def tags_of(length: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(length, dtype=np.int64)
    for start, rank, _, end in spans:
        if not tags[start:end].any():
            tags[start:end] = 2 + 2 * rank
            tags[start] = 1 + 2 * rank
    return tags


def rewritten(text: str, spans: list[Span], rng: np.random.Generator) -> tuple[str, list[Span]]:
    """The text with some spans in another form, and where they stand then."""
    out, moved, at = [], [], 0
    size = 0
    for start, rank, kind, end in spans:
        if start < at:
            continue
        value = text[start:end]
        if kind == "phone":
            value = re.sub(r"^\+[0-9]{1,3}[\x20.-]?", "", value)
        elif kind == "email":
            value = value.replace("@", " @ ")
        elif kind == "card":
            value = re.sub("([0-9]{4})(?=[0-9])", rf"\1{rng.choice(['.', ' ', '-'])}", _digits(value))
        out += [text[at:start], value]
        size += start - at
        moved.append((size, rank, kind, size + len(value)))
        size += len(value)
        at = end
    return "".join([*out, text[at:]]), moved


def strata_of(tags: np.ndarray) -> list[int]:
    """Ranks of the kinds in a window, or one more where it holds none."""
    return np.unique((tags[tags > 0] - 1) // 2).tolist() or [len(KINDS)]


def drawn(strata: list[list[tuple[str, bytes, bytes]]], most: int) -> list[tuple[str, bytes, bytes]]:
    """At most ``most`` rows in order: some of every stratum first, then the smallest of all."""
    each = max(1, most // (2 * len(strata)))
    chosen = sorted({row for rows in strata for row in sorted(rows)[:each]})[:most]
    others = sorted({row for rows in strata for row in rows} - set(chosen))
    return sorted(chosen + others[: most - len(chosen)])


def training_windows(docs: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags (WINDOW, n) of at most ``most`` distinct windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[dict[str, tuple[bytes, bytes]]] = [{} for _ in range(len(KINDS) + 1)]
        for batch in batches:
            for column in batch.column("text"):
                text = column.as_py()
                spans = base_spans(text)
                if not spans and not TRIGGER.search(text):
                    continue
                name = hashlib.sha256(text.encode()).digest()
                rng = np.random.default_rng(int.from_bytes(name[:8], "little"))
                if spans and rng.random() < 0.4:
                    text, spans = rewritten(text, spans, rng)
                symbols, tags = symbols_of(text), tags_of(len(text), spans)
                for start in window_starts(symbols).tolist():
                    part = [np.pad(x[start : start + WINDOW], (0, max(0, start + WINDOW - len(x)))) for x in (symbols, tags)]
                    row = tuple(x.astype(np.uint8).tobytes() for x in part)
                    # The window itself makes the key, so copies of it are one.
                    key = hashlib.sha256(b"".join(row)).hexdigest()
                    for stratum in strata_of(part[1]):
                        best[stratum][key] = row
                        if len(best[stratum]) > 4 * most:
                            best[stratum] = dict(sorted(best[stratum].items())[:most])
        rows = [(k, key, *row) for k, found in enumerate(best) for key, row in sorted(found.items())[:most]]
        kinds = (("stratum", pa.int32()), ("key", pa.string()), ("symbols", pa.binary()), ("tags", pa.binary()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], [column for column, _ in kinds]
        )

    found = staged(
        docs.mapInArrow(run, "stratum int, key string, symbols binary, tags binary").dropDuplicates(["stratum", "key"])
    )
    strata = []
    for k in range(len(KINDS) + 1):
        rows = found.filter(F.col("stratum") == k).select("key", "symbols", "tags").orderBy("key").limit(most).toArrow()
        strata.append(list(zip(*[rows[name].to_pylist() for name in rows.column_names], strict=True)))
    rows = drawn(strata, most)
    arrays = [
        np.frombuffer(b"".join(row[i] for row in rows), dtype=np.uint8).reshape(-1, WINDOW).T.astype(np.int64) for i in (1, 2)
    ]
    return arrays[0], arrays[1]


def train(symbols: np.ndarray, tags: np.ndarray, steps: int = TRAINING_STEPS) -> LstmCrf | None:
    """None when the windows hold no span to learn from."""
    if not tags.any():
        return None
    model = LstmCrf(SYMBOLS, TAGS)
    model.fit(symbols, tags, steps, batch=32, rate=0.03)
    return model


def stretches(model: LstmCrf, texts: list[np.ndarray]) -> list[list[tuple[int, np.ndarray]]]:
    """Per text, the start and tags of every stretch of adjoining windows."""
    places = [(i, int(start)) for i, symbols in enumerate(texts) for start in window_starts(symbols)]
    scored = []
    for at in range(0, len(places), BATCH):
        part = np.zeros((WINDOW, len(places[at : at + BATCH])), dtype=np.int64)
        for j, (i, start) in enumerate(places[at : at + BATCH]):
            cut = texts[i][start : start + WINDOW]
            part[: len(cut), j] = cut
        scored.append(model.emissions(part).transpose(1, 0, 2))
    scores = np.concatenate(scored) if scored else np.empty((0, WINDOW, TAGS), np.float32)
    weight = (np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]) + 1).astype(np.float32)[:, None]

    merged: list[tuple[int, int, np.ndarray]] = []
    at = 0
    while at < len(places):
        upto = at + 1
        while upto < len(places) and places[upto][0] == places[at][0] and places[upto][1] == places[upto - 1][1] + STRIDE:
            upto += 1
        text, start = places[at]
        length = min(places[upto - 1][1] + WINDOW, len(texts[text])) - start
        total, weights = np.zeros((length, TAGS), np.float32), np.zeros((length, 1), np.float32)
        for j in range(at, upto):
            low = places[j][1] - start
            n = min(WINDOW, length - low)
            total[low : low + n] += (scores[j] * weight)[:n]
            weights[low : low + n] += weight[:n]
        merged.append((text, start, total / weights))
        at = upto

    out: list[list[tuple[int, np.ndarray]]] = [[] for _ in texts]
    by_length = sorted(range(len(merged)), key=lambda k: len(merged[k][2]))
    at = 0
    while at < len(by_length):
        # Stretches of like length together; the padding scores for no tag at all.
        longest = len(merged[by_length[at]][2]) * 5 // 4 + 8
        group = []
        while at < len(by_length) and len(merged[by_length[at]][2]) <= longest and len(group) < BATCH:
            group.append(by_length[at])
            at += 1
        steps = len(merged[group[-1]][2])
        block = np.zeros((steps, len(group), TAGS), np.float32)
        block[:, :, 0] = 50
        for j, k in enumerate(group):
            block[: len(merged[k][2]), j] = merged[k][2]
        tags = model.decode(block)
        for j, k in enumerate(group):
            text, start, values = merged[k]
            out[text].append((start, tags[: len(values), j]))
    return out


def decoded_spans(text: str, parts: list[tuple[int, np.ndarray]], base: list[Span]) -> list[Span]:
    """Spans of the tags that touch no base span and hold what their kind needs."""
    found = []
    for first, tags in parts:
        at = 0
        while at < len(tags):
            if not tags[at]:
                at += 1
                continue
            rank = (int(tags[at]) - 1) // 2
            upto = at + 1
            while upto < len(tags) and tags[upto] == 2 + 2 * rank:
                upto += 1
            start, end = first + at, first + upto
            kind = KINDS[rank]
            clear = all(end <= s or start >= e for s, _, _, e in base)
            if clear and holds(kind, text[start:end]):
                found.append((start, len(KINDS) + rank, f"lstm_{kind}", end))
            at = upto
    return found


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``id, base, spans`` for every document, both arrays of ``start, rank, kind, end`` in order."""
    read = docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text"))
    model = train(*training_windows(read.select("text"), max_windows))
    model = docs.sparkSession.sparkContext.broadcast(model)
    span = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int64())]))

    def arrow(spans: list[list[Span]]) -> pa.Array:
        names = ("start", "rank", "kind", "end")
        return pa.array([[dict(zip(names, s, strict=True)) for s in row] for row in spans], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                base = [base_spans(text) for text in texts]
                spans = [list(b) for b in base]
                if model.value is not None:
                    asked = [i for i, text in enumerate(texts) if TRIGGER.search(text)]
                    tagged = stretches(model.value, [symbols_of(texts[i]) for i in asked])
                    for i, parts in zip(asked, tagged, strict=True):
                        spans[i] = sorted(spans[i] + decoded_spans(texts[i], parts, base[i]))
                yield pa.RecordBatch.from_arrays([part.column("id"), arrow(base), arrow(spans)], ["id", "base", "spans"])

    return read.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, base {span}, spans {span}")


def op6_personal_data(spark, sf_dir) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    told = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("bigint")
    return found.select(
        F.col("id").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(told(F.col("base")), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"),
    )
