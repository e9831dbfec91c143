"""Hierarchical multi-length packing of documents into training sequences.

A document's ids end with a separator id. It is routed by length: whole windows of the longest
context become sequences of their own, and what remains goes to the shortest context tier that
holds it. The tiers are packed from the longest down. The gap of a window is filled with the
longest remainder of any shorter tier that fits; when none fits, a longer one is cut to the gap.
Every finished sequence is therefore full. What is left when a task has no more documents is cut
at powers of two, so it needs no padding either. Contexts should be powers of two.

Sequences are then dealt into step groups of about ``step_tokens`` tokens: from the longest context
down, each goes to the group with the fewest tokens, which balances tokens and mixes tiers.

Every task packs the documents it reads, in windows of bounded size: nothing is shuffled, a rerun
of a task gives the same sequences, and no source or group of copies meets in one place.

Defined results: a null text is empty; a document without ids is its separator alone. Repeated rows
are documents of their own. A null id stays null. An empty table gives no sequences. A document
much longer than a window passes through in parts. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.text import filled, table

# The rank file of the vocabulary that the tokenizer file of the same name holds.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SPECIAL = (("<|endoftext|>", 50256),)
CONTEXTS = (1024, 512, 256, 128)
WINDOW_TOKENS = 1 << 20


@cache
def encoder(path: str = RANKS, special: tuple[tuple[str, int], ...] = SPECIAL) -> tiktoken.Encoding:
    """Gives the ids of the tokenizer file, special tokens found in a text included; faster."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(special)
    )


class Packer:
    """Packs pieces ``(key, start, ids, doc_tokens)`` window by window."""

    def __init__(self, contexts: tuple[int, ...], step_tokens: int):
        self.contexts = sorted(contexts, reverse=True)
        self.step_tokens = step_tokens
        self.sequences: list[tuple[int, list]] = []
        self.rest: dict[int, list] = {}  # pieces by length
        self.lengths = 0  # a bit for each length that has pieces
        self.tokens = 0

    def add(self, key, ids: np.ndarray) -> Iterator[list]:
        longest = self.contexts[0]
        total = len(ids)
        whole = total - total % longest
        for start in range(0, whole, longest):
            self.sequences.append((longest, [(key, start, ids[start : start + longest], total)]))
            self.tokens += longest
            if self.tokens >= WINDOW_TOKENS:
                yield from self.flush()
        if whole < total:
            self._keep((key, whole, ids[whole:], total))
            self.tokens += total - whole
        if self.tokens >= WINDOW_TOKENS:
            yield from self.flush()

    def _keep(self, piece) -> None:
        n = len(piece[2])
        self.rest.setdefault(n, []).append(piece)
        self.lengths |= 1 << n

    def _take(self, n: int):
        pieces = self.rest[n]
        piece = pieces.pop()
        if not pieces:
            self.lengths &= ~(1 << n)
        return piece

    def _longest_upto(self, n: int) -> int:
        return (self.lengths & ((1 << (n + 1)) - 1)).bit_length() - 1

    def _fill(self, context: int) -> list | None:
        """One full sequence that begins with the longest remainder; None when ids run out."""
        pieces, gap = [], context
        while gap:
            n = self._longest_upto(gap)
            if n > 0:
                piece = self._take(n)
            elif self.lengths:
                key, start, ids, total = self._take((self.lengths & -self.lengths).bit_length() - 1)
                self._keep((key, start + gap, ids[gap:], total))
                piece = (key, start, ids[:gap], total)
            else:
                for piece in pieces:
                    self._keep(piece)
                return None
            pieces.append(piece)
            gap -= len(piece[2])
        return pieces

    def flush(self, last: bool = False) -> Iterator[list]:
        """Packs what is held; what fills no window waits for the next one or, last, is cut."""
        for i, context in enumerate(self.contexts):
            shorter = self.contexts[i + 1] if i + 1 < len(self.contexts) else 0
            # The tier's own remainders each open a window.
            while self.lengths.bit_length() - 1 > shorter:
                pieces = self._fill(context)
                if pieces is None:
                    break
                self.sequences.append((context, pieces))
        if last:
            size = self.contexts[0]
            left = sum(n * len(pieces) for n, pieces in self.rest.items())
            while size:
                while left >= size:
                    self.sequences.append((size, self._fill(size)))
                    left -= size
                size //= 2
        yield from self._grouped()
        self.tokens = sum(n * len(pieces) for n, pieces in self.rest.items())

    def _grouped(self) -> Iterator[list]:
        """The window's sequences, dealt into step groups."""
        if not self.sequences:
            return
        groups = max(1, round(sum(n for n, _ in self.sequences) / self.step_tokens))
        load = [(0, g) for g in range(groups)]
        window = []
        for context, pieces in sorted(self.sequences, key=lambda s: -s[0]):
            tokens, group = heapq.heappop(load)
            heapq.heappush(load, (tokens + context, group))
            window.append((context, group, pieces))
        self.sequences = []
        yield [groups, window]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    contexts: tuple[int, ...] = CONTEXTS,
    separator: int = 0,
    step_tokens: int = 16 * 1024,
    ranks: str = RANKS,
    special: tuple[tuple[str, int], ...] = SPECIAL,
) -> DataFrame:
    """One row per piece: ``id, start, length, ids, doc_tokens, sequence_id, offset, context, step_group``.

    ``ids`` holds little-endian unsigned 32-bit numbers; a sequence is its pieces by ``offset``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, context bigint, step_group bigint"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, special).encode
        base = TaskContext.get().partitionId() << 40
        packer = Packer(contexts, step_tokens)
        sequence = step = 0
        names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "context", "step_group"]
        types = [None, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 5]

        def written(windows) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, step
            for groups, window in windows:
                rows = []
                for context, group, pieces in window:
                    offset = 0
                    for key, start, ids, total in pieces:
                        rows.append((key, start, len(ids), ids.tobytes(), total, base + sequence, offset, context, base + step + group))
                        offset += len(ids)
                    sequence += 1
                step += groups
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            types[0] = batch.schema.field("id").type
            for key, text in zip(batch.column("id"), batch.column("text"), strict=True):
                ids = encode(text.as_py(), allowed_special="all")
                ids.append(separator)
                yield from written(packer.add(key.as_py(), np.array(ids, dtype="<u4")))
        if types[0] is not None:
            yield from written(packer.flush(last=True))

    read = docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text"))
    return read.mapInArrow(run, schema)


def op5_packing(spark, sf_dir) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "context",
        "step_group",
    )
