"""Quality rules by weak supervision.

Every rule looks at the statistics of a text and votes good or bad, or abstains. How far a rule can
be trusted is not told but learned: expectation-maximisation over the votes of all documents
estimates, for each rule, how often it says good of a good text and bad of a bad one, and the share
of good texts. The posterior probability that a text is good replaces passing every rule.

What the fit needs from the corpus is how many documents gave each combination of votes. There are
three answers a rule, so ``3 ** len(RULES)`` rows at most come to the driver and are broadcast back with
their posteriors, whatever the number of documents. A rule may miss most bad texts, since each looks for
one fault, but none is believed to say bad of good texts more often than of bad ones; this keeps
good and bad from changing places.

Hard limits stay beside the votes: a text of under ``least_words`` words, or with more than
``most_repeated`` percent of its words in repeated windows, fails whatever its posterior.

Defined results: a null text is empty, has no words, and fails the limit on words. Rows are looked at
one by one, so repeated rows get equal verdicts. An empty table gives an empty result; so does
``accepted``. Extra columns are ignored, or carried along by ``accepted``. Very long texts are read
whole; a task holds about 4 MB of texts, or one text, at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyroom.llm.text import filled, table
from tallyroom.llm.wordhash import SPACES, column_bytes, slices
from tallyroom.plans.stages import staged

SYMBOLS = b"#*$%&|<>"
STOPS = b".,;:!?*#$%&|<>"
WINDOW = 5
STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_capitals", "n_letters", "n_stopped", "n_distinct",
)
ROUNDS = 500
# Before the first round a text is good with this probability, times DOUBT for every rule against it.
SHARE, DOUBT = 0.95, 0.4
# What a rule without votes is believed to do.
ON_GOOD, ON_BAD = 0.95, 0.5
LEAST = 0.01  # no vote is taken for a proof
# What two engines agree on, whatever order they add up in.
POSTERIOR_DIGITS = 4


def _table(inside: bytes) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[list(inside)] = True
    return found


_SPACE, _SYMBOL, _STOP = _table(SPACES), _table(SYMBOLS), _table(STOPS)
_CAPITAL = _table(bytes(range(ord("A"), ord("Z") + 1)))
# A first byte of a character outside of ASCII counts as a letter.
_LETTER = _CAPITAL | _table(bytes(range(ord("a"), ord("z") + 1))) | _table(bytes(range(0xC0, 0x100)))
_FIRST = ~_table(bytes(range(0x80, 0xC0)))


def _sums(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are marked."""
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers from 0 for pairs of numbers, equal where both are equal."""
    return np.unique(left * (np.int64(right.max(initial=0)) + 1) + right, return_inverse=True)[1].astype(np.int64)


def repeated_words(word: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Of each text, the words in windows that stand in it twice or more."""
    starts = np.flatnonzero(text[: len(text) - WINDOW + 1] == text[WINDOW - 1 :]) if len(text) >= WINDOW else []
    if not len(starts):
        return np.zeros(texts, dtype=np.int64)
    window = word[starts]
    for place in range(1, WINDOW):
        window = _joined(window, word[starts + place])
    _, back, seen = np.unique(_joined(text[starts], window), return_inverse=True, return_counts=True)
    twice = starts[seen[back] > 1]
    covered = np.zeros(len(word) + 1, dtype=np.int64)
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + WINDOW, -1)
    return np.bincount(text, weights=np.cumsum(covered[:-1]) > 0, minlength=texts).astype(np.int64)


def text_statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of the texts of an Arrow column without nulls."""
    data, offsets = column_bytes(column)
    rows = len(column)
    raw = data.tobytes()
    numbers: dict[bytes, int] = {}
    words, n_words, n_lines, n_dup, n_distinct = [], [], [], [], []
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        text = raw[start:end]
        own = [numbers.setdefault(w, len(numbers)) for w in text.split()]  # bytes split at ASCII blanks only
        lines = [line for line in text.split(b"\n") if line.strip()]
        words.append(np.array(own, dtype=np.int64))
        n_words.append(len(own))
        n_distinct.append(len(set(own)))
        n_lines.append(len(lines))
        n_dup.append(len(lines) - len(set(lines)))
    n_words = np.array(n_words, dtype=np.int64)
    text_of = np.repeat(np.arange(rows, dtype=np.int64), n_words)
    inside = ~_SPACE[data]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[ends] = inside[ends]
    return {
        "n_words": n_words,
        "word_chars": _sums(inside & _FIRST[data], offsets),
        "n_symbols": _sums(_SYMBOL[data], offsets),
        "n_dup_lines": np.array(n_dup, dtype=np.int64),
        "n_repeat_words": repeated_words(np.concatenate(words) if words else np.empty(0, np.int64), text_of, rows),
        "n_lines": np.array(n_lines, dtype=np.int64),
        "n_capitals": _sums(_CAPITAL[data], offsets),
        "n_letters": _sums(_LETTER[data], offsets),
        "n_stopped": _sums(last & _STOP[data], offsets),
        "n_distinct": np.array(n_distinct, dtype=np.int64),
    }


def _statistics(text: pa.Array) -> pa.Array:
    parts = [text_statistics(p.column(0)) for p in slices(pa.RecordBatch.from_arrays([text], ["text"]), "text")]
    columns = [np.concatenate([p[name] for p in parts]) if parts else np.empty(0, np.int64) for name in STATISTICS]
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], list(STATISTICS))


def statistics(text: Column) -> Column:
    """The statistics of a text that is not null, as one struct."""
    return F.arrow_udf(_statistics, StructType([StructField(name, LongType()) for name in STATISTICS]))(text)


# When a rule votes good and when bad; it abstains where neither holds. Shares of under 20 words say
# nothing bad of a text.
RULES = {
    "length": ("n_words BETWEEN 50 AND 100000", "n_words < 20"),
    "word_length": (
        "word_chars BETWEEN 3 * n_words AND 10 * n_words",
        "n_words >= 20 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)",
    ),
    "symbols": ("100 * n_symbols <= n_words", "n_words >= 20 AND 10 * n_symbols > n_words"),
    "repeated_lines": ("n_lines >= 2 AND n_dup_lines = 0", "n_dup_lines >= 2 AND 10 * n_dup_lines > 3 * n_lines"),
    "repeated_windows": ("100 * n_repeat_words <= 2 * n_words", "100 * n_repeat_words > 15 * n_words"),
    "capitals": ("100 * n_capitals <= 20 * n_letters", "n_words >= 20 AND 100 * n_capitals > 40 * n_letters"),
    "word_ends": ("100 * n_stopped <= 30 * n_words", "n_words >= 20 AND 100 * n_stopped > 40 * n_words"),
    "letters": ("100 * n_letters >= 75 * word_chars", "n_words >= 20 AND 100 * n_letters < 60 * word_chars"),
    "vocabulary": ("n_distinct * n_distinct >= 10 * n_words", "n_distinct * n_distinct < 2 * n_words"),
}


def vote_number(rules: dict[str, tuple[str, str]] = RULES) -> Column:
    """All votes of a row as one number: a digit a rule, 0 abstains, 1 is good, 2 is bad."""
    total = F.lit(0)
    for place, (good, bad) in enumerate(rules.values()):
        vote = F.when(F.col("n_words") == 0, 0).when(F.expr(bad), 2).when(F.expr(good), 1).otherwise(0)
        total = total + vote * 3**place
    return total


@dataclass(frozen=True)
class Trust:
    """What the fit found: the share of good texts, and each rule's accuracy on good and bad ones."""

    share: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability of good for rows of votes (0 abstains, 1 good, 2 bad)."""
        good, bad = votes == 1, votes == 2
        odds = np.log(self.share) - np.log1p(-self.share)
        odds = odds + good @ (np.log(self.on_good) - np.log1p(-self.on_bad))
        odds = odds + bad @ (np.log1p(-self.on_good) - np.log(self.on_bad))
        return 1.0 / (1.0 + np.exp(-odds))


def digits(numbers: np.ndarray, rules: int) -> np.ndarray:
    return numbers[:, None] // 3 ** np.arange(rules)[None, :] % 3


def fitted(votes: np.ndarray, counts: np.ndarray) -> Trust:
    """Expectation-maximisation over combinations of votes and how many rows gave each."""
    good, trust, before = SHARE * DOUBT ** (votes == 2).sum(axis=1) * counts, None, None
    for _ in range(ROUNDS):
        bad = counts - good

        def accuracy(weight: np.ndarray, right: int, unknown: float) -> np.ndarray:
            # One vote more than there are, so that a rule without votes has an accuracy too.
            return (weight @ (votes == right) + unknown) / (weight @ (votes > 0) + 1)

        on_good = np.clip(accuracy(good, 1, ON_GOOD), LEAST, 1 - LEAST)
        on_bad = np.clip(accuracy(bad, 2, ON_BAD), 1 - on_good, 1 - LEAST)
        share = float(np.clip((good.sum() + SHARE) / (counts.sum() + 1), LEAST, 1 - LEAST))
        trust = Trust(share, on_good, on_bad)
        now = np.array([share, *on_good, *on_bad])
        if before is not None and np.abs(now - before).max() < 1e-9:
            break
        before, good = now, trust.posterior(votes) * counts
    return trust


def _seen(voted: DataFrame, rules: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").toArrow()
    numbers = found["votes"].to_numpy().astype(np.int64)
    return numbers, digits(numbers, rules), found["n"].to_numpy().astype(np.float64)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, tuple[str, str]] = RULES) -> tuple[DataFrame, Trust]:
    """``id``, the statistics, ``votes`` and ``posterior`` of every document, and what was fitted."""
    voted = staged(
        docs.select(F.col(id_col).alias("id"), statistics(filled(text_col)).alias("s"))
        .select("id", "s.*")
        .withColumn("votes", vote_number(rules))
    )
    numbers, votes, counts = _seen(voted, len(rules))
    trust = fitted(votes, counts)
    rows = list(zip(numbers.tolist(), trust.posterior(votes).tolist(), strict=True))
    posteriors = docs.sparkSession.createDataFrame(rows, "votes int, posterior double")
    return voted.join(F.broadcast(posteriors), "votes"), trust


def fails(least_words: int = 10, most_repeated: int = 20) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, tuple[str, str]] = RULES, least: float = 0.5) -> DataFrame:
    """The documents that pass the limits and are good with a probability of ``least``, as they came.

    The texts are looked at once for the fit and once more for the verdict; nothing but the text is
    sent to Python, and no row is matched by its id.
    """
    _, trust = judged(docs, id_col, text_col, rules)
    numbers = np.arange(3 ** len(rules))
    good = ",".join("01"[p] for p in (trust.posterior(digits(numbers, len(rules))) >= least).astype(int))
    looked = docs.select(F.struct("*").alias("row"), statistics(filled(text_col)).alias("s")).select("row", "s.*")
    verdict = F.get(F.split(F.lit(good), ","), vote_number(rules)) == "1"
    return looked.filter(~fails() & verdict).select("row.*")


def op12_weak_rules(spark, sf_dir) -> DataFrame:
    found, _ = judged(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        *STATISTICS[:5],
        fails().alias("base_failed"),
        (~fails() & (F.col("posterior") >= 0.5)).alias("kept"),
        F.round("posterior", POSTERIOR_DIGITS).alias("posterior"),
    )


def _clipped(value: str, low: str = f"{LEAST}") -> str:
    return f"least(greatest({value}, {low}), {1 - LEAST})"


def _maximised(good: str) -> str:
    """SQL's M-step: share and accuracies from the good part of each combination's rows, ``good`` of ``n``."""
    parts = [_clipped(f"(sum({good}) + {SHARE}) / (sum(n) + 1)") + " AS share"]
    for j in range(len(RULES)):
        voted = f"FILTER (v{j} > 0)"
        on_good = _clipped(f"(coalesce(sum({good}) FILTER (v{j} = 1), 0) + {ON_GOOD}) / (coalesce(sum({good}) {voted}, 0) + 1)")
        of_bad = f"(coalesce(sum(n - {good}) FILTER (v{j} = 2), 0) + {ON_BAD}) / (coalesce(sum(n - {good}) {voted}, 0) + 1)"
        parts += [f"{on_good} AS a{j}", _clipped(of_bad, f"1 - {on_good}") + f" AS b{j}"]
    return ", ".join(parts)


_SQL_ODDS = "ln(share) - ln(1 - share) + " + " + ".join(
    f"CASE v{j} WHEN 1 THEN ln(a{j}) - ln(1 - b{j}) WHEN 2 THEN ln(1 - a{j}) - ln(b{j}) ELSE 0 END" for j in range(len(RULES))
)
_VOTES = ", ".join(
    f"CASE WHEN n_words = 0 THEN 0 WHEN {bad} THEN 2 WHEN {good} THEN 1 ELSE 0 END AS v{j}"
    for j, (good, bad) in enumerate(RULES.values())
)
_V = ", ".join(f"v{j}" for j in range(len(RULES)))

OP12_SQL = f"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
    SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM texts
), windows AS (
    SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM cut)
), twice AS (
    SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), covered AS (
    SELECT rid, count(DISTINCT i + j) AS n_repeat_words FROM twice CROSS JOIN range(5) r(j) GROUP BY rid
), stats AS (
    SELECT cut.rid, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           len(lines) AS n_lines,
           length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
           length(regexp_replace(text, '[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]', '', 'g')) AS n_letters,
           len(list_filter(w, lambda x: regexp_matches(x, '[.,;:!?#*$%&|<>]$'))) AS n_stopped,
           len(list_distinct(w)) AS n_distinct
    FROM cut LEFT JOIN covered ON covered.rid = cut.rid
), voted AS (
    SELECT *, {_VOTES} FROM stats
), seen AS (
    SELECT {_V}, CAST(count(*) AS DOUBLE) AS n FROM voted GROUP BY ALL
), started AS (
    SELECT *, n * {SHARE} * pow({DOUBT}, {" + ".join(f"CAST(v{j} = 2 AS INT)" for j in range(len(RULES)))}) AS good FROM seen
), em AS (
    SELECT 1 AS round, {_maximised("good")} FROM started HAVING count(*) > 0
    UNION ALL
    SELECT round + 1, {_maximised("good")}
    FROM (SELECT round, n, {_V}, n / (1 + exp(-({_SQL_ODDS}))) AS good FROM em CROSS JOIN seen WHERE round < {ROUNDS})
    GROUP BY round
), judged AS (
    SELECT voted.*, 1 / (1 + exp(-({_SQL_ODDS}))) AS posterior,
           n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
    FROM voted CROSS JOIN (SELECT * FROM em ORDER BY round DESC LIMIT 1)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND posterior >= 0.5 AS kept, round(posterior, {POSTERIOR_DIGITS}) AS posterior
FROM judged
"""
