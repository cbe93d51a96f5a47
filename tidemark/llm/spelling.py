"""Spelling variants: one-edit neighbourhoods over a reduced alphabet, checked on the words themselves."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import pinned

# A run of letters; only A-Z are lower-cased.
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
TYPO_EVERY = 31
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
# Words that a worker counts before it hands them on, and runs of a long text counted at a time.
COUNTED, RUNS = 200_000, 1 << 16
# Symbols tried, and how many words may share a reduced word with the average word.
SYMBOLS, SHARED = (4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64), 16
# Neighbours that are handed on at a time.
BATCH = 1 << 18


def _runs(text: str) -> Iterator[Counter]:
    """Lower-cased runs of a text with how often each occurs, some thousands at a time."""
    found = _RUN.finditer(text.translate(_LOWER))
    while some := Counter(match[0] for match in islice(found, RUNS)):
        yield some


def planted(run: str, seed: int) -> str:
    """The run, or the run without one letter if its checksum says so; ``seed`` is that of '<id>:'."""
    h = zlib.crc32(run.encode(), seed)
    if h % TYPO_EVERY:
        return run
    gone = h % len(run)
    return run[:gone] + run[gone + 1 :]


def word_counts(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """(word, n): every run of letters of every whole text, some with a letter deleted.

    Runs are counted in the tasks that read them and words are added up after a partial sum, so
    a very common word has a few rows a task. A null id counts as an empty one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for batch in batches:
            for name, body in zip(batch.column("row_id").to_pylist(), batch.column("text")):
                seed = zlib.crc32(f"{'' if name is None else name}:".encode())
                for runs in _runs(body.as_py() or ""):
                    for run, times in runs.items():
                        words[planted(run, seed)] += times
                    if len(words) > COUNTED:
                        yield _counted(words)
                        words.clear()
        yield _counted(words)

    rows = docs.select(F.col(row_id).cast("string").alias("row_id"), F.col(text).alias("text"))
    counted = rows.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(words: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"]
    )


def reduced(word: Column, symbols: int) -> Column:
    """The word with each letter replaced by one of ``symbols`` symbols, by the crc32 of the letter."""
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)] + [chr(c) for c in range(0xC0, 0x100)]
    into = "".join(chr(ord("0") + zlib.crc32(letter.encode()) % symbols) for letter in letters)
    return F.translate(word, "".join(letters), into)


# Odd factors of the rolling hash of a reduced word, modulo 2**64.
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Hash values with their high bits spread over the low ones, one to one."""
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return (values ^ (values >> np.uint64(29))).view(np.int64)


class RollingHash:
    """Hashes of a reduced word and of its neighbours: a sum of symbols times powers of a factor,
    so a changed word's hash follows from those of the parts before and after the change."""

    def __init__(self, symbols: int):
        self.symbols = np.arange(1, symbols + 1, dtype=np.uint64)
        self.powers = np.ones(1, dtype=np.uint64)

    def _codes(self, word: str) -> np.ndarray:
        return np.frombuffer(word.encode("latin-1"), dtype=np.uint8).astype(np.uint64) - np.uint64(ord("0") - 1)

    def _powers(self, n: int) -> np.ndarray:
        if len(self.powers) < n:
            grown = np.full(2 * n, _FACTOR, dtype=np.uint64)
            grown[0] = 1
            self.powers = np.multiply.accumulate(grown)
        return self.powers[:n]

    def one(self, word: str) -> int:
        codes = self._codes(word)
        return int(_mixed(np.array([(codes * self._powers(len(codes))).sum(dtype=np.uint64)]))[0])

    def neighbours(self, word: str) -> np.ndarray:
        """Different hashes of the word and of every word at one edit from it."""
        codes = self._codes(word)
        n = len(codes)
        power = self._powers(n + 1)
        terms = codes * power[:n]
        before = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
        whole = before[-1]
        # What follows the place moves one power down, stays, or moves one power up.
        after = whole - before
        # Symbols after a deleted one: the sum of codes[j] * power[j - 1].
        down = np.concatenate([codes[1:] * power[: n - 1], np.zeros(1, dtype=np.uint64)])
        down = np.cumsum(down[::-1], dtype=np.uint64)[::-1]
        deleted = before[:n] + down
        replaced = (before[:n] + after[1:])[:, None] + self.symbols[None, :] * power[:n, None]
        inserted = (before + after * _FACTOR)[:, None] + self.symbols[None, :] * power[: n + 1, None]
        every = np.concatenate([deleted, replaced.ravel(), inserted.ravel()])
        return np.unique(_mixed(every))


def _neighbourhoods(words: DataFrame, symbols: int) -> DataFrame:
    """(rid, key) of every neighbour of the reduced words (rid, reduced), themselves included."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash(symbols)
        for batch in batches:
            rids, keys, size = [], [], 0
            for rid, word in zip(batch.column("rid").to_pylist(), batch.column("reduced").to_pylist()):
                found = rolling.neighbours(word)
                rids.append(np.full(len(found), rid, dtype=np.int64))
                keys.append(found)
                size += len(found)
                if size > BATCH:
                    yield _pairs(rids, keys)
                    rids, keys, size = [], [], 0
            if keys:
                yield _pairs(rids, keys)

    return words.mapInArrow(spread, "rid long, key long")


def _pairs(rids: list[np.ndarray], keys: list[np.ndarray]) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(rids)), pa.array(np.concatenate(keys))]
    return pa.RecordBatch.from_arrays(columns, names=["rid", "key"])


def _hashed(words: DataFrame, symbols: int) -> DataFrame:
    """Reduced words (rid, reduced) with ``key``, the hash of each."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash(symbols)
        for batch in batches:
            keys = [rolling.one(word) for word in batch.column("reduced").to_pylist()]
            yield batch.append_column("key", pa.array(keys, pa.int64()))

    return words.mapInArrow(add, "rid long, reduced string, key long")


def symbols_for(words: DataFrame, tried: tuple[int, ...] = SYMBOLS, shared: float = SHARED) -> int:
    """The fewest symbols under which the average word shares its reduced word with few others.

    Any number gives the same pairs. Fewer symbols mean fewer neighbours and more words to check
    at each, so the alphabet grows with the vocabulary and the checks stay in proportion to it.
    """
    for symbols in tried:
        sizes = words.groupBy(reduced(F.col("word"), symbols).alias("r")).agg(F.count(F.lit(1)).cast("double").alias("n"))
        mean = sizes.agg(F.sum(F.col("n") * F.col("n")) / F.sum("n")).first()[0]
        if mean is None or mean <= shared:
            break
    return symbols


def near_pairs(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """(word, near, near_n) for every two of the words (word, n) that one edit apart, both ways.

    Letters become symbols, equal reduced words become one, and each is posted under its whole
    one-edit neighbourhood. Words one edit apart have reduced words at most one edit apart, so a
    neighbour meets the reduced word of every near word. Only neighbours that are reduced words
    go on to the words themselves, where the distance is checked. ``words`` is read several
    times; pass a stored table of distinct words in lower case.
    """
    symbols = symbols or symbols_for(words)
    spelled = words.withColumn("reduced", reduced(F.col("word"), symbols))
    distinct = spelled.select("reduced").distinct().select(F.monotonically_increasing_id().alias("rid"), "reduced")
    # Stored before it is read, so that numbers stay what they are.
    keyed = pinned(_hashed(distinct, symbols), "reduced")
    members = pinned(spelled.join(keyed, "reduced").select("word", "n", "rid", "key"), "members")
    posted = _neighbourhoods(keyed.select("rid", "reduced"), symbols)
    met = posted.join(keyed.select("key").distinct(), "key")
    ours = met.join(members.select("rid", "word"), "rid").select("key", "word")
    theirs = members.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    one_edit = F.levenshtein("word", "near", 1) == 1
    return ours.join(theirs, "key").where(one_edit).select("word", "near", "near_n")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): the last form that each word of (word, form) leads to.

    Every round replaces a form by its form's form, so a chain of n takes log2(n) rounds; a chain
    is short, as counts grow by ``RATIO`` at every step. A form has no more words than one edit
    allows, so no key is hot. ``forms`` must not lead in a circle.
    """
    roots = pinned(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = roots.join(onward, "root", "left")
        if joined.where(F.col("further").isNotNull()).isEmpty():
            return roots
        roots = pinned(joined.select("word", F.coalesce("further", "root").alias("root")), "roots")


def variants(
    docs: DataFrame,
    text: str = "text",
    row_id: str = "doc_id",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    symbols: int | None = None,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts that is long and common enough.

    A word's form is its near word (one letter inserted, deleted or replaced) of largest n, ties by
    code points, if that occurs ``ratio`` times as often; ``root`` follows forms to the last, or is
    the word itself.

    Null and empty texts have no words; a row that repeats counts again; rows without an id count
    with an empty one. Very long texts and very long runs of letters are taken whole: a run of m
    letters has neighbours in proportion to m. Other columns are ignored. An empty table, and one
    without such words, gives an empty result.
    """
    counted = word_counts(docs, text, row_id)
    words = pinned(counted.where(F.char_length("word") >= min_length).where(F.col("n") >= min_count), "words")
    largest = F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    nearest = near_pairs(words, symbols).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), largest)
    judged = words.join(nearest, "word", "left")
    form_n = -F.col("best.minus")
    form = F.when(form_n >= F.lit(ratio) * F.col("n"), F.struct(F.col("best.near").alias("form"), form_n.alias("n")))
    formed = pinned(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("best")), "forms")
    roots = follow(formed.where(F.col("best").isNotNull()).select("word", "best.form"))
    return formed.join(roots, "word", "left").select(
        "word",
        F.col("best.form").alias("form"),
        F.coalesce("root", "word").alias("root"),
        "n",
        "n_near",
        F.col("best.n").alias("form_n"),
    )
