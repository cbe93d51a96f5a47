"""Language of a text by prediction by partial matching over bytes."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import worker_cache

# Longest context in bytes; symbols told apart (all byte values); fixed point of a code length.
ORDER, SYMBOLS, SCALE = 3, 256, 1024
# The training sample: so many documents of each language, the least by a hash of the text.
DOCS_PER_LANGUAGE = 400
UNKNOWN = "und"
# Bytes scored at a time, so that a very long text needs bounded memory.
SLICE = 1 << 20

_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Counts:
    """What training leaves: the languages, the symbol of each byte, and per language the counts.

    Every byte has a symbol of its own. ``grams[l]`` holds the seen strings of ORDER + 1 symbols as
    numbers, and how often each came.
    """

    languages: tuple[str, ...]
    symbol_of: np.ndarray
    grams: tuple[tuple[np.ndarray, np.ndarray], ...]


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)


def _grams(symbols: np.ndarray) -> np.ndarray:
    """Numbers of the ORDER + 1 symbols that end at each place; a text starts after blanks."""
    padded = np.concatenate([np.zeros(ORDER, dtype=np.uint32), symbols.astype(np.uint32)])
    value = np.zeros(len(symbols), dtype=np.uint32)
    for k in range(ORDER + 1):
        value = value * np.uint32(SYMBOLS) + padded[k : k + len(symbols)]
    return value


def train(sample: pd.DataFrame) -> Counts | None:
    """Counts of the byte contexts of each language from rows of (lang, text); None without rows."""
    if sample.empty:
        return None
    languages = tuple(sorted(sample["lang"].unique()))
    texts = {lang: [_bytes(t) for t in sample.loc[sample["lang"] == lang, "text"]] for lang in languages}
    # Symbol 0 is the blank, as texts start after blanks; the zero byte takes the place it leaves.
    symbol_of = np.arange(SYMBOLS, dtype=np.uint8)
    symbol_of[[0x00, 0x20]] = 0x20, 0x00
    grams = []
    for lang in languages:
        values, counts = np.unique(
            np.concatenate([_grams(symbol_of[p]) for p in texts[lang]] or [np.zeros(0, np.uint32)]),
            return_counts=True,
        )
        grams.append((values, counts.astype(np.int32)))
    return Counts(languages, symbol_of, tuple(grams))


@dataclass(frozen=True)
class Level:
    """Code lengths of one context length, a row per language, in 1/SCALE bits.

    ``grams`` are the strings of a context and its symbol that any language has seen, in order, and
    ``contexts`` the contexts among them; ``escapes`` is what a symbol pays that never followed one.
    """

    mask: np.uint32
    grams: np.ndarray
    lengths: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray


def code_lengths(counts: Counts) -> list[Level]:
    """Code lengths of all seen symbols after all seen contexts, the shortest contexts first.

    The context tree of a language holds contexts of 0 to ORDER bytes. A symbol that followed the
    longest context costs its share there; any other pays the escape, as likely as the distinct
    symbols seen after the context, and is looked up after the context without its first byte.
    The last resort is one of SYMBOLS equal symbols. The statistics are frozen, so the lengths of
    all strings that any language has seen are worked out once, escapes included, and whole
    numbers make their sums exact in any order. Memory grows with the strings seen.
    """
    levels: list[Level] = []
    shorter, chances = np.zeros(1, dtype=np.uint32), np.full((1, len(counts.languages)), 1.0 / SYMBOLS)
    for order in range(ORDER + 1):
        mask = np.uint32(SYMBOLS ** (order + 1) - 1)
        each = [np.unique(values & mask, return_inverse=True) for values, _ in counts.grams]
        grams = np.unique(np.concatenate([values for values, _ in each]))
        found = np.zeros((len(grams), len(each)))
        for place, ((values, where), (_, times)) in enumerate(zip(each, counts.grams)):
            found[np.searchsorted(grams, values), place] = np.bincount(where, weights=times, minlength=len(values))
        contexts, first, after = np.unique(grams // np.uint32(SYMBOLS), return_index=True, return_inverse=True)
        total = np.add.reduceat(found, first)
        kinds = np.add.reduceat((found > 0).astype(np.float64), first)
        whole = np.maximum(total + kinds, 1)
        escape = np.where(total > 0, kinds / whole, 1.0)
        below = np.searchsorted(shorter, grams & np.uint32(SYMBOLS**order - 1))
        chances = np.where(found > 0, found / whole[after], escape[after] * chances[below])
        levels.append(Level(mask, grams, _fixed(chances), contexts, _fixed(escape)))
        shorter = grams
    return levels


def _fixed(chances: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.rint(-np.log2(chances) * SCALE).astype(np.int32).T)


def _places(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value stands in the sorted known ones, and whether it does."""
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return at, known[at] == values


class Scorer:
    """Languages of texts under frozen code lengths."""

    def __init__(self, counts: Counts):
        self.counts = counts
        self.levels = code_lengths(counts) if any(len(values) for values, _ in counts.grams) else []

    def bits(self, text: str) -> tuple[np.ndarray, int]:
        """Exact code length of a whole text per language in 1/SCALE bits, and its bytes."""
        symbols = self.counts.symbol_of[_bytes(text)]
        total = np.zeros(len(self.counts.languages), dtype=np.int64)
        for at in range(0, len(symbols), SLICE):
            early = max(0, at - ORDER)
            grams = _grams(symbols[early : at + SLICE])[at - early :]
            for level in reversed(self.levels):
                at, seen = _places(grams & level.mask, level.grams)
                total += [lengths.take(at[seen]).sum(dtype=np.int64) for lengths in level.lengths]
                grams = grams[~seen]
                if not len(grams):
                    break
                at, seen = _places((grams & level.mask) // np.uint32(SYMBOLS), level.contexts)
                total += [escapes.take(at[seen]).sum(dtype=np.int64) for escapes in level.escapes]
            total += len(grams) * round(SCALE * np.log2(SYMBOLS))
        return total, len(symbols)

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """Language, confidence, and bits per byte; UNKNOWN, 0 and 0 without a letter."""
        if text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0, 0.0
        total, size = self.bits(text)
        best = int(np.argmin(total))
        # Whole code lengths give near certainty; per-byte ones, sharpened by a root of the
        # length, keep mixed texts apart from clear ones.
        gaps = (total - total[best]) / (SCALE * np.sqrt(size))
        score = float(1.0 / np.exp2(-np.minimum(gaps, 60.0)).sum())
        return self.counts.languages[best], score, float(total[best]) / (SCALE * size)


def _scorer(token: int, counts: Counts) -> Scorer:
    """One table per worker process and model."""
    ready = worker_cache("language")
    if token not in ready:
        ready.clear()
        ready[token] = Scorer(counts)
    return ready[token]


def training_sample(
    docs: DataFrame, text: str, lang: str, row_id: str, limit: int = DOCS_PER_LANGUAGE
) -> DataFrame:
    """(lang, text) of ``limit`` documents of each language, the least by a hash of the id.

    The hash spreads the sample over the table and makes it the same in every run. Hashes are
    uniform, so somewhat more than the wanted share of their range holds enough rows of a large
    language: only those are ranked, and texts move for the sample alone.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    keyed = labelled.select(F.col(lang).alias("lang"), F.xxhash64(F.col(row_id)).alias("h"), F.col(text).alias("text"))
    sizes = keyed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.lit(1.0), F.lit(2.0 * limit + 100) / F.col("n"))
    at = (F.col("h").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    # One row per language, far fewer than the sample that is brought to the driver: broadcast, so
    # that texts are filtered where they are read.
    few = keyed.join(F.broadcast(sizes), "lang").where(at <= share).withColumn("place", rank)
    return few.where(F.col("place") <= limit).select("lang", "text")


def fit(
    docs: DataFrame,
    train_rows: Column,
    text: str = "text",
    lang: str = "lang",
    row_id: str = "doc_id",
    limit: int = DOCS_PER_LANGUAGE,
) -> Counts | None:
    """Train on rows where ``train_rows`` holds, at most ``limit`` whole texts of each language."""
    return train(training_sample(docs.where(train_rows), text, lang, row_id, limit).toPandas())


def predict(text: Column, counts: Counts | None) -> Column:
    """struct(lang_pred, score, bits) of a text column; bits are those per byte.

    Null texts and texts without a letter are ``und`` with score 0. Without a training row there
    is no language to learn and every text is ``und``. Ties go to the language first by code point.
    Nothing but the text is read, so repeated rows and further columns change nothing.
    """
    token = 0 if counts is None else zlib.crc32(b"".join(v.tobytes() + t.tobytes() for v, t in counts.grams))

    @F.pandas_udf("lang_pred string, score double, bits double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = None if counts is None else _scorer(token, counts)
        for part in parts:
            rows = [(UNKNOWN, 0.0, 0.0) if scorer is None else scorer(t) for t in part]
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "bits"])

    return of(text)


def recognised(docs: DataFrame, counts: Counts | None, text: str = "text") -> DataFrame:
    """The rows whose text is in one of the learned languages; columns as in ``docs``.

    Texts without a letter go, and texts that the best language codes no better than equal bytes
    would: they are in none of the languages. Without a learned language all rows go.
    """
    told = predict(F.col(text), counts)
    return docs.where((told["lang_pred"] != UNKNOWN) & (told["bits"] < float(np.log2(SYMBOLS))))
