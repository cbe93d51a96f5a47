"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import give_back, worker_cache

# The training sample: at most so many documents of either label, the least by a hash of the id.
TOXIC_DOCS, CLEAN_DOCS = 3000, 5000
# Lexicon voters, documents that a lexicon entry must occur in, and lengths of word beginnings.
VOTERS, MIN_DOCS, BEGINNINGS = 300, 4, (3, 4, 5, 6)
# How far an annotator's label is trusted by the label model.
TRUST = 0.99
# Rounds of the label model, and the first ones that estimate the correlations anew.
ROUNDS, REFITS = 30, 4
# Numbers of listed words told apart by the classifier.
STEPS = 4
# Words whose entries a Python worker remembers; beyond that it starts anew.
REMEMBERED = 100_000

_EDGE = re.compile(r"^\W+|\W+$")

# Pattern voters: what a text looks like as a whole. The patterns and their bounds.
PATTERNS = {
    "shouting": lambda text, words: len(text) > 20 and sum(map(str.isupper, text)) * 2 > len(text),
    "exclaims": lambda text, words: text.count("!") * 8 > len(words),
    "masked words": lambda text, words: text.count("*") * 20 > len(words),
    "addressed": lambda text, words: "you" in words or "your" in words,
    "threat": lambda text, words: "kill" in words or "hate" in words,
    "short": lambda text, words: len(words) < 10,
}


def stem_entries(word: str) -> tuple[str, ...]:
    """What a lexicon may list for a word: the word, and its beginnings marked by a hyphen."""
    bare = _EDGE.sub("", word)
    if not bare:
        return ()
    return (bare, *[bare[:n] + "-" for n in BEGINNINGS if len(bare) >= n])


def distinct_words(text: str) -> set[str]:
    return set(text.lower().split())


@dataclass(frozen=True)
class Model:
    """Lexicon entries by place, classifier weights for entries, patterns and hit counts, and a bias."""

    lexicon: dict[str, int]
    weights: np.ndarray
    bias: float
    propensity: np.ndarray
    share: np.ndarray


class Voters:
    """Which lexicon entries and patterns a text triggers."""

    def __init__(self, lexicon: dict[str, int]):
        self.lexicon = lexicon
        self.known: dict[str, tuple[int, ...]] = {}
        self.width = len(lexicon) + len(PATTERNS) + 1

    def fired(self, text: str | None) -> tuple[list[int], int]:
        """Voters that fire, and how many distinct words have a lexicon entry."""
        text = text or ""
        words, hits, listed = distinct_words(text), set(), 0
        known, lexicon = self.known, self.lexicon
        for word in words:
            found = known.get(word)
            if found is None:
                if len(known) > REMEMBERED:
                    known.clear()
                found = known[word] = tuple(lexicon[e] for e in stem_entries(word) if e in lexicon)
            if found:
                hits.update(found)
                listed += 1
        base = len(lexicon)
        fired = sorted(hits)
        fired += [base + i for i, test in enumerate(PATTERNS.values()) if test(text, words)]
        # The last pattern: no lexicon entry fires, a vote for clean.
        return (fired if hits else [*fired, self.width - 1]), listed

    def matrix(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Votes of every text, and its number of listed words."""
        votes, listed = np.zeros((len(texts), self.width)), np.zeros(len(texts), dtype=int)
        for row, text in enumerate(texts):
            fired, listed[row] = self.fired(text)
            votes[row, fired] = 1
        return votes, listed


def mine_lexicon(texts: list[str], toxic: np.ndarray, voters: int = VOTERS, min_docs: int = MIN_DOCS) -> dict[str, int]:
    """Words and word beginnings that tell toxic documents best, by the gain in log likelihood."""
    found = Counter()
    for text, label in zip(texts, toxic):
        if label:
            found.update({e for word in distinct_words(text) for e in stem_entries(word)})
    found = {entry: n for entry, n in found.items() if n >= min_docs}
    others, known = Counter(), {}
    for text, label in zip(texts, toxic):
        if not label:
            entries = set()
            for word in distinct_words(text):
                if word not in known:
                    known[word] = tuple(e for e in stem_entries(word) if e in found)
                entries.update(known[word])
            others.update(entries)
    ones, zeros = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    gains = []
    for entry, n in found.items():
        rate, base = n / ones, others[entry] / zeros
        if rate > 4 * base:
            gains.append((n * np.log((rate + 1e-6) / (base + 0.2 / zeros)), entry))
    gains.sort(key=lambda g: (-g[0], g[1]))
    return {entry: place for place, (_, entry) in enumerate(gains[:voters])}


def label_model(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior that each document is toxic, each voter's firing rate by class, and its share.

    Documents have a hidden class; a voter fires with a rate of its own in either class, and one
    that does not fire abstains: a lexicon of one language says nothing about texts in another.
    The rates and the class sizes are estimated by expectation maximisation over all documents,
    starting from the annotators' labels, which take part as one more voter of known trust.
    Voters are not independent (a word and its beginning fire together), so the correlation of
    every two voters given the class is estimated as well, and a voter counts for its share: one
    over the sum of its correlations, so that voters that always fire together count as one.
    """
    count, width = votes.shape
    posterior = np.where(labels == 1, TRUST, 1 - TRUST)
    share = np.ones(votes.shape[1])
    for turn in range(ROUNDS):
        classes = np.stack([1 - posterior, posterior]) * weights
        sizes = classes.sum(axis=1, keepdims=True)
        rates = (classes @ votes + 0.05) / (sizes + 1.0)
        if turn < REFITS:
            share = _shares(votes, classes / sizes, rates, sizes[:, 0] / sizes.sum())
        prior = np.log(sizes[1, 0] / sizes[0, 0])
        odds = prior + votes @ (np.log(rates[1] / rates[0]) * share)
        odds += np.where(labels == 1, 1, -1) * np.log(TRUST / (1 - TRUST))
        moved = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        done = np.abs(moved - posterior).max() < 1e-4
        posterior = moved
        if done:
            break
    return posterior, rates, share


def _shares(votes: np.ndarray, classes: np.ndarray, rates: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One over the sum of each voter's correlations with all voters given the class."""
    shared = np.zeros((votes.shape[1], votes.shape[1]))
    for weight, rate, size in zip(classes, rates, sizes):
        cover = (votes * weight[:, None]).T @ votes - np.outer(rate, rate)
        spread = np.sqrt(np.maximum(np.diag(cover), 1e-9))
        shared += np.abs(cover / spread / spread[:, None]) * size
    return 1.0 / np.maximum(np.where(shared > 0.1, shared, 0).sum(axis=1), 1.0)


def _features(votes: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """The votes, and whether at least one, two, three and four words are listed."""
    return np.concatenate([votes, listed[:, None] >= np.arange(1, STEPS + 1)], axis=1, dtype=np.float64)


def linear_classifier(features: np.ndarray, target: np.ndarray, weights: np.ndarray, ridge: float = 1.0):
    """Logistic regression on soft labels by Newton steps; (weights, bias)."""
    x = np.concatenate([features, np.ones((len(features), 1))], axis=1)
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weights * (chance - target)) + penalty * beta
        curve = (x * (weights * np.maximum(chance * (1 - chance), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return beta[:-1], float(beta[-1])


def train(sample: pd.DataFrame) -> Model:
    """Fit all parts on rows of (text, toxic, weight); without rows nothing is toxic."""
    if sample.empty or not sample["toxic"].any():
        return Model({}, np.zeros(len(PATTERNS) + 1 + STEPS), -10.0, np.zeros((2, 0)), np.zeros(0))
    texts, toxic = sample["text"].fillna("").tolist(), sample["toxic"].to_numpy(dtype=int)
    weights = sample["weight"].to_numpy(dtype=float)
    lexicon = mine_lexicon(texts, toxic)
    votes, listed = Voters(lexicon).matrix(texts)
    posterior, rates, share = label_model(votes, toxic, weights)
    beta, bias = linear_classifier(_features(votes, listed), posterior, weights)
    return Model(lexicon, beta, bias, rates, share)


def training_sample(
    docs: DataFrame, labels: DataFrame, train_rows: Column, toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS
) -> DataFrame:
    """(text, toxic, weight) of labelled documents; weight undoes the unequal sampling.

    An id gives one row, however many documents repeat it: the one whose text has the least hash.
    """
    usable = labels.where(train_rows & F.col("toxic").isNotNull())
    marked = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = []
    for label, limit in ((1, toxic_docs), (0, clean_docs)):
        rows = marked.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
        weight = max(1.0, sizes.get(label, 0) / limit)
        parts.append(rows.select("doc_id", F.col("toxic").cast("int").alias("toxic"), F.lit(weight).alias("weight")))
    chosen = parts[0].unionByName(parts[1])
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text"))).alias("least")
    return rows.groupBy("doc_id", "toxic", "weight").agg(least).select("least.text", "toxic", "weight")


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column) -> Model:
    """Train on the rows of ``labels`` where ``train_rows`` holds, a bounded sample of either label."""
    return train(training_sample(docs, labels, train_rows).toPandas())


def score(text: Column, model: Model) -> Column:
    """Chance from 0 to 1 that a text is toxic, by the linear classifier alone.

    Null and empty texts trigger no lexicon entry and score as such. Nothing but the text is read,
    so repeated rows and further columns change nothing.
    """

    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_cache("toxicity")
        voters = Voters(model.lexicon)
        plain, steps = model.weights[: voters.width], model.weights[voters.width :]
        reach = np.concatenate([[0.0], np.cumsum(steps)])
        for texts in parts:
            odds = np.empty(len(texts))
            for row, body in enumerate(texts):
                fired, listed = voters.fired(body)
                odds[row] = model.bias + plain[fired].sum() + reach[min(listed, STEPS)]
            yield pd.Series(1 / (1 + np.exp(-np.clip(odds, -700, 700))))
        del voters
        give_back()

    return of(text)


def clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose score is below one half; columns as in ``docs``."""
    return docs.where(score(F.col(text), model) < 0.5)
