"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, and a check of the distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, give_back, worker_cache
from tidemark.llm.components import components
from tidemark.session import pinned

BITS = 64
SHINGLE_WORDS, MAX_BITS, SEED = 3, 2, 42
# Blocks that share more fingerprints than this are linked through common neighbours.
CROWDED = 64
# Shingles hashed at a time, so that a very long text needs bounded memory.
SLICE = 1 << 16


def _hashes(words: list[bytes], size: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of each shingle, repeats included, some thousands at a time."""
    if len(words) < size:
        if words:
            yield np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], dtype=np.uint64)
        return
    for at in range(0, len(words) - size + 1, SLICE):
        part = words[at : at + SLICE + size - 1]
        shingles = map(b" ".join, zip(*[part[i:] for i in range(size)]))
        count = len(part) - size + 1
        yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, count)


def fingerprint_of(text: str | None, size: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The unsigned fingerprint of one text; 0 without words."""
    # bytes.lower() maps A-Z alone and bytes.split() cuts at 0x20 and 0x09-0x0D alone.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    for hashes in _hashes(words, size, seed):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(sum(1 << int(bit) for bit in np.flatnonzero(ones * 2 > total)))


def fingerprint(text: Column, size: int = SHINGLE_WORDS, seed: int = SEED) -> Column:
    """SimHash of a text column as a signed long; null and empty texts give 0."""

    @F.pandas_udf("long")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_cache("simhash")
        for texts in parts:
            values = np.fromiter((fingerprint_of(t, size, seed) for t in texts), np.uint64, len(texts))
            yield pd.Series(values.view(np.int64))
        give_back()

    return of(text)


def as_hex(value: Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _spans(parts: int) -> list[tuple[int, int]]:
    """(first bit, width) of each of ``parts`` blocks of nearly equal width."""
    cuts = [BITS * i // parts for i in range(parts + 1)]
    return [(low, high - low) for low, high in zip(cuts, cuts[1:])]


def _mask(spans: list[tuple[int, int]]) -> int:
    value = sum(((1 << width) - 1) << low for low, width in spans)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def blocks(max_bits: int) -> list[list[tuple[int, int]]]:
    """Block choices such that prints within ``max_bits`` agree on at least one choice.

    With ``max_bits + 2`` blocks, that many differing bits leave two blocks untouched, so every
    choice of two blocks is one table: longer keys than one untouched block would give.
    """
    return [list(pair) for pair in combinations(_spans(max_bits + 2), 2)]


def _bit(position: int) -> int:
    return 1 << position if position < BITS - 1 else -(1 << (BITS - 1))


def linked_prints(prints: DataFrame, max_bits: int = MAX_BITS, crowded: int = CROWDED) -> DataFrame:
    """Pairs (a, b) of different fingerprints that connect all prints within ``max_bits`` bits.

    ``prints`` has a distinct long column ``fingerprint``. Every print is posted under each block
    choice; prints that meet in a block are compared by the number of differing bits. A crowded
    block would hold the square of its size in pairs, so its members are posted again under every
    way to change up to half of ``max_bits`` among their other bits: two prints within the
    distance share such a neighbour, and each links to the least print at it. No
    connection is lost and the rows stay in proportion to the prints. That needs an even distance.
    """
    if max_bits % 2:
        raise ValueError("crowded blocks are linked exactly for an even number of bits only")
    tables = blocks(max_bits)
    keys = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(_mask(spans))).alias("block"))
                for i, spans in enumerate(tables)
            ]
        )
    )
    posted = prints.select("fingerprint", keys.alias("k")).select("fingerprint", "k.choice", "k.block")
    sizes = posted.groupBy("choice", "block").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
    shared = pinned(posted.join(sizes, ["choice", "block"]), "blocks")
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))

    few = shared.where(F.col("met") <= crowded)
    left = few.select("choice", "block", F.col("fingerprint").alias("a"))
    right = few.select("choice", "block", F.col("fingerprint").alias("b"))
    met = left.join(right, ["choice", "block"]).where("a < b").where(differing <= max_bits)

    many = shared.where(F.col("met") > crowded)
    near = many.select("fingerprint", _neighbours(tables, max_bits // 2).alias("spot"))
    least = near.groupBy("spot").agg(F.min("fingerprint").alias("a"), F.count(F.lit(1)).alias("n"))
    starred = near.join(least.where("n > 1"), "spot").select("a", F.col("fingerprint").alias("b"))
    starred = starred.where("a < b").where(differing <= max_bits)
    return met.select("a", "b").unionByName(starred)


def _neighbours(tables: list[list[tuple[int, int]]], flips: int) -> Column:
    """Every print that differs in at most ``flips`` bits outside the shared blocks, itself included."""
    each = None
    for i, spans in enumerate(tables):
        fixed = {low + k for low, width in spans for k in range(width)}
        free = [bit for bit in range(BITS) if bit not in fixed]
        masks = [0]
        for count in range(1, flips + 1):
            for chosen in combinations(free, count):
                value = 0
                for bit in chosen:
                    value ^= _bit(bit)
                masks.append(value)
        listed = F.array(*[F.lit(m).cast("long") for m in masks])
        each = F.when(F.col("choice") == i, listed) if each is None else each.when(F.col("choice") == i, listed)
    return F.explode(F.transform(each, lambda m: F.col("fingerprint").bitwiseXOR(m)))


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    row_id: str = "doc_id",
    size: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    seed: int = SEED,
) -> DataFrame:
    """(row_id, fingerprint, component_id) for every row of ``docs``.

    Rows are linked when their fingerprints differ in at most ``max_bits`` bits; component_id is
    the least id reachable over links. Equal fingerprints are one node, so copies cost nothing
    beyond their own row.

    Null and empty texts have fingerprint 0 and are linked like any other. Repeated rows each get a
    row. A row without an id takes part by its text; component_id is the least id among its links,
    null if none has one. Other columns are ignored. An empty table gives an empty result.
    """
    printed = docs.select(F.col(row_id).alias("id"), fingerprint(F.col(text), size, seed).alias("fingerprint"))
    grouped = _grouped(pinned(printed, "prints"), max_bits)
    return grouped.select(
        F.col("id").alias(row_id), as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def _grouped(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Stored rows (id, fingerprint) with root, the least fingerprint of the group, and component_id."""
    prints = pinned(rows.groupBy("fingerprint").agg(F.min("id").alias("first_id")), "distinct")
    roots = components(linked_prints(prints.select("fingerprint"), max_bits))
    grouped = prints.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "first_id"
    )
    firsts = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = grouped.join(firsts, "root").select("fingerprint", "root", "component_id")
    return rows.join(named, "fingerprint").select("id", "fingerprint", "root", "component_id")


def without_copies(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """One row of each near-duplicate group, the one with the least id; columns as in ``docs``.

    Rows without an id are kept, as nothing names them a copy. Rows that repeat an id count as
    copies of each other if they are in one group; the one of the least fingerprint stays, and of
    equal fingerprints the one of the least text. An id may be the least of several groups.

    Documents are stored once with their fingerprint, so that no text is hashed again.
    """
    printed = fresh("_print", docs.columns)
    stored = pinned(docs.withColumn(printed, fingerprint(F.col(text))), "printed")
    rows = stored.select(F.col(row_id).alias("id"), F.col(printed).alias("fingerprint"))
    found = pinned(_grouped(rows), "groups")
    least = found.where(F.col("id") == F.col("component_id")).groupBy("id", "root")
    first = least.agg(F.min("fingerprint").alias(printed), F.count(F.lit(1)).alias("rows"))
    first = pinned(first.select(F.col("id").alias(row_id), printed, "rows"), "kept")
    unnamed = stored.where(F.col(row_id).isNull())
    # Whole documents meet a list of ids as long as the table: shuffled alike at every size.
    key = [row_id, printed]
    marked = stored.where(F.col(row_id).isNotNull())
    kept = marked.join(first.select(*key).hint("merge"), key, "left_semi")
    again = first.where("rows > 1").select(*key)
    if not again.isEmpty():
        whole = F.min_by(F.struct(*docs.columns), F.struct(text)).alias("whole")
        repeated = kept.join(again, key, "left_semi").groupBy(*key).agg(whole).select("whole.*")
        kept = kept.join(again, key, "left_anti").select(*docs.columns).unionByName(repeated)
    return kept.select(*docs.columns).unionByName(unnamed.select(*docs.columns))
