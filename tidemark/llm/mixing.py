"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, running_sum
from tidemark.session import pinned

# A word is a run of anything but 0x20 and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
# Words of one block, and slots that one task generates.
BLOCK_WORDS, CHUNK = 256, 1 << 16


@dataclass(frozen=True)
class Mix:
    """``rows``: row, row_id, source, size, source_size, target. ``spans``: what each slot holds."""

    rows: DataFrame
    sources: DataFrame
    schedule: DataFrame
    spans: DataFrame


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """(source_ix, source, source_size, target) from rows of (source, size).

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` times
    all words. A target stops at ``most`` times its source's words and the excess is shared again
    by weight. That ends where every open source has the same words per weight, so the sources are
    ordered by the level at which they fill up and the first level that fills no further source
    is the common one. The windows run over one row per source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.array(*[F.lit(w) for w in weights])
    listed = sums.withColumn("source_ix", place).withColumn(
        "weight", F.element_at(turn, F.col("source_ix") % len(weights) + 1)
    )
    listed = listed.withColumn("cap", F.col("source_size") * most)
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("source_size") / F.col("weight"), "source_ix")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    words = F.sum("source_size").over(everything) * F.lit(float(share))
    open_words = words - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = listed.withColumn("level", open_words / open_weight)
    levels = levels.withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    rank = F.row_number().over(by_level)
    level = levels.withColumn("r", rank).withColumn(
        "common", F.min(F.when(~F.col("full"), F.struct("r", "level"))).over(everything)
    )
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.col("common.level") * F.col("weight")
    )
    return level.select("source_ix", "source", "source_size", target.alias("target"))


def _reversed_bits(value: Column, width: Column) -> Column:
    """The lowest ``width`` bits of a long in reverse order."""
    # The masks that swap bits, pairs, nibbles, bytes and so on.
    for shift, mask in (
        (1, 0x5555555555555555),
        (2, 0x3333333333333333),
        (4, 0x0F0F0F0F0F0F0F0F),
        (8, 0x00FF00FF00FF00FF),
        (16, 0x0000FFFF0000FFFF),
    ):
        low = F.shiftleft(value.bitwiseAND(F.lit(mask)), shift)
        value = low.bitwiseOR(F.shiftrightunsigned(value, shift).bitwiseAND(F.lit(mask)))
    value = F.shiftleft(value, 32).bitwiseOR(F.shiftrightunsigned(value, 32))
    return F.call_function("shiftrightunsigned", value, (F.lit(64) - width).cast("int"))


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(source_ix, position, slot): the order in which sources give their blocks.

    A source gets a slot per block of its target. The slots of all sources, one after the other,
    are intervals of v / 2**k below one: the cumulative weights. The van der Corput point of
    position i is i with its bits reversed, over 2**k, so the position that falls on v is v with
    its bits reversed, and each source finds its positions without a search: every stretch of
    positions holds all sources by weight. ``slot`` ranks the positions of a source.
    """
    slots = F.ceil(F.col("quota") / F.lit(block_words)).cast("bigint")
    quota = sources.withColumn("quota", F.round("target").cast("bigint")).withColumn("slots", slots)
    upto = Window.orderBy("source_ix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bits = F.length(F.bin(F.greatest(F.sum("slots").over(Window.partitionBy()) - 1, F.lit(1))))
    ranges = quota.where("slots > 0").select(
        "source_ix", (F.sum("slots").over(upto) - F.col("slots")).alias("low"), "slots", bits.alias("bits")
    )
    chunks = ranges.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / CHUNK))).alias("chunk"))
    start = F.col("low") + F.col("chunk") * CHUNK
    stop = F.least(start + CHUNK, F.col("low") + F.col("slots")) - 1
    points = chunks.repartition("source_ix", "chunk").select(
        "source_ix", "bits", F.explode(F.sequence(start, stop)).alias("v")
    )
    placed = points.select(
        "source_ix",
        _reversed_bits(F.col("v"), F.col("bits")).alias("position"),
        F.lit(1).alias("one"),
        "bits",
    )
    placed = placed.select("source_ix", "position", "one", (F.col("position") / F.pow(F.lit(2.0), "bits")).alias("at"))
    stored = pinned(placed, "positions")
    return running_sum(stored, ["source_ix"], "at", ["position"], "one", "slot").select(
        "source_ix", "position", "slot"
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    row_id: str = "doc_id",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
) -> Mix:
    """Mix all rows to the targets of their sources.

    Each source is one stream: its documents in a shuffled order fixed by the md5 of the id, the
    whole repeated up to ``most`` times, cut into blocks of ``block_words`` words and ended at the
    target. The slot with rank r of a source takes its block r. ``spans`` lists, by position, the
    words each block takes from each document: (position, source_ix, slot, pass, row, row_id,
    first_word, words). A source's words are its rounded target, so none gives a document more
    than ``most`` times, and a rerun gives the same mix.

    Null and empty texts have no words and appear in no span; null is a source of its own, the
    last. Rows that repeat an id are rows of their own. Other columns are ignored. An empty table
    gives empty results, as does a table without words (its targets are 0).
    """
    shuffled = F.md5(F.coalesce(F.col(row_id).cast("string"), F.lit("")).cast("binary"))
    sized = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(row_id).alias("row_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        shuffled.alias("shuffle"),
    )
    stored = pinned(sized, "sized")
    sources = pinned(source_targets(stored, weights, share, most), "sources")
    rows = stored.join(sources, stored["source"].eqNullSafe(sources["source"])).select(
        "row", "row_id", stored["source"], "size", "shuffle", "source_ix", "source_size", "target"
    )
    at = F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    streamed = running_sum(
        pinned(rows.where("size > 0").withColumn("at", at), "streams"),
        ["source_ix"],
        "at",
        ["shuffle", "row_id", "size", "row"],
        "size",
        "start",
    )
    order = schedule(sources, block_words)
    quota = F.round("target").cast("bigint")
    each = streamed.select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("pass"))
    low = F.col("start") + F.col("pass") * F.col("source_size")
    each = each.withColumn("low", low).withColumn("high", F.least(low + F.col("size"), quota)).where("low < high")
    first = F.floor(F.col("low") / block_words)
    last = F.floor((F.col("high") - 1) / block_words)
    cut = each.select("*", F.explode(F.sequence(first, last)).alias("slot"))
    begin = F.greatest("low", F.col("slot") * block_words)
    end = F.least("high", (F.col("slot") + 1) * block_words)
    spans = cut.join(order, ["source_ix", "slot"]).select(
        "position",
        "source_ix",
        "slot",
        "pass",
        "row",
        "row_id",
        (begin - F.col("low")).alias("first_word"),
        (end - begin).alias("words"),
    )
    return Mix(rows.drop("shuffle"), sources, order, spans)


def taken_words(mixed: Mix) -> DataFrame:
    """The rows of a mix with ``taken``, the words it takes of each, repeats counted."""
    taken = mixed.spans.groupBy("row").agg(F.sum("words").alias("taken"))
    return mixed.rows.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("bigint"))


def mixed_documents(docs: DataFrame, text: str = "text", row_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The documents as often as the mix takes them, whole: columns as in ``docs``.

    A source's stream ends inside one document at most; that one is taken if at least half of it
    is. Documents the mix never reaches, and those without words, go. Rows that repeat an id, a
    source and a size are taken as often as the most taken of them; rows without an id likewise.
    """
    taken = taken_words(mix(docs, text, row_id, source))
    times = taken.where("size > 0").groupBy("row_id", "source", "size").agg(
        F.max(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("int").alias("times")
    )
    by_id, by_source, by_size, often, copy = (
        fresh(name, docs.columns) for name in ("_id", "_source", "_size", "_often", "_copy")
    )
    named = {by_id: "row_id", by_source: "source", by_size: "size", often: "times"}
    times = pinned(times.where("times > 0"), "times").select(*[F.col(c).alias(n) for n, c in named.items()])
    same = (
        F.col(row_id).eqNullSafe(F.col(by_id))
        & F.col(source).eqNullSafe(F.col(by_source))
        & (word_count(F.col(text)) == F.col(by_size))
    )
    copies = F.explode(F.sequence(F.lit(1), F.col(often)))
    # Whole documents meet a list nearly as long as the table: shuffled alike at every size.
    return docs.join(times.hint("merge"), same).select(*docs.columns, copies.alias(copy)).drop(copy)
