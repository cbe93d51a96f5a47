"""Packing token sequences: Martello-Toth dominance reduction, then best fit for the remainder."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import running_sum, worker_cache
from tidemark.session import pinned

TOKENIZER = "word_bpe_49k.json"
CAPACITY, END = 4096, 1
# Words whose ids a Python worker remembers; beyond that it starts anew.
REMEMBERED = 600_000

# Words of visible ASCII and Latin-1 letters, whose normal form and lower case are plain.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# How the tokenizer cuts such a word.
_CUTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where a public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Ids of a text as little-endian uint32 bytes, word by word.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    words cut at spaces and line feeds. Ids of words seen before are remembered. Plain words go
    straight to the tokenizer's own model, cut as it cuts them; any other word goes through the
    whole tokenizer.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.remembered = remembered
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def __call__(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        known = self.words
        try:
            return b"".join([known[word] for word in words])
        except KeyError:
            if len(known) > self.remembered:
                known.clear()
            if len(self.pieces) > self.remembered:
                self.pieces.clear()
            for word in set(words):
                if word not in known:
                    known[word] = self._ids(word)
            return b"".join([known[word] for word in words])

    def _ids(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join(self._piece(piece) for piece in _CUTS.findall(word.lower()))
        return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            spelled = piece.encode().decode("latin-1").translate(self.letters)
            found = self.pieces[piece] = _packed([token.id for token in self.model.tokenize(spelled)])
        return found


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    # Fixed rule: visible bytes stand for themselves, the others for letters from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}


PIECES = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, text: str, row_id: str, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(row_id, piece, start, length, ids_crc32): every document cut at multiples of the capacity.

    ``path`` names a tokenizer file on the workers; by default each worker looks up its own.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _word_ids(path or tokenizer_path())
        for batch in batches:
            found: list[tuple] = []
            for place, body in enumerate(batch.column("text")):
                ids = ids_of(body.as_py() or "") + _packed([END])
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    found.append((place, number, at // 4, len(part) // 4, zlib.crc32(part)))
            place, number, start, length, crc = zip(*found) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_id").take(pa.array(place, pa.int64())),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["row_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col(row_id).alias("row_id"), F.col(text).alias("text"))
    kind = docs.schema[row_id].dataType.simpleString()
    return rows.mapInArrow(cut, f"row_id {kind}, {PIECES}")


def _word_ids(path: str) -> WordIds:
    """One tokenizer per worker process, so that remembered words outlive a task."""
    loaded = worker_cache("packing")
    if path not in loaded:
        loaded[path] = WordIds(path)
    return loaded[path]


@dataclass(frozen=True)
class Pattern:
    """``count`` sequences that hold the same lengths: ``items`` of (length, how many)."""

    count: int
    items: tuple[tuple[int, int], ...]


class _Stock:
    """How many items of each length are left."""

    def __init__(self, counts: dict[int, int]):
        self.left = {length: n for length, n in counts.items() if n > 0}
        self.lengths = sorted(self.left)

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            del self.lengths[bisect_left(self.lengths, length)]

    def at_most(self, room: int) -> int | None:
        """The longest length that fits."""
        place = bisect_right(self.lengths, room)
        return self.lengths[place - 1] if place else None

    def smallest(self, n: int, besides: int | None = None) -> list[int]:
        """The n smallest items, one of ``besides`` left out."""
        found: list[int] = []
        for length in self.lengths:
            have = self.left[length] - (length == besides)
            found += [length] * min(have, n - len(found))
            if len(found) == n:
                break
        return found

    def below(self, length: int) -> int | None:
        """The longest length that is shorter."""
        place = bisect_left(self.lengths, length)
        return self.lengths[place - 1] if place else None

    def longest_pair(self, room: int, besides: int) -> int:
        """The most that two items fill of the room, one item of ``besides`` left out."""
        lengths = [n for n in self.lengths if n != besides or self.left[n] > 1]
        best, high = 0, len(lengths) - 1
        for low, length in enumerate(lengths):
            while high > low and length + lengths[high] > room:
                high -= 1
            if high <= low:
                have = self.left[length] - (length == besides)
                if have > 1 and 2 * length <= room:
                    best = max(best, 2 * length)
                break
            best = max(best, length + lengths[high])
            if 2 * length <= room and self.left[length] - (length == besides) > 1:
                best = max(best, 2 * length)
        return best


def reduce_by_dominance(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Pattern], dict[int, int]]:
    """Fix sequences that some best packing holds, and return them with the lengths left over.

    For the longest item i, a set of items that fits beside it dominates another if the other's
    items can be packed into the first one's places; a set that dominates all others may be fixed:

    * nothing fits beside i: i alone;
    * the longest item that fits, j, fills the sequence: {i, j}, as whatever else stood beside i
      fits in j's place;
    * no two items fit beside i: {i, j}, as every single item is at most j;
    * two fit but no three do, and j is at least as long as the longest pair that fits: {i, j}.

    Where none holds for a length, it is left over and stays available as a partner. Items of one
    length are fixed many at a time, so the work depends on the number of lengths and not of items.
    """
    stock = _Stock(counts)
    fixed: list[Pattern] = []
    for length in sorted(counts, reverse=True):
        while length in stock.left:
            room, have = capacity - length, stock.left[length]
            partner = stock.at_most(room)
            if partner == length and have == 1:
                partner = stock.below(length)
            if partner is None:
                fixed.append(Pattern(have, ((length, 1),)))
                stock.take(length, have)
                continue
            smallest = stock.smallest(3, besides=length)
            dominant = (
                partner == room
                or len(smallest) < 2
                or smallest[0] + smallest[1] > room
                or ((len(smallest) < 3 or sum(smallest) > room) and partner >= stock.longest_pair(room, length))
            )
            if not dominant:
                break
            # Taking items away leaves longer small ones and shorter pairs, so what holds for one
            # pair of this kind holds for all of them.
            if partner == length:
                fixed.append(Pattern(have // 2, ((length, 2),)))
                stock.take(length, have // 2 * 2)
            else:
                times = min(have, stock.left[partner])
                fixed.append(Pattern(times, ((length, 1), (partner, 1))))
                stock.take(length, times)
                stock.take(partner, times)
    return fixed, dict(stock.left)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Best fit of the longest items first: each goes where it leaves the least room.

    Sequences with the same content are one pattern with a count, so a length's items are placed
    together, as many in a sequence as fit; the number of patterns is bounded by the lengths.
    """
    by_room: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: list) -> None:
        if room not in by_room:
            by_room[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        by_room[room].append(pattern)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            place = bisect_left(rooms, length)
            if place == len(rooms):
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    put(capacity - each * length, [full, ((length, each),)])
                if rest:
                    put(capacity - rest * length, [1, ((length, rest),)])
                left = 0
                continue
            room = rooms[place]
            count, items = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                del rooms[place]
            each = min(room // length, left)
            used = min(count, left // each)
            put(room - each * length, [used, (*items, (length, each))])
            if count > used:
                put(room, [count - used, items])
            left -= used * each
    return [Pattern(count, items) for patterns in by_room.values() for count, items in patterns]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Where the items of each length go: (length, first, upto, each, sequence_id, offset).

    Items ``first`` to ``upto`` of a length lie ``each`` to a sequence, from ``offset`` on, in the
    sequences from ``sequence_id`` on.
    """
    fixed, rest = reduce_by_dominance(counts, capacity)
    given: dict[int, int] = {}
    rows = []
    sequence = 0
    for pattern in [*fixed, *best_fit(rest, capacity)]:
        offset = 0
        for length, each in pattern.items:
            first = given.get(length, 0)
            given[length] = first + each * pattern.count
            rows.append((length, first, given[length], each, sequence, offset))
            offset += each * length
        sequence += pattern.count
    columns = ["length", "first", "upto", "each", "sequence_id", "offset"]
    return pd.DataFrame(rows, columns=columns, dtype="int64")


def pack(
    docs: DataFrame,
    text: str = "text",
    row_id: str = "doc_id",
    path: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """(row_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece.

    A document is its token ids and one closing id; only longer ones are cut, into pieces of
    ``capacity`` and a last one. Which lengths share a sequence depends only on how many pieces
    have each length: at most ``capacity`` numbers, counted by Spark and planned on the driver.
    The pieces then find their places in parallel: a piece's rank among those of its length picks
    its sequence and offset. The plan travels as a table bounded by the capacity, whatever the
    number of documents.

    Null and empty texts are one closing id. Repeated rows are packed as often as they occur, rows
    without an id too. Other columns are ignored. An empty table gives an empty result.
    """
    cut = pinned(
        pieces(docs, text, row_id, path, capacity).select(
            "*", F.monotonically_increasing_id().alias("row"), F.rand(7).alias("at"), F.lit(1).alias("one")
        ),
        "pieces",
    )
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = plan(counts, capacity)
    ranked = running_sum(cut, ["length"], "at", ["row"], "one", "rank")
    lengths = {length: part.to_numpy().T[1:] for length, part in places.groupby("length")}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(name).to_numpy() for name in ("length", "rank"))
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for one in np.unique(length):
                rows = np.flatnonzero(length == one)
                first, upto, each, begin, at = lengths[one]
                entry = np.searchsorted(upto, rank[rows], side="right")
                within = rank[rows] - first[entry]
                sequence[rows] = begin[entry] + within // each[entry]
                offset[rows] = at[entry] + within % each[entry] * one
            kept = batch.select(["row_id", "piece", "start", "length", "ids_crc32"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(offset)],
                names=[*kept.schema.names, "sequence_id", "offset"],
            )

    kind = docs.schema[row_id].dataType.simpleString()
    placed = ranked.mapInArrow(place, f"row_id {kind}, {PIECES}, sequence_id long, offset long")
    return placed.withColumnRenamed("row_id", row_id)
