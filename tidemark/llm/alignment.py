"""Alignment of two tokenizers' tokens: pointers to the farthest overlap, doubled until they rest."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.byte_pieces import PATTERN, BytePieces, is_plain, slices
from tidemark.llm.common import worker_cache
from tidemark.llm.packing import tokenizer_path
from tidemark.session import pinned

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Code points of text whose links share one list of id pairs.
BLOCK_CHARS = 8_000_000
PAIR_SHIFT = 32

_BYTE = re.compile("<0x([0-9A-F]{2})>")
# Words without white space that are longer go to the tokenizer that needs no square of them.
LONGEST = 1000


class FirstIds:
    """Ids of a text by the byte-level tokenizer.

    A text of plain characters is merged by ranks: ids grow in the order of the merges, so the
    pair of the least id is the one that the tokenizer would merge first. Other texts, and very
    long words, go through the tokenizer itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        pieces = BytePieces(path)
        self.bytes_of = pieces.token_bytes()
        ranks = {raw: token for token, raw in self.bytes_of.items()}
        if any(bytes([byte]) not in ranks for byte in range(256)):
            raise ValueError("without a token for every byte a text may not be spelled by its tokens")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.ranked = None
        if pieces.merged_in_order():
            self.ranked = tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.ranked and is_plain(text) and len(max(text.split(), key=len, default="")) <= LONGEST:
            return self.ranked.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int64)


class SecondIds:
    """Ids of a text by the piece tokenizer.

    No piece has a space after another character, so no merge reaches over the start of a word and
    the ids of a text are those of its slices; a vocabulary where that does not hold is refused.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in piece.lstrip("▁") for piece in pieces):
            raise ValueError("pieces that hold a space after another character are not handled")
        self.bytes_of = dict(enumerate(map(self._bytes, pieces)))
        self.spells = self._spells_all()

    def _spells_all(self) -> bool:
        """Whether tokens spell every text without U+2581: it is not normalised, gets its one space
        and falls back on bytes where no piece fits."""
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        model.ParseFromString(self.model.serialized_model_proto())
        given, trained = model.normalizer_spec, model.trainer_spec
        changed = given.precompiled_charsmap or given.normalization_rule_tsv or given.remove_extra_whitespaces
        spaced = given.add_dummy_prefix and given.escape_whitespaces and not trained.treat_whitespace_as_suffix
        every = all(self.model.piece_to_id(f"<0x{byte:02X}>") != self.model.unk_id() for byte in range(256))
        return bool(given.name == "identity" and not changed and spaced and trained.byte_fallback and every)

    @staticmethod
    def _bytes(piece: str) -> bytes:
        byte = _BYTE.fullmatch(piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def __call__(self, text: str) -> np.ndarray:
        """``text`` begins with the space that the tokenizer adds by itself."""
        return np.array(self.model.encode(text[1:]), dtype=np.int64)

    def spelled(self, ids: np.ndarray, text: str) -> bool:
        """Whether the bytes of the tokens are those of the text."""
        if self.spells:
            return "▁" not in text
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())) == text.encode()


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The terminal token of every token, A's before B's, from ascending byte ends.

    Both sequences cover the same bytes. Every token points to the token of the other side that
    overlaps it and reaches farthest to the right; where both end together, the token of A is
    where they rest. Each round replaces a pointer by its pointer's pointer, so a component of n
    tokens needs log2(n) rounds.
    """
    n = len(ends_a)
    to_b = np.searchsorted(ends_b, ends_a)
    own = np.arange(n)
    from_a = np.where(ends_b[to_b] == ends_a, own, n + to_b) if n else own
    successor = np.concatenate([from_a, np.searchsorted(ends_a, ends_b)])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor
        successor = further


@dataclass(frozen=True)
class Groups:
    """Groups of one text: ``of_a`` and ``of_b`` number the group of each token, ``links`` holds
    one (token of A, token of B) for each group, the two that end it."""

    of_a: np.ndarray
    of_b: np.ndarray
    links: tuple[np.ndarray, np.ndarray]


def group_tokens(ends_a: np.ndarray, ends_b: np.ndarray) -> Groups:
    """Tokens cut into groups at the byte offsets where a token of each side ends."""
    rests = terminals(ends_a, ends_b)
    n = len(ends_a)
    last_a = np.flatnonzero(rests[:n] == np.arange(n))
    number = np.zeros(n, dtype=np.int64)
    number[last_a] = np.arange(len(last_a))
    groups = number[rests]
    return Groups(groups[:n], groups[n:], (last_a, np.searchsorted(ends_b, ends_a[last_a])))


class Aligner:
    """Both tokenizers of a worker process, and the alignment of one text."""

    def __init__(self, path_a: str, path_b: str):
        self.sides = [FirstIds(path_a), SecondIds(path_b)]
        self.lengths = []
        shown: list[bytes] = []
        self.starts = []
        for side, last in zip(self.sides, "|;"):
            top = max(side.bytes_of) + 1
            lengths = np.zeros(top, dtype=np.int64)
            for token, raw in side.bytes_of.items():
                lengths[token] = len(raw)
            self.lengths.append(lengths)
            self.starts.append(len(shown))
            for token in range(top):
                shown += [f"{token},".encode(), f"{token}{last}".encode()]
        # A row of bytes for each way to write an id, short ones filled up with zeros.
        self.shown = np.array(shown, dtype=np.bytes_).view(np.uint8).reshape(len(shown), -1)

    def align(self, text: str | None) -> tuple[int, int, np.ndarray, str]:
        """(tokens of A, tokens of B, id pairs of the links, sha256 of the groups) of a whole text.

        A long text goes slice by slice: both tokenizers begin a token at a slice's first space.
        """
        nothing = (0, 0, np.zeros(0, dtype=np.int64), "")
        if not text:
            return nothing
        digest, counts, links, between = hashlib.sha256(), [0, 0], [], b""
        for part in slices(" " + text):
            ids = [side(part) for side in self.sides]
            # The tokens of A spell any text, as it has one for every byte.
            if not self.sides[1].spelled(ids[1], part):
                return nothing
            ends = [np.cumsum(self.lengths[side][ids[side]]) for side in (0, 1)]
            groups = group_tokens(*ends)
            spelled = self._spelled(ids, groups)
            digest.update(between + spelled)
            between = b";"
            pairs = [ids[side][groups.links[side]] for side in (0, 1)]
            links.append(pairs[0] << PAIR_SHIFT | pairs[1])
            counts = [counts[side] + len(ids[side]) for side in (0, 1)]
        return counts[0], counts[1], np.concatenate(links), digest.hexdigest()

    def _spelled(self, ids: list[np.ndarray], groups: Groups) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: each group's ids of A, then of B."""
        n = len(groups.links[0])
        of = [groups.of_a, groups.of_b]
        per_group = [np.bincount(side, minlength=n) for side in of]
        before = [np.cumsum(counts) - counts for counts in per_group]
        # A's tokens follow B's of earlier groups; B's follow A's of their own group too.
        shift = [before[1], before[0] + per_group[0]]
        codes = np.empty(len(ids[0]) + len(ids[1]), dtype=np.int64)
        for side in (0, 1):
            code = self.starts[side] + 2 * ids[side]
            code[groups.links[side]] += 1
            codes[np.arange(len(code)) + shift[side][of[side]]] = code
        written = self.shown[codes].ravel()
        return written[written != 0].tobytes()[:-1]


def _aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process."""
    kept = worker_cache("alignment")
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = Aligner(path_a, path_b)
    return kept[path_a, path_b]


ALIGNED = (
    "block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "links binary, pairs array<long>, times array<long>"
)


def aligned(
    docs: DataFrame,
    text: str = "text",
    row_id: str = "doc_id",
    paths: tuple[str, str] | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Every document aligned by itself, some megabytes of text to a block.

    ``links`` points into the block's list of id pairs, which the first row of the block carries as
    ``pairs`` with ``times``, how many links of the block hold each. The pointers are bytes, two or
    four to each as the list asks for, so that Spark moves them as they are. ``block`` differs between
    blocks of one table as long as the table is stored before it is read.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*(paths or (tokenizer_path(TOKENIZER_A), tokenizer_path(TOKENIZER_B))))
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            rows, size, low = [], 0, 0
            for place, body in enumerate(batch.column("text")):
                whole = body.as_py()
                rows.append(aligner.align(whole))
                size += len(whole or "")
                if size >= block_chars or place + 1 == batch.num_rows:
                    yield _block(block, batch.column("row_id").slice(low, len(rows)), rows)
                    block, rows, size, low = block + 1, [], 0, place + 1

    rows = docs.select(F.col(row_id).alias("row_id"), F.col(text).alias("text"))
    kind = docs.schema[row_id].dataType.simpleString()
    return rows.mapInArrow(blocks, f"row_id {kind}, {ALIGNED}")


def _block(block: int, row_ids: pa.Array, rows: list[tuple[int, int, np.ndarray, str]]) -> pa.RecordBatch:
    n = len(rows)
    links = [row[2] for row in rows]
    pairs, place, times = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
    counts = np.array([len(x) for x in links], dtype=np.int64)
    place = place.astype(np.min_scalar_type(max(len(pairs), 256)).newbyteorder("<"))
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts * place.itemsize)]), pa.int32())
    once = pa.array(np.arange(n + 1).clip(max=1) * len(pairs), pa.int32())
    only_first = pa.array(np.arange(n) > 0)

    def whole_block(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(once, pa.array(values, pa.int64()), mask=only_first)

    n_links = pa.array(counts, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            row_ids,
            pa.array(np.full(n, block), pa.int64()),
            pa.array([row[0] for row in rows], pa.int64()),
            pa.array([row[1] for row in rows], pa.int64()),
            n_links,  # a group has one token of each side at its end
            n_links,
            pa.array([row[3] for row in rows], pa.string()),
            pa.Array.from_buffers(pa.binary(), n, [None, offsets.buffers()[1], pa.py_buffer(place)]),
            whole_block(pairs),
            whole_block(times),
        ],
        names=["row_id", *[field.split()[0] for field in ALIGNED.split(", ")]],
    )


def align_tokens(
    docs: DataFrame, text: str = "text", row_id: str = "doc_id", paths: tuple[str, str] | None = None
) -> DataFrame:
    """(row_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    The second tokenizer adds a space before a text, the first is given one. ``n_best`` counts
    the links whose id pair has the highest count of its id of B over all rows, ties included;
    ``count_sum`` adds up the counts of the links.

    Links are summed in blocks of text before they move, so a pair has one row a block, however
    often it is linked, and what comes back is looked up block by block. The best count per id of B
    has at most a row for each vocabulary entry of B, which bounds its broadcast.

    Null and empty texts, and texts whose tokens do not spell them (they hold U+2581), have zeros
    and an empty ``groups_sha256``. Repeated rows and rows without an id each get a row and count.
    Other columns are ignored. An empty table gives an empty result. ``paths`` names the two files
    on the workers; by default each worker looks up its own.
    """
    stored = pinned(aligned(docs, text, row_id, paths), "aligned")
    listed = stored.where(F.col("pairs").isNotNull()).select("block", "pairs", "times")
    posted = listed.select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "pair")).select(
        "block", "place", "pair.pairs", "pair.times"
    )
    counts = pinned(posted.groupBy("pairs").agg(F.sum("times").alias("count")), "pair-counts")
    of_b = F.col("pairs").bitwiseAND(F.lit((1 << PAIR_SHIFT) - 1)).alias("b")
    highest = counts.groupBy(of_b).agg(F.max("count").alias("highest"))
    judged = counts.select("pairs", "count", of_b).join(F.broadcast(highest), "b")
    judged = judged.select("pairs", "count", (F.col("count") == F.col("highest")).alias("best"))
    looked_up = posted.join(judged, "pairs").select(F.col("block").alias("of_block"), "place", "count", "best")

    kind = docs.schema[row_id].dataType.simpleString()
    totals = stored.drop("pairs", "times").groupBy("block").cogroup(looked_up.groupBy("of_block"))
    found = totals.applyInArrow(
        _totals,
        f"row_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string",
    )
    return found.withColumnRenamed("row_id", row_id)


def _totals(rows: pa.Table, looked_up: pa.Table) -> pa.Table:
    """The sums over the links of each row of a block."""
    counts = np.zeros((2, looked_up.num_rows + 1), dtype=np.int64)
    places = looked_up.column("place").to_numpy()
    counts[0, places] = looked_up.column("best").to_numpy()
    counts[1, places] = looked_up.column("count").to_numpy()
    links = b"".join(rows.column("links").to_pylist())
    ends = np.concatenate([[0], np.cumsum(rows.column("n_links").to_numpy())])
    flat = np.frombuffer(links, dtype=f"<u{len(links) // ends[-1]}" if links else "<u2")
    sums = []
    for values in counts:
        running = np.concatenate([[0], np.cumsum(values[flat])])
        sums.append(pa.array(np.diff(running[ends]), pa.int64()))
    kept = rows.drop_columns(["block", "links", "groups_sha256"])
    kept = kept.append_column("n_best", sums[0]).append_column("count_sum", sums[1])
    return kept.append_column("groups_sha256", rows.column("groups_sha256"))
