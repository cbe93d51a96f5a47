"""Spelling variants, token counts and token alignment against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment, byte_pieces, spelling, token_counts
from tidemark.llm.packing import tokenizer_path
from tidemark.llm.queries import QUERIES

pytest.importorskip("public_tokenizers")

DOCS = "doc_id long, text string"
# Names that the operators use inside.
CLASH = ["word", "n", "near", "key", "rid", "reduced", "form", "root", "block", "links", "pairs", "row_id", "n_bytes", "b"]
# Letters, marks and spaces of several scripts, special strings, and what stands for a space in pieces.
ODD = list("ab 'sdt\n\t 09é ſΩжЖ한字  　²½ⅷ́\x1c\x85😀!?…’\r") + [
    "<|endoftext|>", " the", " 'll", "▁", "\x00", "İ", "<0x0A>", "<s>", "   ", "|<", "endoftext",
]


def documents(spark, rows, clash=False):
    made = spark.createDataFrame(rows, DOCS)
    if clash:
        for name in CLASH:
            made = made.withColumn(name, F.lit("clash"))
    return made


def odd_texts(n, seed, longest=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(longest))) for _ in range(n)]


# --- spelling variants


def one_edit(a, b):
    """Whether one inserted, deleted or replaced letter makes a of b."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(rows):
    counts = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= 10 * words[word]:
            form[word] = best

    def root(word):
        return root(form[word]) if word in form else word

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def misspelt(seed, n=400):
    """Texts of few long words in shares that fall tenfold, many of them with wrong letters."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéÀ") for _ in range(rng.randrange(6, 11))) for _ in range(12)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(60)):
            word = words[min(int(rng.expovariate(1.2)), 11)]
            for _ in range(rng.choice([0, 0, 0, 0, 0, 0, 1, 2])):
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", "e", "É", "a", "bb"]) + word[at + rng.randrange(2) :]
            text.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((i, rng.choice([" ", ", ", "1", "\n"]).join(text)))
    return rows


@pytest.mark.parametrize("symbols", [None, 2, 20])
def test_variants_equal_brute_force_whatever_the_alphabet(spark, symbols):
    rows = misspelt(5) + [(None, "nullable Nullable"), (7, None), (8, ""), (3, "nullable"), (3, "nullable")]
    found = spelling.variants(documents(spark, rows, clash=True), symbols=symbols)
    expected = brute_variants(rows)
    assert {tuple(r) for r in found.collect()} == expected
    assert found.count() == len(expected)
    assert sum(form is not None for _, form, *_ in expected) > 20
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_forms_are_followed_to_the_last_and_ties_go_to_the_first_word(spark):
    text = {"abcdefgh": 2000, "abcdefgi": 150, "abcdefii": 12, "abcdeiii": 2, "qwertyua": 20, "qwertyub": 20, "qwertyux": 2}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(text.items())]
    got = {r.word: r for r in spelling.variants(documents(spark, rows)).collect()}
    # The ids are chosen so that no run of them loses a letter.
    assert set(got) == set(text)
    assert got["abcdeiii"].root == "abcdefgi" or got["abcdeiii"].form is None
    assert got["abcdefii"].root == "abcdefgh" and got["abcdefii"].form == "abcdefgi"
    assert got["qwertyux"].form == "qwertyua" and got["qwertyux"].n_near == 2
    assert got["abcdefgh"].root == "abcdefgh" and got["abcdefgh"].form_n is None


def test_chains_of_any_length_are_followed(spark):
    chain = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(37)] + [("x", "w05"), ("y", "z")]
    roots = dict(spelling.follow(spark.createDataFrame(chain, "word string, form string")).collect())
    assert roots == {**{f"w{i:02d}": "w37" for i in range(37)}, "x": "w37", "y": "z"}


def test_a_neighbourhood_holds_every_word_at_one_edit():
    rng, rolling = random.Random(2), spelling.RollingHash(3)
    for _ in range(200):
        word = "".join(rng.choice("012") for _ in range(rng.randrange(1, 14)))
        every = {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}
        every |= {word[:i] + c + word[j:] for c in "012" for i in range(len(word) + 1) for j in (i, i + 1)}
        assert set(rolling.neighbours(word).tolist()) == {rolling.one(w) for w in every}


def test_variants_of_no_documents_and_of_very_long_runs(spark):
    assert spelling.variants(documents(spark, [])).collect() == []
    assert spelling.variants(documents(spark, [(1, None), (2, "short words 12")])).collect() == []
    long = "xy" * 2_500
    rows = [(i, f"{long} {long}a " * 2 + "tail") for i in range(2)]
    got = {r.word: r.n_near for r in spelling.variants(documents(spark, rows)).collect()}
    assert got == {w: n for w, _, _, _, n, _ in brute_variants(rows)} and len(got) >= 2


def test_few_symbols_are_taken_only_while_words_stay_apart(spark):
    drawn = {"".join(random.Random(i).choices("abcdefg", k=7)) for i in range(3000)}
    words = spark.createDataFrame([(w, 2) for w in drawn], "word string, n long")
    few, more = spelling.symbols_for(words, shared=1000), spelling.symbols_for(words, shared=1.05)
    assert few == spelling.SYMBOLS[0] < more
    assert spelling.symbols_for(words.limit(0)) == spelling.SYMBOLS[0]


# --- token counts


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(token_counts.TOKENIZER))


@pytest.fixture(scope="module")
def pieces():
    return byte_pieces.BytePieces(tokenizer_path(token_counts.TOKENIZER))


def test_counts_equal_the_library_on_odd_texts(library, pieces):
    count = token_counts.TokenCounter(pieces, remembered=50)
    for text in odd_texts(3000, 3) + ["", "<|endoftext|>", "<|endoftext|><|endoftext|> a", "  ", "don't we'll 've"]:
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_strings_proved_whole_are_one_token_and_the_others_are_not(library, pieces):
    assert len(pieces.whole) > 0.98 * len(pieces.vocabulary)
    rng = random.Random(4)
    for piece in rng.sample(sorted(pieces.whole), 500):
        assert pieces.merge(piece) == [pieces.whole[piece]]
    for piece in ("zzqxj", " qqqq", "éèù字"):
        assert (piece in pieces.whole) == (len(pieces.merge(piece)) == 1)


def test_slices_count_as_the_whole_text(library, pieces):
    text = "".join(random.Random(5).choices(["word ", "12 ", "other's", ", ", "\n\n", "  ", "é", "x"], k=4000))
    parts = list(byte_pieces.slices(text, 300))
    assert "".join(parts) == text and len(parts) > 10
    assert [p for part in parts for p in pieces.cut(part)] == pieces.cut(text)
    assert list(byte_pieces.slices("a" * 5000, 300)) == ["a" * 5000]


def test_counted_rows(spark, library):
    texts = ["", "plain words here", "é" * 3, "<|endoftext|> x", "word " * 1100, "long " * 300_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[1]), (None, "no id"), (9, None)]
    found = token_counts.count_tokens(documents(spark, rows, clash=True).select("doc_id", "text", "word"))
    expected = []
    for name, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((name, len((text or "").encode()), n, n > 1024))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert token_counts.count_tokens(documents(spark, [])).collect() == []


# --- alignment


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(tokenizer_path(alignment.TOKENIZER_A), tokenizer_path(alignment.TOKENIZER_B))


@pytest.fixture(scope="module")
def plainly(aligner):
    """(ids of A, ids of B, links, groups as text) by the libraries and byte ends alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(tokenizer_path(alignment.TOKENIZER_A))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(alignment.TOKENIZER_B))

    def align(text):
        if not text:
            return 0, 0, [], ""
        ids = [first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)]
        raw = [[side.bytes_of[i] for i in each] for side, each in zip(aligner.sides, ids)]
        if any(b"".join(each) != (" " + text).encode() for each in raw):
            return 0, 0, [], ""
        ends = [np.cumsum([len(x) for x in each]).tolist() for each in raw]
        groups, links, low = [], [], [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            high = [side.index(cut) + 1 for side in ends]
            groups.append("|".join(",".join(map(str, ids[s][low[s] : high[s]])) for s in (0, 1)))
            links.append((ids[0][high[0] - 1], ids[1][high[1] - 1]))
            low = high
        return len(ids[0]), len(ids[1]), links, hashlib.sha256(";".join(groups).encode()).hexdigest()

    return align


def test_alignment_of_odd_texts_equals_brute_force(aligner, plainly):
    some = 0
    for text in odd_texts(1500, 6) + ["", " ", "a ", "▁", "<s> <0x0A> <|endoftext|>", "naïve façade", "a\x00b"]:
        n_a, n_b, pairs, digest = aligner.align(text)
        expected = plainly(text)
        assert (n_a, n_b, digest) == (expected[0], expected[1], expected[3]), repr(text)
        assert pairs.tolist() == [a << alignment.PAIR_SHIFT | b for a, b in expected[2]]
        some += bool(n_a)
    assert some > 500
    assert aligner.align(None)[3] == "" and aligner.align("x▁")[:2] == (0, 0)


def test_texts_are_spelled_as_the_model_says(aligner):
    second = aligner.sides[1]
    assert second.spells
    for text in filter(None, odd_texts(500, 12)):
        text = " " + text
        whole = b"".join(second.bytes_of[i] for i in second(text).tolist())
        assert second.spelled(second(text), text) == (whole == text.encode()), repr(text)


def test_very_long_words_are_merged_like_any_other(aligner, plainly):
    for text in ("ab" * 3000, "x " + "q" * 1500 + " tail", " " * 5000, "a" * 900):
        got, expected = aligner.align(text), plainly(text)
        assert (got[0], got[1], got[3]) == (expected[0], expected[1], expected[3])


def test_pointers_rest_at_the_last_token_of_a_component():
    rng = random.Random(8)
    for _ in range(200):
        size = rng.randrange(1, 60)
        ends = [sorted({size, *rng.sample(range(1, size + 1), rng.randrange(size))}) for _ in range(2)]
        rests = alignment.terminals(*map(np.array, ends)).tolist()
        shared = sorted(set(ends[0]) & set(ends[1]))
        for side, shift in ((0, 0), (1, len(ends[0]))):
            for place, end in enumerate(ends[side]):
                last = next(cut for cut in shared if cut >= end)
                assert rests[shift + place] == ends[0].index(last)
    # One long component: pointers need several rounds.
    odd, even = np.arange(1, 4000, 2), np.arange(2, 4001, 2)
    ends = np.append(odd, 4000), even
    assert set(alignment.terminals(*ends).tolist()) == {len(odd)}


def test_long_texts_go_slice_by_slice_with_the_same_result(aligner, monkeypatch):
    text = " ".join(odd_texts(400, 9)).replace("▁", "") + " and so on and on"
    whole = aligner.align(text)
    monkeypatch.setattr(alignment, "slices", lambda t: byte_pieces.slices(t, 200))
    cut = aligner.align(text)
    assert whole[0] > 1000 and whole[:2] == cut[:2] and whole[3] == cut[3]
    assert whole[2].tolist() == cut[2].tolist()


@pytest.mark.parametrize("block_chars", [1, 60, alignment.BLOCK_CHARS])
def test_aligned_rows_equal_brute_force_whatever_the_blocks(spark, plainly, monkeypatch, block_chars):
    monkeypatch.setattr(alignment.aligned, "__defaults__", (*alignment.aligned.__defaults__[:3], block_chars))
    rng = random.Random(10)
    texts = odd_texts(40, 11) + [" ".join(rng.choices(["the", "cat", "catalogue", "nouvelle", "42"], k=30)) for _ in range(30)]
    rows = list(enumerate(texts)) + [(2, texts[2]), (None, texts[50]), (None, None), (91, ""), (92, "▁ gone")]
    rows += [(93, "the cat sat on the mat " * 400)]
    each = [plainly(text) for _, text in rows]
    counts = Counter(pair for row in each for pair in row[2])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    expected = [
        (name, n_a, n_b, len(links), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), digest)
        for (name, _), (n_a, n_b, links, digest) in zip(rows, each)
    ]
    docs = documents(spark, rows, clash=True).repartition(3)
    found = alignment.align_tokens(docs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("n_pairs, width", [(0, 2), (1, 2), (65_535, 2), (65_537, 4)])
def test_links_move_as_bytes_no_wider_than_the_list_of_pairs_asks_for(n_pairs, width):
    pairs = np.arange(n_pairs, dtype=np.int64) * 3
    each = [pairs[:5], pairs, pairs[:0], pairs[-1:]]
    block = alignment._block(7, pa.array(range(4), pa.int64()), [(len(x), len(x), x, "") for x in each])
    assert [len(x) for x in block.column("links").to_pylist()] == [width * len(x) for x in each]
    assert block.column("n_links").to_pylist() == [len(x) for x in each]
    place = np.arange(n_pairs)
    looked_up = pa.table({"place": place, "count": place + 1, "best": place % 2 == 0})
    rows = pa.Table.from_batches([block]).drop_columns(["pairs", "times"])
    found = alignment._totals(rows, looked_up)
    assert found.column("count_sum").to_pylist() == [int((x // 3 + 1).sum()) for x in each]
    assert found.column("n_best").to_pylist() == [int((x // 3 % 2 == 0).sum()) for x in each]


def test_nothing_to_align(spark):
    assert alignment.align_tokens(documents(spark, [])).collect() == []
    rows = alignment.align_tokens(documents(spark, [(1, None), (2, "▁")])).collect()
    assert sorted(map(tuple, rows)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_the_three_queries_are_registered():
    assert {"op11_spelling_variants", "op12_token_counts", "op13_align_tokens"} <= set(QUERIES)
