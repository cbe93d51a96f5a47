"""Texts cut as a byte-level tokenizer cuts them, and the ids of the pieces."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from tidemark.llm.packing import _byte_letters

# Pieces that a worker remembers; beyond that it starts anew.
REMEMBERED = 200_000
# Code points of a text handled at a time.
SLICE = 1 << 20

_LETTER, _SPACE = "A-Za-zÀ-ÖØ-öø-ÿ", r"\t\n\r "
_MARK = r"!-/:-@\[-`{-~–—‘’“”…€"
# Texts of these characters alone are cut by the pattern below; their classes are the same in every
# release of Unicode. All others are cut by the tokenizer itself.
_PLAIN = re.compile(f"[{_SPACE}0-9{_LETTER}{_MARK}]*")
# Fixed rule: how the tokenizer cuts texts, written out for those characters.
_CUTS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[{_MARK}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# Fixed rule: the same for all characters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A space between two ASCII letters or digits: a piece always begins there.
_SAFE = re.compile("(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """The text in parts of about ``size`` code points, cut only where a piece begins anyway."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def is_plain(text: str) -> bool:
    """Whether all characters have the same class in every release of Unicode."""
    return _PLAIN.fullmatch(text) is not None


class BytePieces:
    """A byte-level tokenizer file, piece by piece.

    ``whole`` holds the vocabulary strings that encode alone as one token, with that token: each is
    put through the merges when the file is loaded, before any text. The tokens of a piece depend
    on the piece alone, so a piece found there needs no merging.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            whole_file = json.load(file)
        self.merges = whole_file["model"]["merges"]
        added = whole_file.get("added_tokens") or []
        if any(token.get(k) for token in added for k in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError("special strings that reach beyond themselves are not handled")
        self.added = {token["content"]: token["id"] for token in added}
        self._special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        tokenizer = Tokenizer.from_file(path)
        self.model, self.cutter = tokenizer.model, tokenizer.pre_tokenizer
        self.letters = _byte_letters()
        self.bytes_of = {letter: byte for byte, letter in self.letters.items()}
        self.vocabulary = {spelled: i for spelled, i in tokenizer.get_vocab(with_added_tokens=False).items()}
        self.whole = {}
        for spelled, token in self.vocabulary.items():
            if [found.id for found in self.model.tokenize(spelled)] == [token]:
                try:
                    self.whole[self.raw(spelled).decode()] = token
                except UnicodeDecodeError:
                    pass  # a piece of a text is never half a character

    def raw(self, spelled: str) -> bytes:
        """The bytes that a vocabulary string stands for."""
        return bytes(self.bytes_of[letter] for letter in spelled)

    def token_bytes(self) -> dict[int, bytes]:
        """The bytes of every token but the added ones."""
        return {token: self.raw(spelled) for spelled, token in self.vocabulary.items()}

    def merged_in_order(self) -> bool:
        """Whether the ids of merged tokens grow in the order of the merges."""
        pairs = (pair.split(" ") if isinstance(pair, str) else pair for pair in self.merges)
        ids = [self.vocabulary["".join(pair)] for pair in pairs]
        return all(low < high for low, high in zip(ids, ids[1:]))

    def plain_parts(self, text: str) -> list[str]:
        """The text between special strings."""
        return self._special.split(text)

    def cut(self, text: str) -> list[str]:
        """The pieces of a text whose special strings count as plain text."""
        if is_plain(text):
            return _CUTS.findall(text)
        return [text[low:high] for _, (low, high) in self.cutter.pre_tokenize_str(text)]

    def merge(self, piece: str) -> list[int]:
        """The ids of any piece by the tokenizer's merges."""
        spelled = piece.encode().decode("latin-1").translate(self.letters)
        return [token.id for token in self.model.tokenize(spelled)]

