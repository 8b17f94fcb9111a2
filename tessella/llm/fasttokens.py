"""Token ids of whole texts, equal to the tokenizers library's, with a cache of pieces.

Byte-level BPE never merges across the pieces that the pre-tokenizer cuts, so a text's ids are
those of its pieces in order.  Pieces are cut here by the tokenizer file's own pattern, with its
classes spelled out for :mod:`re`, and their ids come from the library's BPE model once and then
from a bounded cache.  That holds for texts of characters whose Unicode classes have long been
settled (:data:`SETTLED`); texts with other characters, with strings of special tokens, or
tokenizer files of other kinds go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

from tokenizers import Tokenizer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # each task has one core

#: Characters whose class, case and composition agree in all Unicode versions in use.
SETTLED = re.compile("[\t\n\r -~¡-¬®-ÿĀ-įĲ-ň‐-‧€А-яぁ-ゖァ-ヺ一-龥]*")
#: What the patterns' classes are among those characters.
CLASSES = {r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ÿĀ-įĲ-ňА-яぁ-ゖァ-ヺ一-龥", r"\p{N}": "0-9²³¹¼-¾", r"\s": r"\t\n\r "}
#: The byte-level pattern that files without one of their own use.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces kept at most, and the longest piece that is kept.
MOST_PIECES, LONGEST_PIECE = 500_000, 64


def _spelled(pattern: str) -> re.Pattern:
    """The pattern with its classes spelled out, inside brackets and outside."""
    alone = re.sub(r"(\[[^\]]*\])|(\\p\{[LN]\}|\\s|\\S)", lambda m: m[1] or {r"\S": "[^" + CLASSES[r"\s"] + "]"}.get(m[2]) or f"[{CLASSES[m[2]]}]", pattern)
    for name, inside in CLASSES.items():
        alone = alone.replace(name, inside)
    return re.compile(alone)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in prints else next(spare)) for b in range(256)]


def _pattern(spec: dict) -> tuple[str, bool] | None:
    """The pattern of pieces and whether texts are lower-cased; None for other kinds of files."""
    before, pre = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or spec.get("truncation") or spec.get("padding"):
        return None
    if before is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return BYTE_LEVEL, False
    steps = [x["type"] for x in (before or {}).get("normalizers", [])]
    parts = pre.get("pretokenizers", [])
    if steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in parts] == ["Split", "ByteLevel"] and parts[0]["behavior"] == "Removed" and parts[0]["invert"]:
        return parts[0]["pattern"]["Regex"], True
    return None


class PieceTokenizer:
    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        found = _pattern(spec)
        self.special = tuple(x["content"] for x in spec.get("added_tokens", []))
        self.cut = _spelled(found[0]) if found else None
        self.lower = bool(found and found[1])
        self.letters = _byte_letters()
        self.model = self.library.model
        self.cache: dict[str, bytes] = {}

    def settled(self, text: str) -> bool:
        return self.cut is not None and SETTLED.fullmatch(text) is not None and not any(s in text for s in self.special)

    def _encode(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece, by the library's model alone."""
        plain = piece if piece.isascii() and piece.isalnum() else "".join(map(self.letters.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.model.tokenize(plain)]).tobytes()

    def pieces_ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        cache = self.cache
        try:
            return list(map(cache.__getitem__, pieces))
        except KeyError:
            pass
        if len(cache) > MOST_PIECES:
            cache.clear()
        own = {p: self._piece(p) for p in set(pieces) if p not in cache}
        cache.update((p, b) for p, b in own.items() if len(p) <= LONGEST_PIECE)
        return [own[p] if p in own else cache[p] for p in pieces]

    def ids(self, text: str) -> bytes:
        """Ids of the whole text as little-endian unsigned 32-bit integers."""
        if not self.settled(text):
            return self._encode(text)
        return b"".join(self.pieces_ids(self.cut.findall(text.lower() if self.lower else text)))

    def pieces(self, text: str) -> tuple[list[int], list[int]]:
        """Where the pieces of ``text`` begin, and how many tokens each has."""
        if self.settled(text):
            found = [(m.start(), m[0]) for m in self.cut.finditer(text.lower() if self.lower else text)]
            return [x[0] for x in found], [len(b) // 4 for b in self.pieces_ids([x[1] for x in found])]
        encoded = self.library.encode(text, add_special_tokens=False)
        starts, counts, last = [], [], object()
        for word, (start, _) in zip(encoded.word_ids, encoded.offsets, strict=True):
            if word is None or word != last:
                starts.append(start)
                counts.append(0)
            counts[-1] += 1
            last = word
        return starts, counts


_loaded: dict[str, PieceTokenizer] = {}


def load(path: str) -> PieceTokenizer:
    """The tokenizer of ``path``, kept for the life of the worker process."""
    if path not in _loaded:
        _loaded.clear()
        _loaded[path] = PieceTokenizer(path)
    return _loaded[path]
