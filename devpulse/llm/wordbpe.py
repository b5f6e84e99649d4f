"""Text preparation and vocabulary of a word-level BPE file (tokenizers JSON, ``</w>`` word ends).

Shared by the BPE, packing and token-count operators. A text is cut at the
special strings of the file (matched on the raw text), normalised (NFC, lower
case per code point) and split into words by the file's pattern; white space
never reaches a word. Letter classes, NFC and lower case are the library's,
whose Unicode version is another than Python's: Python's own functions serve
texts without code points on which the two differ. The pieces of a text are encoded independently, so a
task only has to encode each distinct word once: callers keep a bounded
``word -> ids`` table per Python worker.

The vocabulary file is read on the executors from the path given, which must
exist on every node (it belongs to an installed package).
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache

from tokenizers import Regex, normalizers, pre_tokenizers

SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SEPARATORS = re.compile("[\x1c-\x1f]")
END = "</w>"


#: No letters or digits lie from here on: unassigned planes, tags, variation selectors, private use.
LAST_LETTERS = 0x40000


def _char_class(major: str, end: int = LAST_LETTERS) -> str:
    """The code points of a general category as the inside of a character class.

    Asked from the tokenizer library's own regular expressions: its Unicode
    version decides, and Python's is another.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, end)]))
    split = pre_tokenizers.Split(Regex(rf"\p{{{major}}}+"), "removed", invert=True)
    return "".join(f"\\U{ord(t[0]):08x}-\\U{ord(t[-1]):08x}" for t, _ in split.pre_tokenize_str(every))


SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
ASCII_WORDS = re.compile(rf"{SHORT}|[a-z]+|[0-9]|[^\s a-z0-9]+", re.ASCII)


@lru_cache(1)
def _all_words() -> re.Pattern:
    letters, digits = _char_class("L"), _char_class("N")
    return re.compile(f"{SHORT}|[{letters}]+|[{digits}]|[^{SPACE}{letters}{digits}]+")


_NFC, _LOWER = normalizers.NFC(), normalizers.Lowercase()
#: Where scripts with case or combining marks lie: the first two planes without ideographs, Hangul syllables,
#: surrogates and private use.
SCRIPTS = ((0, 0x3400), (0xA000, 0xAC00), (0xF900, 0x12000), (0x16000, 0x17000), (0x1BC00, 0x20000))


@lru_cache(1)
def unlike() -> tuple[re.Pattern, frozenset[str], dict[str, str]]:
    """Code points on which the library's NFC or lower case may differ from Python's, what finds a text that may
    hold one (a range, which is quick), and their lower case.

    NFC may differ on a code point that one of the two decomposes otherwise, on what it is composed with, and on
    one whose combining class only one of them knows.
    """
    every = [chr(c) for a, b in SCRIPTS for c in range(a, b) if c != 10]

    def both(library: normalizers.Normalizer, form: str, frame: str) -> zip:
        text = "\n".join(map(frame.format, every))
        return zip(every, library.normalize_str(text).split("\n"), unicodedata.normalize(form, text).split("\n"))

    lower = {c: low for c, low in zip(every, _LOWER.normalize_str("\n".join(every)).split("\n")) if low != c.lower()}
    odd = {x for c, a, b in both(normalizers.NFD(), "NFD", "{}") if a != b for x in (c, a[-1], b[-1])}
    # Marks of classes 240 and 1 beside it: a code point with a combining class changes places with one of them.
    for frame in ("a\u0345{}", "a{}\u0334"):
        odd.update(c for c, a, b in both(_NFC, "NFC", frame) if a != b)
    odd = frozenset(odd.union(lower))
    return re.compile(f"[{min(odd)}-\U0010ffff]"), odd, lower


def _python_serves(text: str) -> bool:
    beyond, odd, _ = unlike()
    return beyond.search(text) is None or odd.isdisjoint(text)


def nfc(text: str) -> str:
    if text.isascii():
        return text
    return unicodedata.normalize("NFC", text) if _python_serves(text) else _NFC.normalize_str(text)


def lower_of(c: str) -> str:
    """Lower case of one code point."""
    return unlike()[2].get(c) or c.lower()


def normalise(text: str) -> str:
    """NFC, then lower case code point by code point (no final-sigma rule)."""
    if text.isascii():
        return text.lower()
    if not _python_serves(text):
        return _LOWER.normalize_str(_NFC.normalize_str(text))
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def split_normal(text: str) -> list[str]:
    """Words of an already normalised text without special strings."""
    if text.isalpha():
        return [text]
    return (ASCII_WORDS if text.isascii() else _all_words()).findall(text)


def chunks_of(text: str) -> list[str]:
    """The stretches between white space of a normalised text; words never cross them.

    ``str.split`` also splits at four control characters that the file's
    pattern takes as symbols: such a text stays whole.
    """
    return [text] if SEPARATORS.search(text) else text.split()


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in kept:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


class Vocabulary:
    """Vocabulary, ordered merges and special strings of one file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.merges: list[tuple[str, str]] = [tuple(m) if isinstance(m, list) else tuple(m.split(" "))
                                              for m in model["merges"]]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        #: Special strings as ``chunks`` gives them: the capital keeps them apart from every normalised text.
        self.marked: dict[str, int] = {"S" + s: i for s, i in self.special.items()}
        #: Special strings as ``spaced`` gives them, free of white space.
        self.stand_ins: dict[str, int] = {f"S{i}": i for i in self.special.values()}
        self.letters = byte_letters()
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def spaced(self, text: str) -> str:
        """The normalised text, special strings as ``stand_ins`` between spaces.

        Cut at ASCII white space, it gives the special strings and stretches that no word crosses.
        """
        if self.special_pattern is None or not any(s in text for s in self.special):
            return normalise(text)
        return " ".join(f"S{self.special[p]}" if p in self.special else normalise(p)
                        for p in self.special_pattern.split(text))

    def chunks(self, text: str) -> list[str]:
        """The white-space-free chunks and the special strings (as ``marked``) of a raw text, in order."""
        if self.special_pattern is None or not any(s in text for s in self.special):
            return chunks_of(normalise(text))
        out: list[str] = []
        for piece in self.special_pattern.split(text):
            if piece in self.special:
                out.append("S" + piece)
            elif piece:
                out += chunks_of(normalise(piece))
        return out


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)
