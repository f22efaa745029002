"""Tokenizing by the units that a byte-pair tokenizer cannot merge across.

A process encodes every distinct unit once with the tokenizer itself and keeps the result in a bounded
cache; texts of natural language repeat their words, so most units are found there.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from collections.abc import Callable

from barloom.llm.common import worker_cache

CACHED = 150_000  # units, found again by one look-up
PARTS = 400_000  # parts of units, each costs an encoding
ID_CODES = {"<u2": "H", "<u4": "I"}
SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# the public byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
# letters, then other ASCII signs: pre-tokenizers of this family always part the two
_PARTS = re.compile(r"(\s?[^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")


def load(path: str):
    """The tokenizer of a file, loaded once in a process."""
    cache = worker_cache("units")
    if ("tokenizer", path) not in cache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        cache["tokenizer", path] = Tokenizer.from_file(path)
    return cache["tokenizer", path]


def _letters(text: str) -> bool:
    """Whether these are letters, and stay so when they are normalised or lower-cased."""
    return text.isalpha() and (text.isascii() or unicodedata.normalize("NFC", text).lower().isalpha())


class Units(dict):
    """``units[text]``: what ``fold`` makes of the ids of a unit.

    Letters followed by signs are looked up as two units, added by ``+``. The cache starts anew when it
    is full, so memory is bounded and results never change.
    """

    def __init__(self, path: str, fold: Callable[[list[int]], object], fold_case: bool):
        super().__init__()
        self.tokenizer, self.fold, self.fold_case = load(path), fold, fold_case
        self.parts: dict[str, object] = {}

    def encode(self, text: str):
        return self.fold(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def part(self, text: str):
        if self.fold_case and text.isascii():
            text = text.lower()
        found = self.parts.get(text)
        if found is None:
            if len(self.parts) >= PARTS:
                self.parts.clear()
            found = self.parts[text] = self.encode(text)
        return found

    def __missing__(self, text: str):
        whole = _PARTS.fullmatch(text)
        if whole and _letters(whole.group(1).strip()):
            found = self.part(whole.group(1)) + self.part(whole.group(2))
        elif _letters(text.strip()):
            found = self.part(text)
        else:
            found = self.encode(text)
        if len(self) >= CACHED:
            self.clear()
        self[text] = found
        return found


def units(path: str, name: str, fold: Callable[[list[int]], object], fold_case: bool) -> Units:
    """The process's cache for one tokenizer and use."""
    cache = worker_cache("units")
    if (name, path) not in cache:
        cache[name, path] = Units(path, fold, fold_case)
    return cache[name, path]


class WordIds(dict):
    """``ids[word]``: the ids of a word between white space, as bytes, for tokenizers that drop white space.

    A word that is not known is encoded. Letters followed by signs are looked up as their two parts and not kept
    themselves, so the table's places are left to words that cost an encoding.
    A full table becomes the older one of two generations, from which words are taken over as they are met
    again; so memory is bounded, frequent words stay, and results never change.
    """

    MOST = 150_000  # words of a generation

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = load(path)
        self.width = id_type(path)
        self.older: dict[bytes, bytes] = {}
        self.model = self.tokenizer.model if _takes_letters(path) else None

    def encode(self, text: str) -> bytes:
        """Ids of a word; a run of common letters goes straight to the model, in the form it would get there."""
        if self.model is not None and text.isalpha() and (text.isascii() or max(text) < "\u0250" and "\u0130" not in text):
            text = text.lower()
            if not text.isascii():
                text = text.encode().decode("latin-1").translate(BYTE_LETTERS)
            found = [t.id for t in self.model.tokenize(text)]
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}{ID_CODES[self.width]}", *found)

    def __missing__(self, word: bytes) -> bytes:
        letters = word.rstrip(SIGNS)
        if len(letters) < len(word) and _letters(letters.decode()):
            return self[letters] + self[word[len(letters):]]
        found = self.older.get(word)
        if found is None:
            found = self.encode(word.decode())
        if len(self) >= self.MOST:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


def _takes_letters(path: str) -> bool:
    """Whether a tokenizer hands runs of letters to a byte-level model as they are, lower-cased, one run a word."""
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    steps = [n.get("type") for n in (config.get("normalizer") or {}).get("normalizers", [])]
    cuts = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (config["model"].get("type") == "BPE" and steps == ["NFC", "Replace", "Lowercase"]
            and [c.get("type") for c in cuts] == ["Split", "ByteLevel"] and not cuts[1].get("add_prefix_space")
            and not cuts[1].get("use_regex") and "|[\\p{L}]+|" in cuts[0].get("pattern", {}).get("Regex", ""))


def id_type(path: str) -> str:
    """The smallest type that holds every id of a tokenizer."""
    return "<u2" if load(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def word_ids(path: str) -> WordIds:
    """The process's table of one tokenizer."""
    cache = worker_cache("units")
    if ("words", path) not in cache:
        cache["words", path] = WordIds(path)
    return cache["words", path]
