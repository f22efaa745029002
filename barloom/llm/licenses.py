"""Licence notices and licence expressions in documents."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from barloom.llm.common import only, pieces, worker_cache
from barloom.llm.words import folded, joined, spaces

# Phrases of the contract and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Further notice phrases that the scanner knows, each in the words of a notice.
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "permission is hereby granted free of charge": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "boost software license": "bsl",
    "all rights reserved": "reserved",
    "gnu free documentation license": "gfdl",
    "gnu library general public license": "lgpl",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "microsoft public license": "ms-pl",
    "microsoft reciprocal license": "ms-rl",
    "artistic license": "artistic",
    "academic free license": "afl",
    "open software license": "osl",
    "isc license": "isc",
    "zlib license": "zlib",
    "python software foundation license": "psf",
    "the unlicense": "unlicense",
    "do what the fuck you want to public license": "wtfpl",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "sil open font license": "ofl",
    "open data commons open database license": "odbl",
    "business source license": "busl",
    "server side public license": "sspl",
    "elastic license": "elastic",
    "cc0 1 0 universal": "cc0",
    "creative commons public domain dedication": "cc0",
    "this software is provided as is without any express or implied warranty": "zlib",
    "redistributions of source code must retain the above copyright notice": "bsd",
    "the software is provided as is without warranty of any kind": "mit",
    "you may not use this file except in compliance with the license": "apache",
    "this program is free software you can redistribute it and or modify": "gpl",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}

TAG = "spdx license identifier"
_JOINTS = (b"-", b"_", b" ")
_COLON = re.compile(rb"[ \t]*:[ \t]*")
RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
          "labels array<string>, expressions array<string>, permissive boolean, score double")

_PERMISSIVE = re.compile(r"(mit|apache|bsd|isc|cc0|cc-by|unlicense|bsl|zlib|0bsd|wtfpl|python|psf)([-.+0-9]|clause)*")
_TOKEN = re.compile(r"[ \t]*(\(|\)|[A-Za-z0-9.+:-]+)")
_RANK = {"or": 1, "and": 2, "with": 3}


class Reader:
    """One pass over a licence expression by the shunting-yard method, which keeps the last whole one.

    ``with`` binds tighter than ``and``, ``and`` tighter than ``or``; all are left-associative. ``with`` stands
    between a single licence and the name of an exception. Whenever an expression could end, the length of the
    output and the operators still held, three at the most, are noted; so the longest expression at the
    beginning of a text is found without going back.
    """

    def __init__(self):
        self.out: list[str] = []
        self.held: list[str] = []
        self.depth = 0
        self.last = ""  # kind of the last token: "", "name", "exception", "close" or an operator
        self.whole: tuple[int, tuple[str, ...]] | None = None

    def take(self, token: str) -> bool:
        """Whether the token can go on the expression; it is taken if so."""
        low, ended = token.lower(), self.last in ("name", "exception", "close")
        if low in _RANK:
            if not ended or low == "with" and self.last != "name":
                return False
            while self.held and self.held[-1] != "(" and _RANK[self.held[-1]] >= _RANK[low]:
                self.out.append(self.held.pop())
            self.held.append(low)
            self.last = low
            return True
        if token == "(":
            if ended or self.last == "with":
                return False
            self.held.append(token)
            self.depth += 1
            self.last = "open"
            return True
        if token == ")":
            if not ended or not self.depth:
                return False
            while self.held[-1] != "(":
                self.out.append(self.held.pop())
            self.held.pop()
            self.depth -= 1
            self.last = "close"
        else:
            if ended:
                return False
            self.out.append(low)
            self.last = "exception" if self.last == "with" else "name"
        if not self.depth:
            self.whole = len(self.out), tuple(self.held)
        return True

    def postfix(self) -> list[str] | None:
        """The longest whole expression so far, in postfix order."""
        if self.whole is None:
            return None
        size, held = self.whole
        return self.out[:size] + list(reversed(held))


def parse_expression(text: str) -> list[str] | None:
    """A licence expression in postfix order; None if the text is not one as a whole."""
    found = read_tag(text, 0)
    return found[1] if found and found[0] == text.strip() else None


def evaluate(postfix: list[str]) -> tuple[list[str], bool]:
    """The licences named, and whether the whole may be used under permissive ones alone."""
    names: list[str] = []
    stack: list[bool] = []
    for token in postfix:
        if token not in _RANK:
            names.append(token)
            stack.append(bool(_PERMISSIVE.fullmatch(token)))
            continue
        right = stack.pop()
        if token == "with":  # the exception's name; it only adds permission
            names.pop()
        else:
            stack[-1] = (stack[-1] or right) if token == "or" else (stack[-1] and right)
    return names, stack[0]


def read_tag(text: str, at: int) -> tuple[str, list[str]] | None:
    """The longest expression that begins at a place of a text, on its line, and its postfix form.

    Full stops and the like at the end of a name are not part of it, and end the expression.
    """
    reader = Reader()
    begin = end = None
    while found := _TOKEN.match(text, at):
        token = found.group(1)
        name = token if token in "()" else token.rstrip(".:-")
        if not name or not reader.take(name):
            break
        at = found.start(1) + len(name)
        begin = found.start(1) if begin is None else begin
        if reader.whole and reader.last in ("name", "exception", "close") and not reader.depth:
            end = at
        if name != token:
            break
    return (text[begin:end], reader.postfix()) if end is not None else None


def _automaton() -> ahocorasick.Automaton:
    cache = worker_cache("licences")
    if "licences" not in cache:
        auto = ahocorasick.Automaton()
        for phrase in {*BASE_PHRASES, *NOTICE_PHRASES, TAG}:
            auto.add_word(f" {phrase} ", phrase)
        auto.make_automaton()
        cache["licences"] = auto
    return cache["licences"]


def _tag_ends(text: bytes, ends: list[int], line: str) -> Iterator[int]:
    """Bytes at which the expressions of tags begin, from where the automaton found the tags' words.

    The words of a tag are joined by single signs, and a colon follows.
    """
    gap = np.ones(len(text) + 2, dtype=bool)
    gap[1:-1] = np.frombuffer(folded(text), dtype=np.uint8) == 32
    turns = np.flatnonzero(gap[1:] != gap[:-1])
    starts, stops = turns[::2], turns[1::2]
    size = len(TAG.split())
    for word in np.searchsorted(spaces(line), ends):
        first = int(word) - size
        joints = [text[stops[i] : starts[i + 1]] for i in range(first, first + size - 1)]
        after = _COLON.match(text, int(stops[first + size - 1]))
        if after and all(j in _JOINTS for j in joints):
            yield after.end()


def scan(text: bytes | None, auto: ahocorasick.Automaton) -> tuple:
    words = folded(text).split()
    line = joined(words)
    base, labels, starts, tags = set(), set(), [], []
    for end, phrase in auto.iter(line):
        if phrase in BASE_PHRASES:
            base.add(BASE_PHRASES[phrase])
            starts.append(end - len(phrase) - 1)
        if phrase in NOTICE_PHRASES:
            labels.add(NOTICE_PHRASES[phrase])
        if phrase == TAG:
            tags.append(end)
    expressions, permissive = [], None
    if tags:
        # one character a byte, so that places hold; names are ASCII
        plain = text.decode("latin-1")
        for at in _tag_ends(text, tags, line):
            found = read_tag(plain, at)
            if found:
                names, allowed = evaluate(found[1])
                labels.update(names)
                expressions.append(found[0])
                permissive = allowed if permissive is None else permissive and allowed
    first = last = None
    if starts:
        places = np.searchsorted(spaces(line), [min(starts), max(starts)])
        first, last = int(places[0]), int(places[1])
    every = base | labels
    if permissive is None and every:
        permissive = all(_PERMISSIVE.fullmatch(x) for x in every)
    # how sure it is that the document states a licence: a tag is, phrases add up
    score = 1.0 if expressions else 1.0 - 0.5 ** (len(starts) + len(labels - base))
    return (len(words), len(starts), first, last, sorted(base), sorted(every), expressions, permissive, score)


def license_scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and what the scanner finds in each whole text.

    ``n_words``; ``n_base``, ``first_word`` and ``last_word``: number, smallest and largest start of the
    places where a base phrase's words stand consecutively (starts null without any); ``base_labels`` and
    ``labels``, the latter with those of further notice phrases and of identifier tags; ``expressions``:
    the tags' licence expressions as written; ``permissive``: whether they, else all labels, allow use
    under permissive licences alone (null without labels); ``score``: 0 without a find, 1 with a tag.

    One Aho-Corasick automaton finds phrases and tags, in one pass without a shuffle; a tag's expression
    is parsed by the shunting-yard method, in one pass, and every tag of a line counts. A tag whose
    expression cannot be read counts as no tag. Null
    and empty texts have no words. A null doc_id stays null; repeated rows are scanned each; other
    columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton()
        strings = pa.list_(pa.string())
        for part in pieces(batches, "text"):
            rows = [scan(t, auto) for t in part.column("text").cast(pa.binary()).to_pylist()]
            kinds = [pa.int64()] * 4 + [strings] * 3 + [pa.bool_(), pa.float64()]
            names = [f.split()[0] for f in RESULT.split(", ")]
            yield pa.record_batch({"doc_id": part.column("doc_id")} | {
                name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(zip(names, kinds, strict=True))})

    chosen = only(docs, "doc_id", "text")
    return chosen.mapInArrow(run, f"doc_id {dict(chosen.dtypes)['doc_id']}, {RESULT}")
