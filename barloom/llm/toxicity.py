"""Toxicity of texts: misspelled lexicon terms found by Levenshtein automata, weighed by the words around them."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import only, pieces, worker_cache
from barloom.llm.shingles import shingle_sets
from barloom.llm.words import folded
from barloom.sources.tables import stage

STEMS = (3, 4, 5, 6, 7, 8)  # lengths of word beginnings that may stand for a family of words
SKETCH = 8  # smallest shingle hashes of a text
NEAR = 5  # letters from which a term may be misspelled once
NEARER = 9  # and twice
AROUND = 5  # words on either side of a hit
CACHED = 100_000  # distinct words whose matches a worker keeps
QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "‹": "›"}
QUOTED = -1.5  # log-odds of a hit between quotation marks, before any evidence
PRIOR = 10.0  # hits that this is worth
FEATURES = 4


def allowed(term: str) -> int:
    """How many edits a term of the lexicon may be away; a star marks the beginning of a word."""
    letters = len(term.rstrip("*"))
    if term.endswith("*"):
        return int(letters > NEAR)
    return 0 if letters < NEAR else 1 if letters < NEARER else 2


class Node(dict):
    """A node of the trie: its children by letter, the term that ends here, the most edits a term below allows."""

    term: str | None = None
    edits = 0


class Lexicon:
    """Terms in a trie, searched with the Levenshtein automaton of a word.

    A state of the automaton is a row of edit distances between the word's beginnings and the path to a
    trie node, of which only those near the diagonal matter. The walk goes down the trie while a distance
    is within what a term below allows, so it visits the intersection of both alone. A term that ends in a
    star stands for all words that begin with it: it matches where some beginning of the word is near.
    """

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.root = Node()
        for term in terms:
            node = self.root
            node.edits = max(node.edits, allowed(term))
            for letter in term.rstrip("*"):
                node = node.setdefault(letter, Node())
                node.edits = max(node.edits, allowed(term))
            # a word and a beginning may end at one node; the beginning stands for both
            node.term = max(filter(None, (node.term, term)), key=lambda t: t.endswith("*"))
        # of a longer word no other letters matter
        self.longest = max(map(len, terms), default=0) + 3
        self.found: dict[str, tuple[str, int] | None] = {}
        self._scanner = None

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its edits, the weightier of equally near ones; None if none is near enough."""
        word = word[: self.longest]
        if word in self.found:
            return self.found[word]
        best: tuple[int, float, str] | None = None
        size, far = len(word), 9
        todo = [(self.root, 0, list(range(size + 1)))]
        while todo:
            above, depth, row = todo.pop()
            for letter, node in above.items():
                next_row = [far] * (size + 1)
                if depth < node.edits:
                    next_row[0] = depth + 1
                least = next_row[0]
                for i in range(max(depth - node.edits, 0), min(depth + node.edits + 1, size)):
                    edits = min(row[i] + (word[i] != letter), row[i + 1] + 1, next_row[i] + 1)
                    next_row[i + 1] = edits
                    if edits < least:
                        least = edits
                if least > node.edits:
                    continue
                if node:
                    todo.append((node, depth + 1, next_row))
                if node.term:
                    edits = least if node.term[-1] == "*" else next_row[-1]
                    key = (edits, -self.terms[node.term], node.term)
                    if edits <= allowed(node.term) and (best is None or key < best):
                        best = key
        out = (best[2], best[0]) if best else None
        if len(self.found) >= CACHED:
            self.found.clear()
        self.found[word] = out
        return out

    def pieces(self) -> dict[str, list[int]]:
        """Parts of terms of which a matching word holds one, with the bounds of where it starts and of the word's size.

        With one part more than edits are allowed some part stays whole, and starts at most that many letters
        before or after its place.
        """
        out: dict[str, list[int]] = {}
        for term in self.terms:
            letters, edits = term.rstrip("*"), allowed(term)
            size = -(-len(letters) // (edits + 1))
            most = len(letters) + edits if letters == term else 1 << 40
            for at in range(0, len(letters), size):
                bounds = [max(at - edits, 0), at + edits, len(letters) - edits, most]
                held = out.setdefault(letters[at : at + size], bounds)
                out[letters[at : at + size]] = [min(held[0], bounds[0]), max(held[1], bounds[1]),
                                                min(held[2], bounds[2]), max(held[3], bounds[3])]
        return out

    def scanner(self):
        if self._scanner is None:
            self._scanner = ahocorasick.Automaton()
            for piece, bounds in self.pieces().items():
                raw = piece.encode().decode("latin-1")
                self._scanner.add_word(raw, (len(raw), *bounds))
            self._scanner.make_automaton()
        return self._scanner

    def hits(self, line: str) -> list[tuple[int, int, str, int]]:
        """``(start, end, term, edits)`` of the words that match, in a line of bytes as characters.

        One scan finds the words that hold a part of a term about where it belongs; only those are matched.
        """
        if not self.terms:
            return []
        out, done = [], 0
        for end, (size, low, high, least, most) in self.scanner().iter(line):
            at = end - size + 1
            if at < done:
                continue
            # a letter has four bytes at the most
            first = line.rfind(" ", max(at - 4 * high - 1, 0), at) + 1
            if not first or at - first < low:
                continue
            last = line.find(" ", end)
            word = line[first:last]
            # bounds count letters, of which a word has as many as bytes only in ASCII
            if (at - first > high or not least <= last - first <= most) and word.isascii():
                continue
            done = last
            found = self.match(word.encode("latin-1").decode("utf-8", "replace"))
            if found:
                out.append((first, last, *found))
        return out

    def __getstate__(self) -> dict:
        """Workers get the terms and build the rest."""
        return {"terms": self.terms}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["terms"])


def as_line(text: bytes) -> str:
    """Folded bytes of a lower-cased text as characters, a space before and after; byte i stands at i + 1."""
    return f" {folded(text).decode('latin-1')} "


def lowered(text: bytes | None) -> bytes:
    return (text or b"").decode("utf-8", "replace").lower().encode()


def around(line: str, first: int, last: int) -> list[str]:
    """The words near a hit."""
    return [*line[max(0, first - 120) : first].split()[-AROUND:], *line[last : last + 120].split()[:AROUND]]


def quoted(text: str) -> np.ndarray:
    """For each byte of a text whether it lies between quotation marks; a line that does not close one has none."""
    inside = np.zeros(len(text.encode()), dtype=bool)
    if not any(q in text for q in QUOTES):
        return inside
    at = 0
    for part in text.split("\n"):
        opened, close = -1, ""
        for letter in part:
            if opened >= 0 and letter == close:
                inside[opened:at] = True
                opened = -1
            elif opened < 0 and letter in QUOTES:
                opened, close = at, QUOTES[letter]
            at += len(letter.encode())
        at += 1
    return inside


def contexts(text: bytes, lexicon: Lexicon) -> list[tuple[str, int, list[str], bool]]:
    """``(term, edits, words around, quoted)`` of every hit of a text."""
    line = as_line(text)
    hits = lexicon.hits(line)
    if not hits:
        return []
    marks = quoted(text.decode("utf-8", "replace")) if any(q.encode() in text for q in QUOTES) else None
    return [(term, edits, around(line, first, last), bool(marks is not None and first - 1 < len(marks) and marks[first - 1]))
            for first, last, term, edits in hits]


class Toxicity:
    """The fitted scorer: what hits weigh, what their surroundings add, and a logistic head."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.near: dict[tuple[str, int], float] = {}
        self.words: dict[str, float] = {}
        self.quoted = QUOTED
        self.head = np.zeros(FEATURES + 1)

    def weight(self, term: str, edits: int) -> float:
        return self.near.get((term, edits), self.lexicon.terms[term] / (1 + edits))

    def hit(self, term: str, edits: int, near: list[str], in_quotes: bool) -> float:
        """Log-odds of abuse of one hit: its term, the window of words around it, and quotation."""
        window = sum(self.words.get(w, 0.0) for w in set(near))
        return self.weight(term, edits) + float(np.clip(window, -3, 3)) + (self.quoted if in_quotes else 0.0)

    def features(self, text: bytes | None) -> list[float]:
        """Numbers of a text: its hits' log-odds and how dense they are."""
        found = [self.hit(*c) for c in contexts(lowered(text), self.lexicon)]
        held = [h for h in found if h > 0]
        size = math.log1p(len(text or b""))
        return [min(sum(held), 30.0), max(held, default=0.0), min(len(held) * 1000 / (len(text or b"") + 200), 10.0), size]

    def fit(self, x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> Toxicity:
        """A logistic regression by Newton steps with a ridge.

        More or heavier hits never make a text look cleaner: a weight that comes out below zero is set to
        zero and the others are fitted again.
        """
        z = np.hstack([np.ones((len(x), 1)), x])
        free = np.ones(z.shape[1], dtype=bool)
        while True:
            w, ridge = np.zeros(z.shape[1]), np.array([1e-3, *[0.05] * (FEATURES - 1), 0.5])
            for _ in range(50):
                p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
                slope = (z.T @ (weights * (y - p)) - ridge * w)[free]
                curve = (z * (weights * p * (1 - p))[:, None]).T @ z + np.diag(ridge)
                step = np.linalg.solve(curve[np.ix_(free, free)], slope)
                w[free] += step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
            below = w < 0
            below[[0, -1]] = False
            if not below.any():
                break
            free &= ~below
        self.head = w
        return self

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts], dtype=np.float64).reshape(len(texts), FEATURES)
        z = np.hstack([np.ones((len(texts), 1)), x])
        return 1 / (1 + np.exp(-np.clip(z @ self.head, -30, 30)))


def tokens(text: bytes | None) -> set[str]:
    """A text's distinct words, and their beginnings marked by a star."""
    words = {w.decode("utf-8", "replace") for w in set(folded(lowered(text)).split())}
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, "text"):
        smallest = [s[:SKETCH].astype(np.int64) for s in shingle_sets(part.column("text").to_pylist(), 3)]
        yield pa.record_batch({"row": part.column("row"), "sketch": pa.array(smallest, pa.list_(pa.int64()))})


def _token_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, "text"):
        n, bad = Counter(), Counter()
        columns = [part.column("text").cast(pa.binary()).to_pylist(), *[part.column(c).to_pylist() for c in ("toxic", "weight")]]
        for text, toxic, weight in zip(*columns, strict=True):
            found = dict.fromkeys(tokens(text), weight)
            n.update(found)
            if toxic:
                bad.update(found)
        yield pa.record_batch({"token": pa.array(list(n), pa.string()), "n": pa.array(list(n.values()), pa.float64()),
                               "bad": pa.array([bad[t] for t in n], pa.float64())})


def labelled_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``(row, text, toxic, weight)`` of at most ``sample`` labelled documents outside the held-out third.

    They are chosen by hash of their doc_id; of rows that repeat a doc_id the one with the smallest hash
    of its text is taken, so the choice never changes. A text weighs one by the number of texts it shares
    content with: each of its smallest shingle hashes is counted over all sketches, and the median of
    these counts is the size of its group of copies. A passage that many texts share moves few of a
    text's hashes and leaves the median alone.
    """
    marks = (only(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
             .where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    chosen = stage(only(docs, "doc_id", "text").join(F.broadcast(marks), "doc_id")  # `sample` rows of two numbers
                   .withColumn("first", F.row_number().over(first)).where("first = 1")
                   .select(F.monotonically_increasing_id().alias("row"), "text", F.col("toxic").cast("int").alias("toxic")))
    sketches = stage(chosen.select("row", "text").mapInArrow(_sketches, "row long, sketch array<long>"))
    values = sketches.select("row", F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count("*").alias("n"))
    sizes = values.join(shared, "value").groupBy("row").agg(F.expr("percentile(n, 0.5)").alias("copies"))
    return stage(chosen.join(sizes, "row", "left").select(
        "row", "text", "toxic", (1 / F.greatest(F.coalesce("copies", F.lit(1.0)), F.lit(1.0))).alias("weight")))


def held_out(column: str):
    """Whether a doc_id lies in the third that no label is learned from; a null one does not."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = 20_000, lexicon_size: int = 4_000) -> Toxicity:
    """The scorer, from at most ``sample`` labelled documents (``labelled_rows``).

    Words and word beginnings that toxic texts have far more often than chance allows, with all of them
    tried, form the lexicon; a beginning is left out where a shorter one tells as much. Sums by token are
    taken in Spark. Then what a misspelling weighs, which words around a hit speak for or against abuse, and
    what quotation marks do are counted over the hits; all are shrunk, so what was hardly seen changes
    little. Numbers of the sampled texts, six for each, are fitted on the driver.
    """
    rows = labelled_rows(docs, labels, sample)
    total, bad = rows.agg(F.sum("weight"), F.sum(F.col("weight") * (F.col("toxic") > 0).cast("int"))).first()
    if not total or not bad or bad >= total:
        return Toxicity(Lexicon({})).fit(np.zeros((0, FEATURES)), np.zeros(0), np.zeros(0))
    rate = bad / total
    sums = stage(rows.mapInArrow(_token_sums, "token string, n double, bad double")
                 .groupBy("token").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where("bad >= 2 AND bad * 2 > n"))
    share = F.least(F.col("bad") / F.col("n"), F.lit(1.0))
    far = F.col("n") * (share * F.log(share / rate) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0))
    tried = max(rows.count() * 100, 1)
    top = (sums.withColumn("far", far).where(F.col("far") >= math.log(tried))
           .orderBy(F.desc("far"), "token").limit(lexicon_size).collect())
    prior = math.log(rate / (1 - rate))
    told = {r["token"]: (math.log((r["bad"] + 0.5) / (max(r["n"] - r["bad"], 0.0) + 0.5)) - prior, r["bad"]) for r in top}

    out = Toxicity(Lexicon(_terms(told)))
    # the sample's hits, and its numbers
    seen = rows.mapInArrow(_hits_of(out.lexicon), "toxic int, weight double, term string, edits int, near array<string>, quoted boolean")
    _weigh(out, seen, rate)
    numbers = rows.mapInArrow(_numbers_of(out), "toxic int, weight double, x array<double>").collect()
    x = np.array([r["x"] for r in numbers], dtype=np.float64).reshape(len(numbers), FEATURES)
    return out.fit(x, np.array([r["toxic"] > 0 for r in numbers], dtype=np.float64), np.array([r["weight"] for r in numbers]))


def _terms(told: dict[str, tuple[float, float]]) -> dict[str, float]:
    """The lexicon without what others in it say already; ``told`` has a weight and a count for each token.

    A beginning goes where one word makes up most of its count, as the word can be found misspelled, or
    where a shorter one that stays tells nearly as much; a word goes where such a beginning stays.
    """
    mostly = {s for word, (_, n) in told.items() if not word.endswith("*")
              for k in STEMS if (s := word[:k] + "*") in told and n >= 0.8 * told[s][1]}
    kept: dict[str, float] = {}
    for token in sorted(told, key=lambda t: (not t.endswith("*"), len(t), t)):
        stems = [token[:k] + "*" for k in STEMS if k < len(token.rstrip("*"))]
        if token not in mostly and not any(s in kept and kept[s] >= told[token][0] - 0.5 for s in stems):
            kept[token] = told[token][0]
    return kept


def _hits_of(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            out = defaultdict(list)
            texts = part.column("text").cast(pa.binary()).to_pylist()
            for text, toxic, weight in zip(texts, part.column("toxic").to_pylist(), part.column("weight").to_pylist(), strict=True):
                for term, edits, near, in_quotes in contexts(lowered(text), lexicon):
                    for name, v in (("toxic", toxic), ("weight", weight), ("term", term), ("edits", edits),
                                    ("near", near), ("quoted", in_quotes)):
                        out[name].append(v)
            kinds = {"toxic": pa.int32(), "weight": pa.float64(), "term": pa.string(), "edits": pa.int32(),
                     "near": pa.list_(pa.string()), "quoted": pa.bool_()}
            near = [[w.encode("latin-1").decode("utf-8", "replace") for w in words] for words in out["near"]]
            yield pa.record_batch({k: pa.array(near if k == "near" else out[k], t) for k, t in kinds.items()})

    return run


def _numbers_of(scorer: Toxicity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            x = [scorer.features(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
            yield pa.record_batch({"toxic": part.column("toxic"), "weight": part.column("weight"),
                                   "x": pa.array(x, pa.list_(pa.float64()))})

    return run


def _weigh(scorer: Toxicity, seen: DataFrame, rate: float, most: int = 4_000) -> None:
    """What edits, surrounding words and quotation marks say, from the hits of the labelled texts."""
    hits = stage(seen.withColumn("bad", F.col("weight") * (F.col("toxic") > 0).cast("int")))
    odds = math.log(rate / (1 - rate))
    # at most two rows for each term
    for r in hits.where("edits > 0").groupBy("term", "edits").agg(F.sum("weight").alias("n"), F.sum("bad").alias("bad")).collect():
        own = scorer.lexicon.terms[r["term"]] / (1 + r["edits"])
        told = math.log((r["bad"] + 0.5) / (max(r["n"] - r["bad"], 0.0) + 0.5)) - odds
        scorer.near[r["term"], r["edits"]] = (r["n"] * told + 2 * own) / (r["n"] + 2)
    # what its term lets expect of a hit, so that a word that only goes with a term or its language says nothing
    told = hits.groupBy("term", "edits").agg(((F.sum("bad") + rate) / (F.sum("weight") + 1)).alias("expected"))
    hits = stage(hits.join(told, ["term", "edits"]).withColumn("expected", F.col("expected") * F.col("weight")))
    sums = [F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("weight", "bad", "expected")]

    def odds_beyond(n: float, bad: float, expected: float) -> float:
        """Log-odds of abuse beyond what the terms tell, shrunk by the number of hits."""
        beyond = math.log((bad + 1) / (expected + 1)) - math.log((max(n - bad, 0.0) + 1) / (max(n - expected, 0.0) + 1))
        return beyond * n / (n + PRIOR)

    words = (hits.select("weight", "bad", "expected", F.explode(F.array_distinct("near")).alias("word"))
             .groupBy("word").agg(*sums).where("weight >= 5")
             .orderBy(F.desc(F.abs(F.col("bad") - F.col("expected"))), "word").limit(most).collect())
    scorer.words = {r["word"].encode().decode("latin-1"): odds_beyond(r["weight"], r["bad"], r["expected"]) for r in words}
    n, bad, expected = hits.where("quoted").agg(*sums).first()
    scorer.quoted = odds_beyond(n, bad, expected) + QUOTED * PRIOR / (n + PRIOR)


def toxicity(docs: DataFrame, labels: DataFrame, limit: float = 0.7, sample: int = 20_000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Words near a lexicon term, by edits or as members of a family of words that begin alike, are hits. A
    hit's weight comes from its term and edits, moved by the words around it and lowered between quotation
    marks; a text's score is a logistic function of its hits (``Toxicity``). The scorer is learned from labels
    of documents that are not held out; it sees texts alone. ``predicted`` is 1 from ``limit`` on.

    The lexicon is bounded and sent to the workers; the scan needs no shuffle. Null and empty texts
    score as texts without words. Labels repeated for a doc_id count as the worst of them, null labels and
    null doc_ids not at all. Without labels of both kinds nothing is learned and every score is one half.
    Every row is scored by itself and returned, also where doc_ids repeat; a null doc_id is not held out.
    Other columns are ignored. No rows give none.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(learn(docs, labels, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = worker_cache("toxicity")
        if held.get("of") is not sent:
            held["of"], held["scorer"] = sent, sent.value
        for part in pieces(batches, "text"):
            scores = held["scorer"].scores(part.column("text").cast(pa.binary()).to_pylist())
            yield pa.record_batch({"doc_id": part.column("doc_id").cast(pa.int64()), "held_out": part.column("held_out"),
                                   "score": pa.array(scores, pa.float64())})

    rows = only(docs, "doc_id", "text").withColumn("held_out", held_out("doc_id"))
    return rows.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= limit).cast("int"))
