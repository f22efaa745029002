"""Quality and toxicity of documents: a document classifier with hierarchical empirical Bayes over sites."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import only, pieces
from barloom.llm.ngram_join import ngram_components
from barloom.llm.words import folded
from barloom.sources.tables import stage

UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = b"#&%*$!|<>{}[]~^=+_@\\/"
DIGITS = b"0123456789"
PREFIXES = (4, 5, 6)
STYLE = 8
HEADS = ("good", "toxic")
COPY = "0.5"  # Jaccard similarity of 3-word shingles from which texts are copies


def style(text: bytes, words: list[bytes], distinct: set[bytes]) -> list[float]:
    """How a text is written, in numbers."""
    size, n = max(len(text), 1), max(len(words), 1)
    return [
        math.log1p(len(words)),
        1 - len(text.translate(None, UPPER)) / size,
        1 - len(text.translate(None, SIGNS)) / size,
        1 - len(text.translate(None, DIGITS)) / size,
        len(distinct) / n,
        sum(map(eq, words, words[1:])) / n,
        min(size / n, 40.0),
        # distinct words of a natural text grow like a power of its length
        math.log((len(distinct) + 1) / (n + 1) ** 0.85),
    ]


def tokens(distinct: set[bytes]) -> set[bytes]:
    """Words, and their beginnings marked by a star."""
    return distinct | {w[:k] + b"*" for w in distinct for k in PREFIXES if len(w) > k}


class Evidence:
    """What a text says by itself: log-odds of being good and of being toxic."""

    def __init__(self, lexicon: dict[bytes, float]):
        self.lexicon = lexicon
        # every token begins with one of these, so most words need one look-up
        self.begins = {w.rstrip(b"*")[: PREFIXES[0]] for w in lexicon}
        self.mean = self.spread = None
        self.heads: dict[str, np.ndarray | float] = {}

    def features(self, text: bytes | None) -> list[float]:
        text = text or b""
        words = folded(text).split()
        distinct = set(words)
        found = {w for w in distinct if w[: PREFIXES[0]] in self.begins}
        weights = [max((self.lexicon[t] for t in tokens({w}) if t in self.lexicon), default=0.0) for w in found]
        hits = [w for w in weights if w]
        return [*style(text, words, distinct), min(sum(hits), 30.0), max(hits, default=0.0), math.log1p(len(hits))]

    def fit(self, x: np.ndarray, y: dict[str, np.ndarray]) -> Evidence:
        """One logistic regression for each head, by Newton steps with a ridge; NaN labels are left out."""
        self.mean = x.mean(axis=0) if len(x) else np.zeros(STYLE + 3)
        self.spread = (x.std(axis=0) if len(x) else np.ones(STYLE + 3)) + 1e-6
        z = np.hstack([np.ones((len(x), 1)), self.scaled(x)])
        for name, labels in y.items():
            known = ~np.isnan(labels)
            a, b = z[known], labels[known]
            if len(set(b.tolist())) < 2:  # nothing to learn from: whatever is not known to be bad passes
                self.heads[name] = 2.0 if name == "good" else -2.0
                continue
            w = np.zeros(a.shape[1])
            ridge = np.full(a.shape[1], 0.05)
            for _ in range(25):
                p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
                slope = a.T @ (b - p) - ridge * w
                curve = (a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge)
                step = np.linalg.solve(curve, slope)
                w += step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
            self.heads[name] = w
        return self

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8)

    def logits(self, texts: list[bytes | None]) -> dict[str, np.ndarray]:
        x = self.scaled(np.array([self.features(t) for t in texts]).reshape(len(texts), STYLE + 3))
        z = np.hstack([np.ones((len(texts), 1)), x])
        return {name: np.clip(z @ w, -12, 12) if isinstance(w, np.ndarray) else np.full(len(texts), w)
                for name, w in self.heads.items()}


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, "text"):
        n, bad = Counter(), Counter()
        columns = [part.column("text").cast(pa.binary()).to_pylist(), *[part.column(c).to_pylist() for c in ("toxic", "copies")]]
        for text, toxic, copies in zip(*columns, strict=True):
            found = [(t, copies) for t in tokens(set(folded(text).split()))]
            n.update(found)
            if toxic:
                bad.update(found)
        yield pa.record_batch({"token": pa.array([t for t, _ in n], pa.binary()), "copies": pa.array([c for _, c in n], pa.int64()),
                               "n": pa.array(list(n.values()), pa.int64()), "bad": pa.array([bad[t] for t in n], pa.int64())})


def learn(docs: DataFrame, labels: DataFrame, sample: int = 20_000, lexicon_size: int = 4_000) -> Evidence:
    """The document classifier, from at most ``sample`` labelled documents, chosen by hash of their doc_id.

    Of labelled rows that repeat a doc_id the one with the smallest hash of its text is taken.

    Tokens that toxic documents have far more often than chance allows, with all tokens tried (divergence
    of counts from the common rate), form a lexicon of at most ``lexicon_size``. Counts are grouped by
    token in Spark. A group of copies counts once for each token that one of them has, as the words of a
    text copied many times would all seem telling; it counts as toxic where most of those that have the
    token are. Copies are documents that links of Jaccard similarity ``COPY`` or more join. Numbers about style and lexicon hits, at most ``sample`` rows of eleven, are fitted on the driver.
    """
    marks = (only(labels, "doc_id", "quality", "toxic").where("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    # at most `sample` rows of three numbers; of rows that repeat a doc_id the one with the smallest hash of its text
    chosen = stage(only(docs, "doc_id", "text").join(F.broadcast(marks), "doc_id")
                   .withColumn("first", F.row_number().over(first)).where("first = 1").drop("first")
                   .withColumn("row", F.monotonically_increasing_id()))
    size, bad = chosen.where("toxic IS NOT NULL").agg(F.count("*"), F.sum("toxic")).first()
    lexicon: dict[bytes, float] = {}
    if size and bad and bad < size:
        rate = bad / size
        known_toxic = chosen.where("toxic IS NOT NULL").select("row", "text", "toxic")
        found = stage(ngram_components(known_toxic.select(F.col("row").alias("doc_id"), "text"), 3, COPY))
        several = found.groupBy("component_id").count().where("count > 1").select("component_id")
        # at most `sample` rows of two numbers
        copies = found.join(several, "component_id").select(F.col("doc_id").alias("row"), F.col("component_id").alias("copies"))
        alone = F.col("copies").isNull()
        counts = stage(known_toxic.join(F.broadcast(copies), "row", "left").select("text", "toxic", "copies")
                       .mapInArrow(_token_counts, "token binary, copies long, n long, bad long")
                       .groupBy("token", "copies").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
                       .select("token", F.when(alone, F.col("n")).otherwise(1).alias("n"),
                               F.when(alone, F.col("bad")).otherwise((F.col("bad") * 2 > F.col("n")).cast("long")).alias("bad"))
                       .groupBy("token").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where("n >= 4"))
        share = F.col("bad") / F.col("n")
        far = F.col("n") * (share * F.log(share / rate) + F.when(F.col("bad") < F.col("n"), (1 - share) * F.log(
            (1 - share) / (1 - rate))).otherwise(0.0))
        tried = counts.count()
        top = (counts.where("bad * 2 > n").withColumn("far", far).where(F.col("far") >= math.log(2 * max(tried, 1)))
               .orderBy(F.desc("far"), "token").limit(lexicon_size).collect())
        prior = math.log(rate / (1 - rate))
        lexicon = {bytes(r["token"]): math.log((r["bad"] + 0.5) / (r["n"] - r["bad"] + 0.5)) - prior for r in top}
    out = Evidence(lexicon)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            x = [out.features(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
            yield pa.record_batch({"quality": part.column("quality").cast(pa.float64()),
                                   "toxic": part.column("toxic").cast(pa.float64()),
                                   "x": pa.array(x, pa.list_(pa.float64()))})

    rows = chosen.mapInArrow(numbers, "quality double, toxic double, x array<double>").collect()
    x = np.array([r["x"] for r in rows], dtype=np.float64).reshape(len(rows), STYLE + 3)

    def known(name: str) -> np.ndarray:
        return np.array([np.nan if r[name] is None else r[name] for r in rows], dtype=np.float64)

    return out.fit(x, {"good": known("quality"), "toxic": known("toxic")})


def _logit(p: Column) -> Column:
    held = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(held / (1 - held))


def _strength(sites: DataFrame, n: str, total: str, prior: Column) -> float:
    """How many documents the prior of a site is worth, by the method of moments.

    What the sites' rates vary around their priors, beyond what their sizes explain, gives the strength:
    sites that hardly differ shrink to the prior, sites that differ keep their own rates.
    """
    row = sites.agg(F.sum(F.col(n) * (F.col(total) / F.col(n) - prior) ** 2).alias("seen"),
                    F.sum(prior * (1 - prior)).alias("by_size"), F.sum(F.col(n)).alias("n"),
                    F.sum(F.col(n) * prior * (1 - prior)).alias("within")).first()
    if not row["n"] or not row["within"]:
        return 1e6
    between = max((row["seen"] - row["by_size"]) / row["n"], 1e-9)
    return float(min(max(row["within"] / row["n"] / between - 1, 1.0), 1e6))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
             keep: tuple[str, ...] = ("doc_id",), site_weight: float = 0.5, sample: int = 20_000) -> DataFrame:
    """The columns ``keep`` of every document with ``p_good``, ``p_toxic``, ``host_good``, ``host_toxic`` and ``accepted``.

    A classifier fitted to labelled documents (``learn``) gives each text's evidence. Its probabilities
    are summed by host and by path, in one grouped aggregation; a host's rate is shrunk to the rate of all
    documents and a path's rate to its host's, the more the fewer documents it has. A document's site rate
    leaves out the document itself. Its log-odds are those of the text plus ``site_weight`` times those of
    its site against all documents; ``accepted`` means good with 0.5 or more and toxic with less.
    ``host_good`` and ``host_toxic`` are the shrunk rates of the whole host.

    Hosts are the values of the column ``host``, paths those of ``path`` within a host; null is a value of
    its own. Texts are scored twice, once for the sums and once for the result, so that nothing but sums
    by path is stored; a site with a third of all rows is one row in each task's sums.

    Without labels of both kinds a classifier passes everything. Labels repeated for a doc_id count as the
    worst of them, null labels not at all. Null and empty texts are scored as texts without words. A null
    doc_id is scored like any other; repeated rows are scored each and returned each. Columns of the
    input that are named like a result are not passed on. No rows give none.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(learn(docs, labels, sample))
    results = ("p_good", "p_toxic", "host_good", "host_toxic", "accepted")
    keep = tuple(c for c in dict.fromkeys(keep) if c not in results)

    def scores(names: list[str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in pieces(batches, "text"):
                logits = sent.value.logits(part.column("text").cast(pa.binary()).to_pylist())
                yield pa.record_batch({c: part.column(c) for c in names} | {
                    f"__{h}": pa.array(logits[h], pa.float64()) for h in HEADS})
        return run

    def scored(*columns: str) -> DataFrame:
        chosen = only(docs, *dict.fromkeys((*columns, host, path, "text")))
        sited = chosen.withColumns({
            c: F.coalesce(F.concat(F.lit("="), F.col(of).cast("string")), F.lit("null"))
            for c, of in (("__host", host), ("__path", path))})
        names = [*columns, "__host", "__path"]
        schema = ", ".join(f"`{c}` {t}" for c, t in sited.dtypes if c in names)
        ordered = [c for c, _ in sited.dtypes if c in names]
        return sited.mapInArrow(scores(ordered), f"{schema}, __good double, __toxic double")

    def chance(logit: str) -> Column:
        return 1 / (1 + F.exp(-F.col(logit)))

    sums = stage(scored().groupBy("__host", "__path").agg(
        F.count("*").alias("n"), *[F.sum(chance(f"__{h}")).alias(h) for h in HEADS]))
    whole = sums.agg(F.sum("n").alias("n"), *[F.sum(h).alias(h) for h in HEADS]).first()
    hosts = sums.groupBy("__host").agg(F.sum("n").alias("host_n"), *[F.sum(h).alias(f"host_sum_{h}") for h in HEADS])
    sites = stage(sums.join(hosts, "__host"))
    held = []
    for h in HEADS:
        rate = (whole[h] or 0.0) / (whole["n"] or 1)
        strong = _strength(hosts, "host_n", f"host_sum_{h}", F.lit(rate))
        of_host = (strong * rate + F.col(f"host_sum_{h}")) / (strong + F.col("host_n"))
        held.append((h, rate, strong, _strength(sites, "n", h, of_host), of_host))

    joined = scored(*keep).join(sites, ["__host", "__path"])
    out = {}
    for h, rate, strong, strong_path, of_host in held:
        own = chance(f"__{h}")
        around = (strong * rate + F.col(f"host_sum_{h}") - own) / (strong + F.col("host_n") - 1)
        near = (strong_path * around + F.col(h) - own) / (strong_path + F.col("n") - 1)
        out[f"p_{h}"] = 1 / (1 + F.exp(-(F.col(f"__{h}") + site_weight * (_logit(near) - _logit(F.lit(rate))))))
        out[f"host_{h}"] = of_host
    return joined.select(*keep, *[c.alias(n) for n, c in out.items()]).withColumn(
        "accepted", (F.col("p_good") >= 0.5) & (F.col("p_toxic") < 0.5))
