"""The text operators against brute force, on small tables with nulls, ties, copies and clashing columns."""

import os
import random
import time
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import extract, lattice, licenses, ngram_join, quality, tokens, units, urls
from barloom.llm.decontam import benchmark_hits
from barloom.llm.lines import dedup_lines
from barloom.llm.packing import pack
from barloom.llm.queries import ORACLES, REGISTRY, RULES
from barloom.llm.units import load
from barloom.sources.tables import stage

SF = "/root/testdata/sf0.001"
os.environ["TOKENIZERS_PARALLELISM"] = "false"


def vocabulary(name):
    return pytest.importorskip("public_tokenizers").path(name)


@pytest.fixture
def docs(spark):
    """Texts with an extra column that clashes in case and one named like a result."""
    def build(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "de", f"s{n % 3}" if n % 5 else None, "x", 1) for n, (i, t) in enumerate(zip(ids, texts, strict=True))]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, TEXT string, n_words int")
    return build


ODD = [None, "", " ", "\n\n", "one", "one", "a b", "É é", "漢 字 " * 50, "word " * 5000, "x" * 40_000]


# --- n-gram join ----------------------------------------------------------

def near_texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(2000)]
    out = []
    base = [rng.choice(words) for _ in range(100)]
    for _ in range(45):  # a star of copies, more than one sparse column holds
        copy = list(base)
        for _ in range(rng.choice((0, 1, 3))):
            copy[rng.randrange(100)] = rng.choice(words)
        out.append(" ".join(copy))
    for _ in range(20):  # a chain
        base = list(base)
        base[rng.randrange(100)] = rng.choice(words)
        out.append(" ".join(base))
    shared = [rng.choice(words) for _ in range(25)]
    out += [" ".join(shared + [rng.choice(words) for _ in range(rng.choice((2, 30)))]) for _ in range(40)]
    return out + ODD


def components_of(texts, k, least):
    sets = []
    for t in texts:
        w = (t or "").lower().split() if (t or "").isascii() else (t or "").split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    group = list(range(len(texts)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and len(a & b) >= least * len(a | b):
                x, y = top(i), top(j)
                group[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in enumerate(sets)}


@pytest.mark.parametrize("sparse, tile", [(16, 1024), (3, 8)])
def test_ngram_components(docs, monkeypatch, sparse, tile):
    monkeypatch.setattr(ngram_join, "SPARSE", sparse)
    monkeypatch.setattr(ngram_join, "TILE_ROWS", tile)
    texts = near_texts()
    got = ngram_join.ngram_components(docs(texts).repartition(3), 3, "0.9").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components_of(texts, 3, Fraction(9, 10))


def test_ngram_components_of_odd_ids(docs):
    got = ngram_join.ngram_components(docs(["a b c", "a b c", "q r s", "q r s t", "z"], [None, 4, None, 7, 7])).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [
        ("4", "4"), ("7", "7"), ("7", "7"), ("None", "4"), ("None", "None")]


@pytest.mark.parametrize("n", [*range(1, 60), 300, 1001])
def test_bounds_lose_no_partner(n):
    for least in (Fraction(9, 10), Fraction(4, 5)):
        width, shared, dropped, fewest = ngram_join.bounds(n, least)
        assert 1 <= shared <= width <= n and dropped < shared
        for m in range(-(-least.numerator * n // least.denominator), n * least.denominator // least.numerator + 1):
            other = ngram_join.bounds(m, least)
            # the least overlap that reaches the similarity
            overlap = next(o for o in range(1, m + n) if o >= least * (n + m - o))
            assert overlap >= max(n - width + shared, m - other[0] + other[1])
            assert min(shared, other[1]) - max(dropped, other[2]) >= min(fewest, other[3]) or overlap > min(n, m)


# --- quality --------------------------------------------------------------

def test_classifier_on_held_out_documents(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(400)]
    rows, labels = [], []
    for i in range(600):
        text = rng.choices(words, k=rng.randint(15, 60))
        kind = i % 6
        if kind == 0:
            text[rng.randrange(len(text))] = rng.choice(("zounds", "zoundsy", "zoundsish"))
        if kind == 1:
            text = [w + "###" for w in text]
        rows.append((i, " ".join(text), "en", f"site{i % 7}"))
        if i < 400:
            labels.append((i, int(kind != 1), int(kind == 0)))
    table = spark.createDataFrame([*rows, (None, None, None, None), (1000, "", "en", "site1")],
                                  "doc_id long, text string, lang string, source string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.classify(table, known, keep=("doc_id", "accepted")).collect()
    assert len(got) == 602
    wrong = [r.doc_id for r in got if r.doc_id is not None and 400 <= r.doc_id < 600 and r.accepted != (r.doc_id % 6 > 1)]
    assert len(wrong) <= 4


def test_lexicon_counts_all_but_copies(docs, spark):
    passage = " ".join(f"p{i}" for i in range(150))

    def text(i):
        return passage + " " + " ".join(f"w{i}x{j}" for j in range(100))

    # 60 documents share a passage, 12 of them are toxic; then 20 near copies, all but the last toxic
    texts = [text(i) + (" foul" if i < 12 else "") for i in range(60)]
    texts += [" ".join(f"c{j}" for j in range(200)) + f" end{i}" for i in range(20)]
    labels = spark.createDataFrame([(i, 1, int(i < 12 or 60 <= i < 79)) for i in range(80)], "doc_id long, quality int, toxic int")
    lexicon = quality.learn(docs(texts), labels).lexicon
    assert set(lexicon) == {b"foul"}
    rate = 31 / 80
    assert lexicon[b"foul"] == pytest.approx(np.log(12.5 / 0.5) - np.log(rate / (1 - rate)))
    # a toxic variant of a clean text is no loss: its own word counts, by group
    own = [f"{passage} v{i} foul" if i % 2 else f"{passage} v{i}" for i in range(12)]
    texts = [" ".join(f"d{i // 2}x{j}" for j in range(300)) + t[len(passage):] for i, t in enumerate(own)]
    texts += [text(i) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, int(i < 12 and i % 2)) for i in range(212)], "doc_id long, quality int, toxic int")
    assert b"foul" in quality.learn(docs(texts), labels).lexicon


def test_classifier_without_labels_passes_everything(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(docs(ODD), none).where("accepted").count() == len(ODD)
    assert quality.classify(docs([]), none).count() == 0


def test_sparse_sites_shrink_to_the_prior(spark):
    sites = spark.createDataFrame([("a", 1000, 900.0), ("b", 1000, 100.0)], "h string, n long, s double")
    alike = spark.createDataFrame([("a", 1000, 500.0), ("b", 1000, 500.0)], "h string, n long, s double")
    prior = F.lit(0.5)
    assert quality._strength(sites, "n", "s", prior) < 3 < 1000 < quality._strength(alike, "n", "s", prior)


# --- embeddings -----------------------------------------------------------

def test_e8_decoding_is_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 8))
    at = lattice.nearest_e8(x)
    best = ((x - at) ** 2).sum(axis=1)
    for v in lattice.e8_neighbours():
        assert (((x - at - v) ** 2).sum(axis=1) >= best - 1e-9).all()
    assert len({tuple(v) for v in lattice.e8_neighbours()}) == 240


def test_near_embeddings(spark):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(40):
        centre = rng.normal(size=32)
        for _ in range(rng.integers(1, 8)):
            rows.append((len(rows), [float(v) for v in np.float32(centre + rng.normal(size=32) * 0.12)], int(c % 3)))
    rows += [(len(rows) + i, rows[0][1], rows[0][2]) for i in range(20)]
    n = len(rows)
    odd = [None, [], [0.0] * 32, [float("nan")] * 32, [None, *[1.0] * 31], [float("inf"), *[1.0] * 31], [1.0, 0.0]]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)] + [(n + 50, rows[0][1], None)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("LABEL2", F.lit(1))
    got = {r.vec_id: r for r in lattice.near_embeddings(table).collect()}
    x = np.array([r[1] for r in rows[:n]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows[:n]])
    near = (x @ x.T >= 0.98) & (labels[:, None] == labels[None, :])
    assert len(got) == len(rows)
    links = sum(got[i].n_links for i in range(n))
    assert 0.9 * (near.sum() - n) <= links <= near.sum() - n
    assert all(got[i].n_links <= near[i].sum() - 1 and got[i].kept == (got[i].component_id == i) for i in range(n))
    assert all(got[r[0]].n_links == 0 and got[r[0]].kept for r in rows[n:])


def test_shipped_tables_find_pairs_near_the_threshold(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 64))
    y = rng.normal(size=(300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.981 * x + np.sqrt(1 - 0.981**2) * y
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([x, y]))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r.n_links for r in lattice.near_embeddings(table).collect()} == {1}


def near_copies(rng, sizes, dim=24, spread=0.12):
    centres = [rng.normal(size=dim) for _ in sizes]
    return np.array([np.float32(c + rng.normal(size=dim) * spread) for c, n in zip(centres, sizes, strict=True) for _ in range(n)])


def met_and_near(x, least=0.98):
    """All pairs at once: whether two vectors share a cell, or one is at home where the other probes, and are near."""
    unit = x.astype(np.float64)
    unit /= np.abs(unit).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    home, near = lattice.cells(unit, 4, 8, 0.6, 8)
    met = (home[:, None] == home).any(axis=2)
    probed = np.array([[np.isin(a, b).any() for b in home] for a in near])
    return (met | probed | probed.T) & (unit @ unit.T >= least) & ~np.eye(len(x), dtype=bool)


def plain_components(names, links):
    """The smallest name that links reach, for every row."""
    least = np.array(names)
    while True:
        new = np.array([min(least[i], *least[np.flatnonzero(links[i])]) if links[i].any() else least[i] for i in range(len(least))])
        if (new == least).all():
            return least
        least = new


@pytest.mark.parametrize("across", [False, True])
def test_tile_counts_each_pair_once(monkeypatch, across):
    for name, value in {"TILE_ROWS": 5, "PAIRS": 7, "CHUNK": 16}.items():
        monkeypatch.setattr(lattice, name, value)
    rng = np.random.default_rng(3)
    x = near_copies(rng, [25, 9, 4, 2, 1, 1, 30])[rng.permutation(72)]
    side = rng.random(72) < 0.4 if across else np.zeros(72, bool)
    shared = rng.random(72) < 0.1
    copies = rng.integers(1, 4, 72)
    tile = lattice.Tile(x, np.arange(72), copies, shared, side, across)
    tile.search(0.98, 4, 8, 0.6, 8)
    links = met_and_near(x) & ((side[:, None] != side) | (not across))
    assert links.sum() > 200
    apart = links & (shared[:, None] | shared)
    got = np.concatenate(tile.pairs, axis=1)
    assert Counter(map(tuple, np.sort(got, axis=0).T)) == Counter(zip(*np.nonzero(np.triu(apart)), strict=True))
    assert (tile.linked == (links & ~apart) @ copies).all()
    assert (tile.root == plain_components(range(72), links & ~apart)).all()


def test_near_embeddings_in_groups(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = near_copies(rng, [60, 20, 5, 3, 2, 1, 1])
    label = np.array([0] * 80 + [1] * 12)
    ids = np.arange(92)
    ids[[3, 70, 81]] = 500  # one node of three vectors, in two labels and two groups of near copies
    ids[[61, 62]] = 7, 6
    rows = [(int(i), [float(v) for v in e], int(k)) for i, e, k in zip(ids, x, label, strict=True)] * 2
    short = near_copies(rng, [6], 5, 0.001)
    rows += [(200 + i, [float(v) for v in e], 0) for i, e in enumerate(short)]
    links = met_and_near(x) & (label[:, None] == label) & (ids[:, None] != ids)
    copies = Counter(2 * ids.tolist())
    names = sorted(set(ids.tolist()))
    of = {i: sorted({ids[j] for k in np.flatnonzero(ids == i) for j in np.flatnonzero(links[k])}) for i in names}
    nodes = np.array([[b in of[a] for b in names] for a in names])
    component = dict(zip(names, plain_components(names, nodes), strict=True))
    # two rows a vector; a node that stands for many vectors counts with all its rows
    want = Counter((i, sum(copies[b] for b in of[i]) + 1, component[i], i == component[i]) for i in 2 * ids.tolist())
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    for kind, group, least in (("float", lattice.GROUP_BYTES, lattice.LEAST_BYTES), ("double", 3000, 1)):
        monkeypatch.setattr(lattice, "GROUP_BYTES", group)
        monkeypatch.setattr(lattice, "LEAST_BYTES", least)
        got = lattice.near_embeddings(table.withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))).collect()
        assert Counter(tuple(r) for r in got if not 200 <= r.vec_id < 206) == want
        assert {r.n_links for r in got if 200 <= r.vec_id < 206} == {5}


def test_pairs_of_near_copies_are_not_stored(spark, monkeypatch):
    held = []

    def counted(df):
        out = stage(df)
        held.append(out.count())
        return out

    monkeypatch.setattr(lattice, "stage", counted)
    x = near_copies(np.random.default_rng(6), [300], 32, 0.01)
    rows = [(i, [float(v) for v in e], 0) for i, e in enumerate(x)]
    got = lattice.near_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(299, 0)}
    assert max(held) <= 2 * len(rows)


# --- lines ----------------------------------------------------------------

def test_dedup_lines(docs):
    texts = [f"{' Same Line ' if i % 2 else chr(9) + 'same line'}\nown {i}\n\nÉcole" for i in range(9)] + ["École\nSAME LINE", *ODD]
    got = dedup_lines(docs(texts, [i % 12 for i in range(len(texts))]), min_docs=10)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keys = [[line.strip(" \t\n\v\f\r").translate(low) for line in (t or "").split("\n")] for t in texts]
    count = Counter(k for ks in keys for k in set(ks) if k)
    want = [("\n".join(line for line, k in zip((t or "").split("\n"), ks, strict=True) if not k or count[k] < 10), len(ks),
             sum(1 for k in ks if k and count[k] >= 10)) for t, ks in zip(texts, keys, strict=True)]
    assert sorted((r["text"], r["n_lines"], r["n_dropped"]) for r in got.select("text", "n_lines", "n_dropped").collect()) == sorted(want)
    assert any(w[2] for w in want)


def test_lines_are_stripped_of_every_blank_once(spark, docs):
    blanks = " \t\x0b\x0c\r"
    lines = [a + b + "a\u00a0B" + c for a in ["", *blanks] for b in ["", *blanks] for c in ["", *blanks, "\u2003", " \r "]] + [*blanks, " \t ", "\t \t"]
    got = dedup_lines(docs(["\n".join(lines), "A\u00a0b"]), min_docs=2)
    want = [line for line in lines if line.strip(blanks) != "a\u00a0B"]
    assert {r["text"] for r in got.collect()} == {"\n".join(want), ""}
    # one strip of a set of blanks in each of the two passes, not one wherever the key names the line; lines split once
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "split(" in text and text.count("element_at(split(") == 0


# --- pages ----------------------------------------------------------------

def test_extraction_on_held_out_pages():
    trees, odds = extract.train(300)
    rng = random.Random(77)
    pages = [extract.training_page(rng) for _ in range(100)]
    got = extract.main_texts([p.replace(extract.MARK, "") for p in pages], trees, odds)
    want = ["\n".join(t.replace(extract.MARK, "") for _, t in extract.build(p).blocks if extract.MARK in t) for p in pages]
    assert sum(g == w for g, w in zip(got, want, strict=True)) >= 85


def test_extraction_shape(spark):
    page = ('<html><head><title>T</title></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>A &amp; B</h1>'
            '<p>One  two,\n<b>three</b>.<br>four, and a longer end of it.<p>Second part of it, long enough to stay.<script>var t="</p>";</script>'
            '</article><footer>&copy; foot</footer>')
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (None, "u", "just text, which is not HTML at all"), (1, "u", page)]
    got = extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string"), 200).collect()
    assert [r.page_id for r in got] == [1, 2, 3, None, 1]
    assert got[0].text == "A & B\nOne two, three. four, and a longer end of it.\nSecond part of it, long enough to stay."
    assert got[0].n_chars == len(got[0].text) and got[1].text == got[2].text == ""


def test_nothing_kept_lies_in_something_dropped():
    page = extract.build("<body><div><p>a</p><p>b</p></div><p>c</p></body>")
    for seed in range(50):
        kept = extract.decode(page, np.random.default_rng(seed).normal(size=len(page.nodes)) * 3)
        assert all(n.parent is None or n.parent.order in kept for n in page.nodes if n.order in kept)


# --- urls -----------------------------------------------------------------

def test_judge_urls(spark):
    rules = [*RULES, ("block", "a.b.com", "/"), ("allow", "a.b.com", "/x"), ("block", "", "/"), ("odd", "com", "/zz")]
    hosts = ["com", "example.com", "WWW.example.com", "x.www.example.com", "net", "my.net", "a.b.com", "c.a.b.com", "ab.com",
             "xcom", "example.com.", "", "org", "a.b.com:80"]
    found = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/en/", "/en/a?x=/es/", "/es/q#://z", "/fr/", "/xy", "?/en/", "/zz")]
    found += [None, "", "no scheme", "//example.com/en/", "http://EXAMPLE.com/en/"]
    pages = spark.createDataFrame(list(enumerate(found)), "page_id long, url string").withColumn("URL2", F.lit(1))
    got = {r.page_id: r for r in urls.judge_urls(pages, urls.rule_table(spark, rules)).collect()}
    assert len(got) == len(found)
    for i, url in enumerate(found):
        rest = (url or "").partition("://")[2]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h) + len(p), v == "block", h + p, v) for v, h, p in rules if v != "odd" and h
                and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, best[2], best[3]), url


# --- packing and tokens ---------------------------------------------------

FUZZ = ["a", "b", " ", "  ", "\n", "\t", "é", "'s", "'t", "9", "!", "...", "<|endoftext|>", "word", "́", "漢", "😀", "\r\n", "ﬁ",
        "İ", "Σ", "ẞ", "\x85", " ", "_", "½", "क़", "'LL", "J̌", "<|startoftext|>"]


def fuzz(n, size):
    rng = random.Random(n)
    return ["".join(rng.choices(FUZZ, k=rng.randint(0, size))) for _ in range(n)]


def test_pack_is_a_round_trip(docs):
    path = vocabulary("word_bpe_49k.json")
    texts = [*ODD, *fuzz(120, 60), "long text " * 3000]
    got = pack(docs(texts).repartition(4), path, sequence=64, window=256).toPandas()
    plain = load(path)
    want = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    for i, pieces in got.sort_values("start").groupby("doc_id"):
        ids = [x for p in pieces.ids for x in np.frombuffer(p, "<u4").tolist()]
        assert ids == want[i] and set(pieces.doc_tokens) == {len(ids)}
        assert pieces.start.tolist() == [0, *pieces.length.cumsum().tolist()[:-1]]
    ends = {}
    for s, pieces in got.sort_values("offset").groupby("sequence_id"):
        assert pieces.offset.tolist() == [0, *pieces.length.cumsum().tolist()[:-1]]
        ends[s] = pieces.length.sum()
    total = sum(map(len, want.values()))
    assert sorted(ends) == list(range(-(-total // 64))) and all(ends[s] == 64 for s in range(total // 64))


def test_windows_hold_the_target_proportions(docs):
    path = vocabulary("word_bpe_49k.json")
    table = docs(["some words here"] * 600).withColumn("source", F.when(F.col("doc_id") < 400, "big").otherwise("small"))
    got = pack(table, path, sequence=32, window=128, shares={"big": 0.5, "small": 0.5}).join(table.select("doc_id", "source"), "doc_id")
    share = got.where("sequence_id < 40").groupBy(F.expr("sequence_id div 4")).agg(
        (F.sum(F.when(F.col("source") == "big", F.col("length")).otherwise(0)) / F.sum("length")).alias("s")).collect()
    assert all(abs(r.s - 0.5) < 0.02 for r in share)
    assert pack(docs([]), path).count() == 0


def test_sources_without_a_queue_are_mixed(docs):
    path = vocabulary("word_bpe_49k.json")
    size, length = len(load(path).encode("some words here", add_special_tokens=False).ids) + 1, 6
    # 600 even sources, each in one partition; names sort like partitions
    table = docs(["some words here"] * 600 * length).withColumn("source", F.format_string("s%03d", F.expr("doc_id div 6")))
    kinds = table.select(F.col("doc_id").alias("d"), "source").repartitionByRange(4, "d")
    got = pack(table.repartitionByRange(4, "doc_id"), path, sequence=100, window=600 * size).join(
        kinds, F.col("doc_id") == F.col("d")).toPandas()
    assert got.length.sum() == 600 * length * size
    got["at"] = got.sequence_id * 100 + got.offset
    for part in (1, 2, 3, 4, 5):  # after each window every source has had its part, to within a document
        held = got[got["at"] < part * 600 * size].groupby("source").length.sum().reindex(got.source.unique(), fill_value=0)
        assert (abs(held - part * size) <= size).all()
    starts = got[got.start == 0].sort_values("at").groupby("source").doc_id
    assert all(ids.tolist() == sorted(ids) for _, ids in starts)


def test_shares_of_small_sources_count(docs):
    path = vocabulary("word_bpe_49k.json")
    name = F.when(F.col("doc_id") >= 900, "zz").when(F.col("doc_id") >= 897, None).otherwise(
        F.format_string("s%03d", F.expr("doc_id div 3")))
    table = docs(["some words here"] * 902).withColumn("source", name)
    got = pack(table, path, sequence=8, window=16, shares={"zz": 0.5, None: 0.5, "absent": 0.1}).join(
        table.select("doc_id", F.coalesce("source", F.lit("none")).alias("kind")), "doc_id").toPandas()
    first = got[got.sequence_id < 2].groupby("kind").length.sum()
    assert first["zz"] >= 3 and first["none"] >= 3  # half of twice the natural weights
    for bad in (0, -1):
        with pytest.raises(ValueError):
            pack(table, path, shares={"zz": bad})


@pytest.mark.parametrize("chunk, overlap", [(20, 4), (100, 10)])
def test_spliced_counts(chunk, overlap):
    plain = load(vocabulary("byte_bpe_50k.json"))
    for t in [*fuzz(300, 150), "ab " * 300, " " * 500, "a" * 500, "x\n" * 300, "no " * 40 + "y" * 700]:
        assert tokens.count_long(t, plain, chunk, overlap) == len(plain.encode(t, add_special_tokens=False).ids)


class Watched:
    """A tokenizer that notes the length of what it encodes."""

    def __init__(self, tokenizer):
        self.tokenizer, self.longest, self.all = tokenizer, 0, 0

    def encode(self, text, **options):
        self.longest, self.all = max(self.longest, len(text)), self.all + len(text)
        return self.tokenizer.encode(text, **options)


@pytest.mark.parametrize("joint", ["\t", "\n", "  ", " \n", "\u3000", "，", "1", "<|endoftext|>", "--"])
def test_long_texts_without_single_spaces_are_spliced_in_bounded_pieces(joint):
    plain = load(vocabulary("byte_bpe_50k.json"))
    whole = tokens.whole_strings(plain)
    rng = random.Random(joint)
    letters = "abcdefgh" if joint.isascii() else "汉字文本处理数据"
    text = joint.join("".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(4000))
    seen = Watched(plain)
    assert tokens.count_long(text, seen, 1000, 64, whole) == len(plain.encode(text, add_special_tokens=False).ids)
    assert seen.longest <= 3000 and seen.all < 2 * len(text)


@pytest.mark.parametrize("seed", range(6))
def test_no_token_reaches_over_a_cut(seed):
    """Encoding what is before and after a cut by themselves gives the tokens of the whole, at every cut."""
    plain = load(vocabulary("byte_bpe_50k.json"))
    whole = tokens.whole_strings(plain)
    assert whole == ("<|endoftext|>",)
    rng = random.Random(seed)
    parts = ["'s", "'ll", "'", "a", "Ab", " ", "  ", "\n", "\t", "7", "42", "!", "--", "é", "e\u0301", "汉", "，", "\u3000", "\xa0",
             "\x1c", "\u200b", "\u180e", "½", "😀", "<|endoftext|>", "<|endof", "text|>", "<|", "\r\n", "ⅷ", "\u0e33"]
    text = "x" + "".join(rng.choice(parts) for _ in range(400)) + "x"
    ids = plain.encode(text, add_special_tokens=False).ids
    cuts = [at for at in range(1, len(text) - 1) if tokens._is_cut(text, at, whole)]
    assert len(cuts) > 60
    for at in cuts:
        sides = [plain.encode(side, add_special_tokens=False).ids for side in (text[:at], text[at:])]
        assert sides[0] + sides[1] == ids, (text[at - 5 : at], text[at : at + 5])


def test_other_tokenizers_splice_at_single_spaces_alone():
    assert tokens.whole_strings(load(vocabulary("word_bpe_49k.json"))) is None
    assert not tokens._is_cut("ab,cd", 2) and tokens._is_cut("ab cd", 2)


def test_token_counts(docs):
    path = vocabulary("byte_bpe_50k.json")
    texts = [*ODD, *fuzz(200, 80), "many words in a text. " * 2000]
    got = {r.doc_id: r for r in tokens.token_counts(docs(texts), path).collect()}
    for i, t in enumerate(texts):
        n = len(load(path).encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 512)


# --- licences and benchmarks ----------------------------------------------

def test_expressions():
    assert licenses.parse_expression("MIT OR Apache-2.0 AND GPL-2.0 WITH x") == ["mit", "apache-2.0", "gpl-2.0", "x", "with", "and", "or"]
    assert licenses.evaluate(licenses.parse_expression("(MIT OR GPL-2.0) AND BSD-3-Clause")) == (["mit", "gpl-2.0", "bsd-3-clause"], True)
    assert licenses.evaluate(licenses.parse_expression("MIT AND GPL-3.0"))[1] is False
    for bad in ("", "OR", "MIT OR", "(MIT", "MIT)", "MIT Apache", "()", "MIT / BSD"):
        assert licenses.parse_expression(bad) is None


def test_license_scan(docs):
    texts = ["Under the MIT License. CC BY-NC; apache  license\n", "# SPDX-License-Identifier: (MIT OR GPL-2.0) AND ISC",
             "the cc\nby cc by. gnu general public licenses", "Licensed under the GNU Lesser General Public License", *ODD]
    got = {r.doc_id: r for r in licenses.license_scan(docs(texts)).collect()}
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].last_word) == (9, 3, 2, 7)
    assert got[0].base_labels == ["apache", "cc-by", "mit"]
    assert got[1].labels == ["gpl-2.0", "isc", "mit"] and got[1].permissive and got[1].score == 1.0 and got[1].n_base == 0
    assert (got[2].n_base, got[2].first_word, got[2].last_word) == (2, 1, 3)
    assert got[3].labels == ["lgpl"] and 0 < got[3].score < 1
    assert all(got[i].score == 0 and got[i].first_word is None for i in range(4, len(texts)))


def test_benchmark_hits(docs, spark):
    item = " ".join(f"q{i}" for i in range(20))
    items = [(1, item), (10, "Short item"), (2, "q3 q4"), (5, None), (6, "..."), (None, "nameless one"), (1, item)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [item.upper().replace(" ", "--"), "x " * 200 + "short, ITEM", " ".join(f"q{i}" for i in range(12)), "a nameless one", *ODD]
    got = {r.doc_id: r for r in benchmark_hits(docs(texts), bench).collect()}
    assert (got[0].n_words, got[0].n_hit, got[0].items, got[0].contaminated) == (20, 20, ["1", "2"], True)
    assert (got[1].n_hit, got[1].items, got[1].contaminated) == (2, ["10"], False)
    assert texts[1][got[1].spans[0].start : got[1].spans[0].end] == "short, ITEM"
    assert (got[2].n_hit, got[2].items) == (2, ["2"]) and got[3].items == [""]
    assert all(got[i].n_hit == 0 and not got[i].contaminated for i in range(4, len(texts)))
    assert benchmark_hits(docs(["a"]), bench.limit(0)).first().n_hit == 0


# --- the registered queries -----------------------------------------------

@pytest.mark.parametrize("name", [n for n in REGISTRY if n not in ORACLES])
def test_queries_without_sql_run(spark, name):
    assert REGISTRY[name](spark, SF).count() > 0


def test_near_duplicates_go_by_text(spark):
    import corpus_pipeline

    one, two, three, four = (" ".join(f"{c}{i}" for i in range(80)) for c in "abcd")
    rows = [(7, one), (7, two), (7, one + " more"), (9, two + " more"), (3, two + " less"), (None, three), (None, three + " more"),
            (None, one), (8, four), (None, four), (None, None), (None, ""), (5, ""), (5, None)]
    table = spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)],
                                  "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, table, SF).collect()
    kept = sorted(((r.doc_id or 0, r.text or "") for r in got))
    assert kept[:2] == [(0, ""), (0, "")] and kept[2][0] == 0 and kept[2][1].startswith(three)
    assert kept[3:6] == [(3, two + " less"), (5, ""), (5, "")]
    assert [k[0] for k in kept[6:]] == [7, 8] and kept[6][1].startswith(one) and kept[7][1] == four


def test_pipeline(spark):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF).toPandas()
    kept = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    assert 0 < got.doc_id.nunique() < len(kept)
    ends = got.groupby("sequence_id").length.sum()
    assert (ends[:-1] == 4096).all()


# --- malformed pages, small trees -----------------------------------------

MARKUP = ["<", ">", "<!", "<![", "]]>", "-->", "<!--", "<!-", "--!>", "</", "/>", "<?", "&", "&#", ";", "&amp", "\x00", "é", " ", "\n", "a", "-1",
          "<p>", "</p>", "<div class='x", "\"", "'", "=", "<li>", "<td>", "<table>", "</div>", "<script>", "</script", "<title>", "<![CDATA[",
          "<!doctype", "<a href=", "</a>", "<svg>", "<textarea>", "if", "[x]", "]", "<plaintext>", "<b", "<template>", "<br/>"]


def test_any_markup_builds_a_tree():
    rng = random.Random(9)
    for _ in range(50_000):
        page = extract.build("".join(rng.choices(MARKUP, k=rng.randint(1, 14))))
        assert page.nodes[0] is page.root and all(n.parent.order < n.order for n in page.nodes[1:])


@pytest.mark.parametrize("odd", ["a <![-1,1]> b", "<![>", "<![foo[x]]>", "<p>a</p><![ x ]>", "a<!x", "<![CDATA[x > y]]>"])
def test_sections_without_a_meaning_are_passed_over(spark, odd):
    page = "<article>" + "<p>A paragraph of some length, as articles have them.</p>" * 4 + odd + "</article>"
    got = extract.extract_text(spark.createDataFrame([(1, "u", odd), (2, "u", page)], "page_id long, url string, html string"), 100).collect()
    assert got[1].text.count("A paragraph") == 4 and "[" not in got[1].text


@pytest.mark.parametrize("tall", ["<div>" * 40_000 + "</p>" * 40_000, "<ul><li>" + "<div>" * 40_000 + "<li></li>" * 40_000,
                                  "<li><ul>" + "<div>" * 40_000 + "<li></li>" * 40_000, "<p>" + "<b>" * 40_000 + "</i>" * 40_000,
                                  "<div>x</span>" * 40_000 + "</div>" * 40_000, "<dt>" * 40_000, "<tr><td>" * 40_000 + "</tr>" * 80_000])
def test_tall_pages_take_linear_time(tall):
    began = time.perf_counter()
    page = extract.build(tall)
    extract.features(page, {})
    assert time.perf_counter() - began < 6


def test_decoding_equals_an_exhaustive_choice():
    rng = random.Random(3)
    for _ in range(150):
        html = "".join(rng.choices(["<div>", "<ul>", "<p>t</p>", "</div>", "</ul>", "<script>x</script>"], k=rng.randint(2, 9)))
        page = extract.build(html)
        score = np.array([rng.uniform(-3, 3) for _ in page.nodes])
        free = [n for n in page.nodes if not n.mute]
        best = 0.0
        for bits in range(1 << len(free)):
            kept = {n.order for i, n in enumerate(free) if bits >> i & 1}
            if all(n.parent is None or n.parent.order in kept for n in page.nodes if n.order in kept):
                best = max(best, sum(score[i] for i in kept))
        kept = extract.decode(page, score.copy())
        assert abs(sum(score[i] for i in kept) - best) < 1e-9 and not any(n.mute for n in page.nodes if n.order in kept)


# --- licences -------------------------------------------------------------

def tags_of(spark, *texts):
    rows = licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [(r.labels, r.expressions, r.permissive) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_every_tag_of_a_line_counts(spark):
    got = tags_of(spark, "/* SPDX-License-Identifier: MIT */ /* SPDX-License-Identifier: GPL-3.0-only */",
                  '{"a": "SPDX-License-Identifier: (MIT OR Apache-2.0)", "b": "spdx_license_identifier : ISC."} SPDX-License-Identifier:',
                  "é SPDX-License-Identifier: MIT.", "SPDX License Identifier: GPL-2.0 WITH Classpath-exception-2.0 OR MIT",
                  "SPDX--License-Identifier: MIT", "SPDX-License-Identifier: MIT OR and more")
    assert got[0] == (["gpl-3.0-only", "mit"], ["MIT", "GPL-3.0-only"], False)
    assert got[1] == (["apache-2.0", "isc", "mit"], ["(MIT OR Apache-2.0)", "ISC"], True)
    assert got[2] == (["mit"], ["MIT"], True)
    assert got[3] == (["gpl-2.0", "mit"], ["GPL-2.0 WITH Classpath-exception-2.0 OR MIT"], True)
    assert got[4] == ([], [], None) and got[5] == (["mit"], ["MIT"], True)


def test_with_takes_the_name_of_an_exception_only():
    for bad in ("MIT WITH (GPL-2.0 AND x)", "(MIT) WITH x", "MIT WITH x WITH y", "MIT WITH", "WITH x", "MIT WITH OR GPL"):
        assert licenses.parse_expression(bad) is None, bad
    assert licenses.read_tag("MIT WITH (GPL-2.0 AND x)", 0) == ("MIT", ["mit"])
    assert licenses.read_tag("MIT OR (GPL-2.0 AND (x OR", 0) == ("MIT", ["mit"])
    assert licenses.evaluate(["gpl-2.0", "x", "with", "mit", "and"]) == (["gpl-2.0", "mit"], False)


def test_long_expressions_take_linear_time(spark):
    began = time.perf_counter()
    text = "MIT OR " * 75_000 + "GPL-2.0 AND ("  + "ISC AND " * 75_000
    found = licenses.read_tag(text, 0)
    assert len(found[1]) == 2 * 75_000 + 1 and licenses.evaluate(found[1])[1]
    assert licenses.read_tag("(" * 500_000, 0) is None
    assert time.perf_counter() - began < 5


def test_base_columns_of_licences_equal_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    phrases = " UNION ALL ".join(f"SELECT {p.split()} AS p, '{label}' AS label" for p, label in licenses.BASE_PHRASES.items())
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    want = con.execute(f"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        phrases AS ({phrases}),
        hits AS (SELECT doc_id, label, i FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d), phrases
          WHERE w[i + 1 : i + len(p)] = p)
        SELECT d.doc_id, len(any_value(w)), count(i), min(i), max(i), list_sort(list(DISTINCT label) FILTER (WHERE i IS NOT NULL))
        FROM d LEFT JOIN hits USING (doc_id) GROUP BY d.doc_id ORDER BY 1""").fetchall()
    rows = licenses.license_scan(spark.read.parquet(f"{SF}/documents.parquet")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows] == [
        (*r[:5], r[5] or []) for r in want] and sum(r.n_base for r in rows) > 0


# --- tables that are full, large vocabularies, empty input ----------------

def test_word_ids_survive_a_full_table(monkeypatch):
    path = vocabulary("word_bpe_49k.json")
    plain = load(path)
    table = units.WordIds(path)
    monkeypatch.setattr(units.WordIds, "MOST", 40)
    for text in [*fuzz(400, 120), "Words, and (more) words; it's ÉTÉ- naïve 漢字.", "a<|endoftext|>b <|endoftext|>, x<| |> 12ab 3.5",
                 "".join(c + ("a " if i % 3 else "b") for i in range(0x400) if (c := chr(i)).isalpha())]:
        words = text.encode().split()
        ids = np.frombuffer(b"".join(table[w] for w in words), table.width).tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids, text
        assert len(table) <= 40 and len(table.older) <= 40


def test_words_with_signs_take_no_place_in_the_table():
    table = units.WordIds(vocabulary("word_bpe_49k.json"))
    assert table[b"words,"] == table[b"words"] + table[b","] and table["été.".encode()] == table["été".encode()] + table[b"."]
    assert sorted(table) == sorted([b"words", b",", "été".encode(), b"."])


def test_large_vocabularies_keep_their_ids(spark, tmp_path):
    import json
    words = {f"w{i}": i for i in range(70_000)}
    path = str(tmp_path / "words.json")
    with open(path, "w") as f:
        json.dump({"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
                   "pre_tokenizer": {"type": "Whitespace"}, "post_processor": None, "decoder": None,
                   "model": {"type": "WordLevel", "vocab": words, "unk_token": "w0"}}, f)
    docs = spark.createDataFrame([(1, "w69999 w3 w65536", "s"), (2, None, None)], "doc_id long, text string, source string")
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in pack(docs, path, end_id=1).collect()}
    assert got == {1: [69999, 3, 65536, 1], 2: [1]}


def test_operators_without_rows(spark, docs):
    none = docs(["a"]).limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    made = [ngram_join.ngram_components(none, 3, "0.9"), lattice.near_embeddings(vectors), dedup_lines(none, min_docs=10, min_chars=1),
            extract.extract_text(pages, 20), urls.judge_urls(pages, urls.rule_table(spark, RULES)), licenses.license_scan(none),
            tokens.token_counts(none, vocabulary("byte_bpe_50k.json"))]
    assert [df.count() for df in made] == [0] * len(made)
