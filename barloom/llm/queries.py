"""The registered queries of the text operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import table
from barloom.llm.decontam import benchmark_hits
from barloom.llm.extract import extract_text
from barloom.llm.lattice import near_embeddings
from barloom.llm.licenses import license_scan
from barloom.llm.lines import dedup_lines
from barloom.llm.negatives import hard_negatives
from barloom.llm.ngram_join import ngram_components
from barloom.llm.packing import pack
from barloom.llm.quality import classify
from barloom.llm.search import ranked_search
from barloom.llm.tokens import token_counts
from barloom.llm.toxicity import toxicity
from barloom.llm.urls import judge_urls, rule_table

RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def _vocabulary(name: str) -> str:
    """Where the file of a public tokenizer lies; workers read the same path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), k=3, least="0.9")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """The pieces of packed documents with a checksum in place of their ids."""
    return pack(docs, _vocabulary("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    def text(labels):
        return F.array_join(labels, ",").alias(labels)

    return license_scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", text("base_labels"), text("labels"), "score",
        text("expressions"), "permissive")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), limit=0.7)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    return hard_negatives(table(spark, sf_dir, "embeddings"), anchor=vec_id % 100 == 0,
                          label=F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_ngram_jaccard_join, op2_quality_classifier, op3_embedding_near_dedup, op4_line_dedup,
        op5_html_extraction, op6_url_filters, op7_packing, op8_license_scans,
        op9_benchmark_decontamination, op10_token_counts, op11_ranked_search, op12_toxicity, op13_hard_negatives)
}

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": f"""
        WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
               translate(coalesce(text, ''), '{A_TO_Z}', '{A_TO_Z.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
          FROM documents),
        g AS (SELECT r, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
               ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM d),
        e AS (SELECT r, len(s) AS n, unnest(s) AS gram FROM g),
        common AS (SELECT x.r AS a, y.r AS b, x.n AS n, y.n AS m, count(*) AS c FROM e x JOIN e y ON x.gram = y.gram
          WHERE x.r <> y.r AND 10 * least(x.n, y.n) >= 9 * greatest(x.n, y.n) GROUP BY ALL),
        links AS (SELECT a, b FROM common WHERE 100 * c >= 90 * (n + m - c)),
        reach AS (SELECT r AS a, r AS b FROM g UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
        SELECT g.doc_id, len(g.s) AS n_shingles, min(o.doc_id) AS component_id
        FROM g JOIN reach ON reach.a = g.r JOIN g o ON o.r = reach.b GROUP BY g.r, g.doc_id, g.s""",
    "op4_line_dedup": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
               '{A_TO_Z}', '{A_TO_Z.lower()}') AS key FROM l),
        hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
        m AS (SELECT k.*, hot.key IS NOT NULL AS gone FROM k LEFT JOIN hot ON hot.key = k.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM m GROUP BY r, doc_id""",
    "op6_url_filters": f"""
        WITH rules(verdict, host, path) AS (VALUES {", ".join(map(str, RULES))}),
        u AS (SELECT page_id, row_number() OVER () AS r, translate(regexp_extract(coalesce(url, ''),
               '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{A_TO_Z}', '{A_TO_Z.lower()}') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
        best AS (SELECT u.r, arg_max(rules.host || rules.path, length(rules.host || rules.path)) AS rule,
               arg_max(rules.verdict, length(rules.host || rules.path)) AS verdict
          FROM u JOIN rules ON (u.host = rules.host OR ends_with(u.host, '.' || rules.host))
           AND starts_with(u.path, rules.path) GROUP BY u.r)
        SELECT u.page_id, u.host, u.path, best.rule, coalesce(best.verdict, 'allow') AS verdict
        FROM u LEFT JOIN best USING (r)""",
    "op9_benchmark_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
               '{A_TO_Z}', '{A_TO_Z.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
               '{A_TO_Z}', '{A_TO_Z.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1),
               lambda i: array_to_string(w[i : i + 12], ' '))) AS win FROM b WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT n FROM bw),
        dw AS (SELECT r, n, len(w) AS total, unnest(range(1, len(w) - n + 2)) AS pos,
               unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS win
          FROM d, sizes WHERE len(w) >= n),
        hits AS (SELECT dw.r, dw.pos, dw.n, bw.item_id FROM dw JOIN bw ON bw.win = dw.win AND bw.n = dw.n),
        spot AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY r),
        its AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(spot.n_hit, 0) AS n_hit, coalesce(its.n_items, 0) AS n_items,
          sha256(coalesce(its.ids, '')) AS items_sha256,
          coalesce(spot.n_hit, 0) > 0 AND 20 * coalesce(spot.n_hit, 0) >= len(d.w) AS contaminated
        FROM d LEFT JOIN spot USING (r) LEFT JOIN its USING (r)""",
    "op11_ranked_search": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
               '{A_TO_Z}', '{A_TO_Z.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        sums AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
        i AS (SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''),
               '{A_TO_Z}', '{A_TO_Z.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
        asked AS (SELECT q, item_id, unnest(w) AS term FROM i),
        held AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d)
          WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
        weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
          FROM held, sums GROUP BY term, docs),
        found AS (SELECT q, item_id, r, doc_id,
               sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
          FROM asked JOIN held USING (term) JOIN weights USING (term), sums GROUP BY ALL HAVING score > 0),
        best AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM found)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM best WHERE rank <= 10""",
    "op13_hard_negatives": """
        WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS x,
               CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label
          FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        c AS (SELECT r, vec_id, label, len(x) AS dims, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM v),
        s AS (SELECT a.r AS a, b.r AS b, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, sum(a.x * b.x)::BIGINT AS score
          FROM c a JOIN c b USING (i, dims) WHERE a.vec_id % 100 = 0 AND a.r <> b.r GROUP BY ALL),
        p AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, b) AS k FROM s WHERE alike),
        n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.a, p.k ORDER BY s.score DESC, s.vec_id, s.b) AS rank
          FROM p JOIN s ON s.a = p.a AND NOT s.alike AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
          WHERE p.k <= 5)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 10""",
}
