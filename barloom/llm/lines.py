"""Dropping lines that many documents share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import lower_ascii, only

BLANK = " \t\n\x0b\x0c\r"


def _stripped(line):
    """A line without blanks at both ends. Stripping a set of characters walks the whole line, stripping spaces
    its ends alone, so the set is left to lines that then begin or end with another blank."""
    spaces_off = F.trim(line)
    others = list(BLANK[1:])
    return F.when(F.left(spaces_off, F.lit(1)).isin(others) | F.right(spaces_off, F.lit(1)).isin(others),
                  F.trim(line, F.lit(BLANK))).otherwise(spaces_off)


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of the documents with ``text`` rebuilt from its kept lines, and ``n_lines`` and ``n_dropped``.

    A line's key is the line without blanks at both ends and with A-Z lower-cased. Keys of at least
    ``min_chars`` code points that occur in at least ``min_docs`` rows lose all their lines everywhere;
    the other lines stay as they are, in order, joined by a line feed.

    Lines are exploded and hashed; each row counts once for a hash, and counts are summed before the
    shuffle, so a line in a third of all documents costs one row per task. Positions of dropped lines
    come back to their document, which rebuilds its text from its own lines: no text is exploded.

    A null or empty text is one empty line and stays an empty text. Each row is a document of its own:
    repeated rows and repeated or null doc_ids count separately. Other columns than doc_id, text and
    ``keep`` are ignored. A table without rows gives none.
    """
    keep = tuple(c for c in dict.fromkeys(keep) if c not in ("text", "n_lines", "n_dropped"))
    docs = only(docs, *dict.fromkeys((*keep, "doc_id", "text"))).withColumns({
        "__text": F.coalesce(F.col("text"), F.lit("")),
    }).withColumn("__row", F.struct(F.col("doc_id").alias("i"), F.xxhash64("__text").alias("h")))
    lines = F.split("__text", "\n", -1)
    # a line is stripped once, in a step of its own, and not wherever its key names it
    stripped = F.transform(lines, _stripped)

    def key(line):
        return F.md5(lower_ascii(line).cast("binary"))

    def long_enough(line):
        return F.char_length(line) >= min_chars

    once = docs.select(F.explode(F.array_distinct(
        F.transform(F.filter(stripped, long_enough), key))).alias("key"))
    shared = once.select(F.unhex("key").alias("key")).groupBy("key").count().where(F.col("count") >= min_docs)
    placed = (docs.select("__row", F.posexplode(stripped).alias("at", "line"))
              .where(long_enough(F.col("line"))).select("__row", "at", F.unhex(key(F.col("line"))).alias("key")))
    dropped = (placed.join(shared.select("key"), "key", "left_semi")
               .groupBy("__row").agg(F.collect_set("at").alias("__dropped")))
    dropped = dropped.select(F.col("__row.i").alias("__i"), F.col("__row.h").alias("__h"), "__dropped")
    joined = docs.join(dropped, F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("__row.h") == F.col("__h")), "left")

    empty = F.array().cast("array<int>")
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__dropped")
    text = F.array_join(F.transform(kept, lambda at: F.element_at("__lines", at + 1)), "\n")
    # the lines are a column first, or each kept line would split the text anew
    out = joined.withColumn("__lines", lines).withColumns({
        "text": F.when(F.col("__dropped").isNull(), F.col("__text")).otherwise(text),
        "n_lines": F.size("__lines").cast("long"),
        "n_dropped": F.greatest(F.size(F.coalesce("__dropped", empty)), F.lit(0)).cast("long"),
    })
    return out.select(*keep, "text", "n_lines", "n_dropped")
