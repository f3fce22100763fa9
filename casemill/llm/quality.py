"""Quality rules: base counts of each text and cross-document line frequency.

Only DataFrame functions: no Python runs on the executors.

Method.  Lines are normalised (lower case, words joined by one space) and hashed.  For each host
(the ``source`` column) the distinct documents that carry a line are counted, where documents of
equal text count once, so that a group of exact copies never makes its own lines common.  A line
found in more distinct documents than the limit of its host is removed: a ``share`` of the host's
distinct documents, ``min_docs`` at least and ``most_docs`` at most, so that it works on hosts of a few
documents and doesn't grow with very large ones.  A document that loses lines and is left with
fewer than ``min_words`` words or less than ``min_left`` of them is rejected as depleted.

Edge cases: a null text counts as empty; an empty text has zero counts and fails the base rule; a
null host is a host of its own; repeated rows each get a row with the same values; an empty table
gives an empty result; other columns of the input are ignored (``quality_report``) or kept
(``apply_quality``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import hot_join, let, maybe_among, words, written

SYMBOLS = "#*$%&|<>"
MIN_DOCS, SHARE, MOST_DOCS, MIN_WORDS, MIN_LEFT = 3, 0.10, 20, 50, 0.30


def repeated_words(w: Column, n: int = 3) -> Column:
    """Words of ``w`` inside ``n``-word windows that occur twice or more.

    The hashes of the windows are compared first, and a text whose hashes all differ is done.
    Else windows sort by 33 bits of their hash, which leaves few candidates; those are compared in
    full, so the count is exact.
    """

    def candidates(hashes: Column) -> Column:
        keys = F.sort_array(F.transform(hashes, lambda x, i: F.shiftleft(x, 31).bitwiseOR(i.cast("long"))))
        same = lambda a, b: F.shiftright(a.bitwiseXOR(b), 31) == 0
        twin = lambda ks: F.filter(ks, lambda x, j: F.coalesce(same(x, F.get(ks, j - 1)), F.lit(False)) | F.coalesce(same(x, F.get(ks, j + 1)), F.lit(False)))
        return F.transform(let(keys, twin), lambda x: x.bitwiseAND(F.lit(2**31 - 1)).cast("int"))

    def covered(w: Column, at: Column) -> Column:
        full = F.sort_array(F.transform(at, lambda p: F.struct(F.array_join(F.slice(w, p + 1, n), " ").alias("k"), p.alias("p"))))
        twin = lambda s: F.filter(s, lambda x, j: F.coalesce(x["k"] == F.get(s, j - 1)["k"], F.lit(False)) | F.coalesce(x["k"] == F.get(s, j + 1)["k"], F.lit(False)))
        places = F.sort_array(F.transform(let(full, twin), lambda x: x["p"]))
        start = F.struct(F.lit(0).alias("t"), F.lit(0).alias("e"))
        step = lambda a, p: F.struct((a["t"] + p + n - F.greatest(a["e"], p)).alias("t"), (p + n).alias("e"))
        return F.aggregate(places, start, step, lambda a: a["t"])

    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))
    count = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(candidates(h), lambda at: F.when(F.size(at) > 0, covered(w, at)).otherwise(0))).otherwise(0)
    return F.when(F.size(w) > n, let(hashes, count)).otherwise(0).cast("long")


def with_counts(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    blank = " \t\n\x0b\x0c\r"
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, blank, "")) > 0)
    out = docs.withColumn("_w", words(F.col("text"))).withColumn("_lines", lines)
    return out.select(
        *docs.columns,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate(text, blank, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        let(F.col("_w"), lambda w: repeated_words(w)).alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", "text", F.xxhash64("text", "source").alias("_h"))


def _lines(docs: DataFrame) -> DataFrame:
    """A row for each line with a word: doc_id, _h, source, _at, _line (hash), _n (words)."""

    def entry(line: Column, at: Column) -> Column:
        return let(words(line), lambda w: F.struct(at.alias("_at"), F.xxhash64(F.lower(F.array_join(w, " "))).alias("_line"), F.size(w).alias("_n")))

    parts = F.transform(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"), entry)
    return docs.select("doc_id", "_h", "source", F.inline(F.filter(parts, lambda x: x["_n"] > 0)))


def common_lines(docs: DataFrame, lines: DataFrame, *, min_docs: int = MIN_DOCS, share: float = SHARE, most_docs: int = MOST_DOCS) -> DataFrame:
    """source, _line and n_docs of the lines above the limit of their host."""
    hosts = docs.select("source", "_h").distinct().groupBy("source").agg(F.count(F.lit(1)).alias("_docs"))
    counts = (
        lines.select("source", "_line", "_h").distinct()
        .groupBy("source", "_line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > min(min_docs, most_docs))
    )
    limit = F.least(F.lit(most_docs).cast("double"), F.greatest(F.lit(min_docs).cast("double"), F.lit(share) * F.col("_docs")))
    hosts = hosts.select(F.col("source").alias("_host"), limit.alias("_limit"))
    return counts.join(hosts, F.col("source").eqNullSafe(F.col("_host"))).where(F.col("n_docs") > F.col("_limit")).select("source", "_line", "n_docs")


def _losses(docs: DataFrame, limits: dict) -> DataFrame:
    """_id, _hash, _cut (places of the lines removed) and _lost (words in them), for documents that lose any."""
    keyed = _keyed(docs)
    lines = written(_lines(keyed), "lines")  # thin, and used three times
    hit = hot_join(lines, common_lines(keyed, lines, **limits), ["source", "_line"], ["doc_id", "_at"]).where(F.col("n_docs").isNotNull())
    each = hit.groupBy("doc_id", "_h", "_at").agg(F.max("_n").alias("_n"))
    return each.groupBy(F.col("doc_id").alias("_id"), F.col("_h").alias("_hash")).agg(F.collect_list("_at").alias("_cut"), F.sum("_n").alias("_lost"))


def _judged(rows: DataFrame, losses: DataFrame | None, min_words: int, min_left: float, keep: list[str]) -> DataFrame:
    """``rows`` (with _h) with counts, losses and the verdict; without ``losses`` they have none."""
    out = with_counts(rows).select(*keep, "_h", *COUNTS)
    if losses is None:
        out = out.withColumns({"_cut": F.lit(None).cast("array<int>"), "_lost": F.lit(0)})
    else:
        out = out.join(losses, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash")), "left")
    lost = F.coalesce("_lost", F.lit(0)).cast("long")
    left = F.col("n_words") - lost
    depleted = (lost > 0) & ((left < min_words) | (left < min_left * F.col("n_words")))
    return out.select(*keep, *COUNTS, (~F.col("base_failed") & ~depleted).alias("kept"), lost.alias("n_removed_words"), F.col("_cut"))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def quality_report(docs: DataFrame, *, min_docs: int = MIN_DOCS, share: float = SHARE, most_docs: int = MOST_DOCS, min_words: int = MIN_WORDS, min_left: float = MIN_LEFT) -> DataFrame:
    """A row for each document: doc_id, the base counts, the verdict kept and n_removed_words."""
    docs = docs.select("doc_id", "source", "text")
    losses = _losses(docs, {"min_docs": min_docs, "share": share, "most_docs": most_docs})
    return _judged(docs.withColumn("_h", F.xxhash64("text", "source")), losses, min_words, min_left, ["doc_id"]).drop("_cut")


def apply_quality(docs: DataFrame, *, min_docs: int = MIN_DOCS, share: float = SHARE, most_docs: int = MOST_DOCS, min_words: int = MIN_WORDS, min_left: float = MIN_LEFT) -> DataFrame:
    """The kept documents, common lines cut from their texts (and ``n_chars`` to match).

    Only documents that may lose lines, by a filter of fixed size, are shuffled with their texts;
    the others are judged where they are read.
    """
    own = docs.columns
    packed = docs.select(F.struct(*own).alias("_row"), "doc_id", "source", "text").withColumn("_h", F.xxhash64("text", "source"))
    losses = written(_losses(docs, {"min_docs": min_docs, "share": share, "most_docs": most_docs}), "losses")
    touched = maybe_among(losses, F.xxhash64("_id", "_hash"), F.xxhash64("doc_id", "_h"))
    cut = _judged(packed.where(touched), losses, min_words, min_left, ["_row", "doc_id"])
    whole = _judged(packed.where(~touched), None, min_words, min_left, ["_row", "doc_id"])
    text = F.col("_row.text")
    rest = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col("_cut"), i)), "\n")
    new = {"text": F.when(F.col("_cut").isNull(), text).otherwise(rest)}
    if "n_chars" in own:
        new["n_chars"] = F.when(F.col("_cut").isNull(), F.col("_row.n_chars")).otherwise(F.length(rest)).cast(docs.schema["n_chars"].dataType)
    out = [cut.where("kept").select(*[new[c].alias(c) if c in new else F.col("_row")[c].alias(c) for c in own]), whole.where("kept").select(*[F.col("_row")[c].alias(c) for c in own])]
    return out[0].unionAll(out[1])
