"""Quality rules with cross-document line frequency, all in DataFrame functions.

Lines are normalised (ASCII lower case, white space collapsed) and hashed to 64
bits together with their host. One pass over the texts writes the counts of each
document with its line hashes and their numbers of words. One aggregation counts
the distinct documents of each (host, line); only lines above the limit come
back, and what they hold is taken from the words of the document, which is
rejected if too few are left. Texts are not read a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.native import ascii_lower, let, run_keys, words
from spanloom.llm.stages import written

#: The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: A frequent line is looked up in so many parts, so that the documents of one
#: line are spread over as many tasks (and more by adaptive execution).
SALTS = 16


def line_keys(text: Column, host: Column) -> Column:
    """``key`` (a hash of host and normalised line) and ``n`` (its words) of each
    line; null for blank lines."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\x0B\f\r]+", " ")
    lines = F.split(F.trim(F.regexp_replace(plain, " ?\n ?", "\n")), "\n")
    of = F.coalesce(host, F.lit(""))

    def key(line: Column) -> Column:
        count = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1
        return F.when(line != "", F.struct(F.xxhash64(of, ascii_lower(line)).alias("key"), count.cast("long").alias("n")))

    return F.transform(lines, key)


def _repeat_words(keys: Column, size: int) -> Column:
    """Words covered by windows whose key occurs twice or more in ``keys``."""

    def covered(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(rows: Column) -> Column:
            again = F.filter(rows, lambda x, k: F.coalesce(F.get(rows, k + 1)["h"] == x["h"], F.lit(False)) | F.coalesce((k > 0) & (F.get(rows, k - 1)["h"] == x["h"]), F.lit(False)))
            return let(
                F.array_sort(F.transform(again, lambda x: x["i"])),
                lambda at: F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(at, k + 1) - p, F.lit(size)))), F.lit(0), lambda total, x: total + x),
            )

        return let(ordered, twice)

    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(covered(keys))


def document_statistics(docs: DataFrame, text: str = "text", size: int = 5) -> DataFrame:
    """``docs`` with the counts over each whole text in place of ``text``; null
    texts count as empty."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    names = [F.col(f"`{c}`") for c in docs.columns if c != text]
    filled = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]"))
    split = docs.select(*kept, words(whole).alias("__words"), filled.alias("__lines"), F.regexp_count(whole, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"))
    hashed = split.select(
        *names,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        run_keys(F.transform("__words", lambda w: F.xxhash64(w)), size).alias("__runs"),
    )
    return hashed.select(*names, "n_words", "word_chars", "n_symbols", "n_dup_lines", _repeat_words(F.col("__runs"), size).cast("long").alias("n_repeat_words"))


def frequent_lines(lines: DataFrame, max_docs: int) -> DataFrame:
    """(line_key) of the lines that more than ``max_docs`` documents of a host
    contain, from the rows (doc_key, line_key) of all lines."""
    return lines.groupBy("line_key").agg(F.count_distinct("doc_key").alias("n_docs")).filter(F.col("n_docs") > max_docs).select("line_key")


def line_frequency_rules(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_docs: int = 20,
    min_left: float = 0.5,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    cleaned: bool = True,
) -> DataFrame:
    """One row per input row: base counts, verdict, words left, cleaned text.

    Rows that repeat an ``id`` are one document for the frequency of a line; rows
    with a null id are one document for each distinct text. A null host is the
    host ``""``; a null text is empty and fails the word minimum. Lines found in
    more than ``max_docs`` documents of their host are removed; a document that
    keeps under ``min_left`` of its words is depleted. Every row gets its own row
    back, also where ids are null or repeated. An empty table gives no row.
    Columns besides the three named ones are ignored, whatever their names.
    Without ``cleaned`` the texts are neither kept nor returned.
    """
    of_text = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{id}`").alias("doc_id"),
        of_text.alias("text"),
        F.when(F.col(f"`{id}`").isNull(), F.xxhash64(F.lit("no id"), of_text)).otherwise(F.xxhash64(F.col(f"`{id}`"))).alias("doc_key"),
        line_keys(of_text, F.col(f"`{host}`")).alias("lines"),
        F.monotonically_increasing_id().alias("row"),
        *([F.coalesce(of_text, F.lit("")).alias("whole")] if cleaned else []),
    )
    # Written once, so that row numbers stay what they are.
    base = written(document_statistics(rows))
    lines = base.select("row", "doc_key", F.explode(F.array_compact("lines")).alias("line")).select("row", "doc_key", F.col("line.key").alias("line_key"), F.col("line.n").alias("n"))
    salted = frequent_lines(lines, max_docs).select("line_key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    found = lines.withColumn("salt", F.pmod(F.col("row"), F.lit(SALTS)).cast("int")).join(salted, ["line_key", "salt"])
    gone = found.groupBy("row").agg(F.sum("n").alias("n_gone"), F.collect_set("line_key").alias("removed"))
    joined = base.join(gone, "row", "left")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("n_gone", F.lit(0))
    depleted = (left < min_words) | (left < min_left * F.col("n_words"))
    kept_lines = F.filter(F.split("whole", "\n"), lambda line, i: F.coalesce(~F.array_contains("removed", F.get("lines", i)["key"]), F.lit(True)))
    last = [F.when(F.col("removed").isNull(), F.col("whole")).otherwise(F.array_join(kept_lines, "\n")).alias("cleaned")] if cleaned else []
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), left.alias("n_words_left"), *last)
