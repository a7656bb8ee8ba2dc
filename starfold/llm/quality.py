"""Quality rules: per-document repetition rules and cross-document line frequency.

Method. Lines are normalised (ASCII white space at both ends removed, A-Z lower-cased) and hashed.
For every host the number of distinct documents (ids) that hold a line is counted, copies of a text included;
taking them out before is the work of a near-duplicate operator. A line is over the limit when
it is in more than `LINE_DOCS` documents of the host, however many documents the host has: the same
lines go in a small host and in one that holds a third of all rows. Lines over the limit are removed;
a document of which less than `KEEP_SHARE` of its words remain is rejected as depleted.

Every document becomes one row of counts and a list of its distinct lines (hash, words), written
once below the shared folder. Counting is a map-side combined aggregate by (host, line); the
frequent lines come back to the line rows by an equi-join that Spark may split. Texts are not
shuffled.

Defined cases. Null text has no words and fails the base rules. Null hosts are one host. Rows with a
null or repeated id are judged row by row; rows of one id count as one document for a line, each row without an id
as one of its own. Empty tables give empty results.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import map_rows
from starfold.session import materialize

MIN_WORDS = 50
REPEAT_PERCENT = 50
LINE_DOCS = 20
KEEP_SHARE = 0.3

STATS = (
    "doc_id long, host string, rid long, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, lines array<struct<line:string,words:long>>"
)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    covered, free = 0, 0  # `free`: first word that no counted window has covered
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + 3 - max(i, free)
            free = i + 3
    return covered


def text_stats(text: str | None) -> tuple[int, int, int, int, int, list[tuple[str, int]]]:
    """(words, word characters, symbols, repeated lines, repeated words, distinct normalised lines)."""
    text = text or ""
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    raw: set[str] = set()
    lines: Counter[bytes] = Counter()
    dup = 0
    for line in text.split("\n"):
        key = line.encode().strip(b" \t\n\x0b\x0c\r").lower()
        if not key:
            continue
        dup += line in raw
        raw.add(line)
        lines[key] += len(key.split())
    return len(words), chars, symbols, dup, repeat_words(words), list(lines.items())


def document_stats(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    def make():
        def batch(cols: dict) -> dict:
            stats = [text_stats(t) for t in cols["text"]]
            out = {k: cols[k] for k in ("doc_id", "host", "rid")}
            for k, name in enumerate(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")):
                out[name] = [s[k] for s in stats]
            out["lines"] = [[{"line": k.decode(), "words": n} for k, n in s[5]] for s in stats]
            return out

        return batch

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        F.monotonically_increasing_id().alias("rid"),
        F.col(text_col).alias("text"),
    )
    hashed = F.transform(
        "lines",
        lambda x: F.struct(
            F.xxhash64(x["line"]).alias("h1"), F.xxhash64(F.lit("second"), x["line"]).alias("h2"), x["words"].alias("words")
        ),
    )
    return map_rows(rows, make, STATS).withColumn("lines", hashed)


def frequent_lines(stats: DataFrame, line_docs: int = LINE_DOCS) -> DataFrame:
    """(host, h1, h2, n_docs) of the lines over the limit of their host."""
    known = stats.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    again = known.where("n > 1").select("doc_id")
    # the rows of a repeated id share its lines; all others have each line once already
    line = [F.col("x.h1").alias("h1"), F.col("x.h2").alias("h2")]
    single = stats.join(again, "doc_id", "left_anti").select("host", F.explode("lines").alias("x")).select("host", *line)
    shared = stats.join(again, "doc_id", "left_semi").select("host", "doc_id", F.explode("lines").alias("x"))
    once = shared.select("host", "doc_id", *line).distinct().select("host", "h1", "h2")
    return (
        single.unionByName(once)
        .groupBy("host", "h1", "h2")
        .agg(F.count("*").alias("n_docs"))
        .where(F.col("n_docs") > line_docs)
    )


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    line_docs: int = LINE_DOCS,
    keep_share: float = KEEP_SHARE,
) -> DataFrame:
    """One row per document: the counts, base_failed, frequent_words (words of removed lines),
    depleted and kept."""
    stats = materialize(document_stats(docs, id_col, text_col, host_col), "quality-stats")
    frequent = frequent_lines(stats, line_docs).select(
        F.col("host").alias("host2"), F.col("h1").alias("k1"), F.col("h2").alias("k2")
    )
    removed = (
        stats.select("host", "rid", F.explode("lines").alias("x"))
        .join(
            frequent,
            (F.col("x.h1") == F.col("k1")) & (F.col("x.h2") == F.col("k2")) & F.col("host").eqNullSafe(F.col("host2")),
        )
        .groupBy("rid")
        .agg(F.sum("x.words").alias("frequent_words"))
        .withColumnRenamed("rid", "rid2")
    )
    out = stats.drop("lines", "host").join(removed, F.col("rid") == F.col("rid2"), "left")
    out = out.withColumn("frequent_words", F.coalesce("frequent_words", F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    depleted = (F.col("n_words") - F.col("frequent_words")) < keep_share * F.col("n_words")
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "frequent_words", depleted.alias("depleted"),
    )
