"""Line dedup across documents, with DataFrame functions only.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased. A key of at
least `min_chars` code points found in two or more documents keeps its lines only in the first
document (the smallest id); all lines of other documents with that key go.

Method. Every line becomes one row of two 64-bit hashes, document and position. The rows are
range-partitioned by hash, sorted by (document, position) within it, and streamed: a running first
value names the first document of a hash. A line that sits in a third of all documents would fill
one range, so this is done twice: first per (hash, salt of the document), where every row that is
not in the salt's first document is already known to go; then per hash among the first documents
of the salts, which are at most `SALTS` documents a hash. Decisions return as compressed bitmaps,
one per document: the runs [first, last] of dropped line numbers. Text is never shuffled for the
decision, only joined once with the bitmaps when it is rewritten.

Defined cases. Null text counts as empty and stays null in `apply_bitmaps`. An empty text is one
empty line. Rows with a null id are one document that comes after all others. Repeated rows (same
id, same text) get the same decision; rows of one id with different texts are one document for
counting. Empty tables give empty results. Other columns are passed through `apply_bitmaps`
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starfold.llm.common import ASCII_SPACE, ascii_lower, fresh
from starfold.session import materialize

SALTS = 64


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(h1, h2, doc, th, pos) of every line whose key is long enough."""
    rows = docs.select(
        F.col(id_col).alias("doc"),
        F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("th"),
        F.posexplode(text_lines(F.col(text_col))).alias("pos", "line"),
    )
    rows = rows.where(F.length("line") >= min_chars).select(
        "doc", "th", "pos", ascii_lower(F.trim(F.col("line"), F.lit(ASCII_SPACE))).alias("key")
    )
    return rows.where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc", "th", "pos"
    )


def _streamed_first(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with `first`: is the row in the first document of its key?"""
    ordered = (
        Window.partitionBy(*keys)
        .orderBy(F.col("doc").asc_nulls_last(), "pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.repartitionByRange(*keys).withColumn(
        "first", F.col("doc").eqNullSafe(F.first("doc").over(ordered))
    )


def dropped_lines(keys: DataFrame) -> DataFrame:
    """(doc, th, pos) of the lines that go. `keys` comes from `line_keys`."""
    salted = keys.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
    local = materialize(_streamed_first(salted, ["h1", "h2", "salt"]).drop("salt"), "line-salt-firsts")
    overall = _streamed_first(local.where("first").drop("first"), ["h1", "h2"])
    return local.where("not first").drop("first").unionByName(
        overall.where("not first").drop("first")
    ).select("doc", "th", "pos")


def line_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10
) -> DataFrame:
    """(doc, th, n_dropped, runs) of every document that loses lines.

    `th` is the hash of the text, `runs` the bitmap: an array of (a, b), first and last dropped
    line of each run, from 0.
    """
    keys = materialize(line_keys(docs, id_col, text_col, min_chars), "line-keys")
    per_doc = (
        dropped_lines(keys)
        .groupBy("doc", "th")
        .agg(F.sort_array(F.collect_set("pos")).alias("p"))
    )
    starts = F.filter("p", lambda x, i: (i == 0) | (F.get("p", i - 1) != x - 1))
    ends = F.filter("p", lambda x, i: (i == F.size("p") - 1) | (F.get("p", i + 1) != x + 1))
    return per_doc.select(
        "doc", "th", F.size("p").alias("n_dropped"), F.arrays_zip(starts.alias("a"), ends.alias("b")).alias("runs")
    )


def _mask(runs: Column, n: Column) -> Column:
    """The bitmap spelt out: an array of `n` booleans, true where the line stays."""
    pieces = F.transform(
        runs,
        lambda r, i: F.concat(
            F.array_repeat(
                F.lit(True), (r["a"] - F.when(i == 0, F.lit(0)).otherwise(F.get(runs, i - 1)["b"] + 1)).cast("int")
            ),
            F.array_repeat(F.lit(False), (r["b"] - r["a"] + 1).cast("int")),
        ),
    )
    tail = F.array_repeat(F.lit(True), (n - 1 - F.element_at(runs, -1)["b"]).cast("int"))
    return F.concat(F.flatten(pieces), tail)


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, str]:
    """`docs` with the dropped lines taken out of the text, and the name of a column that holds
    the number of dropped lines. Documents without a bitmap keep their text as it is."""
    doc, th, runs, dropped = (fresh(docs, f"sf_{n}") for n in ("doc", "th", "runs", "dropped"))
    maps = bitmaps.select(
        F.col("doc").alias(doc), F.col("th").alias(th), F.col("runs").alias(runs), F.col("n_dropped").alias(dropped)
    )
    joined = docs.join(
        maps,
        docs[id_col].eqNullSafe(maps[doc]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == maps[th]),
        "left",
    )
    lines, mask = fresh(docs, "sf_lines"), fresh(docs, "sf_mask")
    joined = joined.withColumn(
        lines, F.when(F.col(runs).isNotNull(), text_lines(F.col(text_col)))
    ).withColumn(mask, F.when(F.col(runs).isNotNull(), _mask(F.col(runs), F.size(lines))))
    kept = F.array_join(F.filter(F.col(lines), lambda _, i: F.get(F.col(mask), i)), "\n")
    text = F.when(F.col(runs).isNull(), F.col(text_col)).otherwise(kept)
    out = [
        text.alias(c) if c == text_col else F.col(c) for c in docs.columns
    ]
    return joined.select(*out, F.coalesce(dropped, F.lit(0)).cast("long").alias(dropped)), dropped


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10
) -> tuple[DataFrame, str]:
    """The documents without repeated lines; see `apply_bitmaps` for the result."""
    return apply_bitmaps(docs, line_bitmaps(docs, id_col, text_col, min_chars), id_col, text_col)
