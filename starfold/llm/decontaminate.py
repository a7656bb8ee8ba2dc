"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

A document is contaminated by a benchmark item when some `WINDOW` consecutive words of the item (all
of it, if shorter) stand in the document at the same distances with at least `PERCENT` per cent of
the words equal; the others may be substituted.

Method. Words are lower-cased runs of letters and digits. A spaced seed is a fixed mask over
consecutive words; masked-out places are ignored, so a substitution there doesn't break the seed.
Seeds of all masks at all places of the items are hashed, the same is done at every place of every
document, and the hashes are joined. Each hit fixes an alignment of item and document; around it
the words are compared place by place and the best window is counted.

Words are hashed once per document; places are exploded inside generated code, where a seed is a
few array reads and one hash. The benchmark's seed table is sent to the tasks only when its counted size
is within `BROADCAST_SEEDS` rows; a larger one is joined by shuffle, and Spark splits seeds that
are very frequent. Only hits leave the scan; they carry the few word hashes that the
comparison needs, so document texts are not shuffled.

Chance of a miss. An unchanged window holds every seed. With a fifth of the words substituted at random places
a window of 13 words has no seed of the four masks in a few per cent of cases; longer overlaps have
far more seeds.

Short items. Items of fewer than `MIN_WORDS` words are too short for seeds. With `short` they match where
all their words stand in the document in a row, unchanged: runs of each length that items have are
hashed and joined like seeds. Without it they match nothing.

Defined cases. Null or empty texts match nothing, and items without words neither. Repeated rows and ids, also null ids, are each reported
under their id; equal rows give one row. Empty tables give empty results.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import fresh
from starfold.session import materialize

# Fixed masks: 1 is compared, 0 is ignored.
MASKS = ("11111", "1101011", "10110011", "110010101")
WINDOW = 13
PERCENT = 80
MIN_WORDS = 8
BROADCAST_SEEDS = 1_000_000


def word_hashes(text: Column) -> Column:
    """Array of the 64-bit hashes of a text's words."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1)
    return F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w))


def seeds_at(hashes: str, pos: str) -> Column:
    """Array of the seed hashes of all masks at a place; null where the mask reaches past the end."""
    out = []
    for k, mask in enumerate(MASKS):
        parts = [F.get(F.col(hashes), F.col(pos) + o) for o, bit in enumerate(mask) if bit == "1"]
        out.append(F.when(parts[-1].isNotNull(), F.xxhash64(F.lit(k), *parts)))
    return F.array(*out)


def seed_places(rows: DataFrame, hashes: str = "hashes") -> DataFrame:
    """`rows` with pos and seed: one row for every place and mask."""
    return (
        rows.select("*", F.posexplode(hashes).alias("pos", "word"))
        .select("*", F.explode(seeds_at(hashes, "pos")).alias("seed"))
        .where("seed is not null")
        .drop("word")
    )


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    percent: int = PERCENT,
    short: bool = False,
) -> DataFrame:
    """(doc_id, th, item_id, n_window, n_equal, first_word): the contaminated documents and the
    best window with each item; `th` is the hash of the document's text."""
    every = materialize(
        benchmark.select(F.col(item_col).alias("item_id"), word_hashes(F.col(item_text_col)).alias("hashes")).where(
            F.size("hashes") > 0
        ),
        "benchmark-items",
    )
    items = every.where(F.size("hashes") >= MIN_WORDS)
    seeds = materialize(
        seed_places(items).select("seed", "item_id", F.col("pos").alias("item_pos"), F.size("hashes").alias("n")),
        "benchmark-seeds",
    )
    if seeds.count() <= BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("th"),
        word_hashes(F.col(text_col)).alias("hashes"),
    )
    start = F.col("pos") - F.col("item_pos")
    low = F.greatest(start, F.lit(0))
    hits = (
        seed_places(rows)
        .join(seeds, "seed")
        .select(
            "doc_id", "th", "item_id", start.alias("start"), low.alias("low"),
            F.slice("hashes", low + 1, F.col("n") + start - low).alias("part"),
        )
    )
    hits = materialize(hits.dropDuplicates(["doc_id", "th", "item_id", "start"]), "benchmark-hits")
    item = items.select(F.col("item_id").alias("item2"), F.col("hashes").alias("item"))
    aligned = hits.join(item, F.col("item_id").eqNullSafe(F.col("item2")))
    shift = F.col("low") - F.col("start")
    aligned = aligned.withColumn(
        "equal",
        F.transform("item", lambda w, i: F.coalesce((F.get("part", (i - shift).cast("int")) == w) & (i >= shift), F.lit(False)).cast("int")),
    )
    width = F.least(F.lit(window), F.size("item"))
    scored = aligned.select(
        "doc_id", "th", "item_id", "low", width.alias("n_window"),
        F.array_max(
            F.transform(
                F.sequence(F.lit(1), F.size("equal") - width + 1),
                lambda at: F.aggregate(F.slice("equal", at, width), F.lit(0), lambda a, x: a + x),
            )
        ).alias("n_equal"),
    )
    found = (
        scored.where(100 * F.col("n_equal") >= percent * F.col("n_window"))
        .groupBy("doc_id", "th", "item_id")
        .agg(F.first("n_window").alias("n_window"), F.max("n_equal").alias("n_equal"), F.min("low").alias("first_word"))
    )
    few = every.where(F.size("hashes") < MIN_WORDS)
    lengths = sorted(r[0] for r in few.select(F.size("hashes")).distinct().collect()) if short else []  # under MIN_WORDS
    return found.unionByName(short_matches(rows, few, lengths)) if lengths else found


def short_matches(rows: DataFrame, few: DataFrame, lengths: list[int]) -> DataFrame:
    """The columns of `overlaps` for items whose words all stand in a row in a document."""

    def run(hashes: str, pos: Column, n: int) -> Column:
        parts = [F.get(F.col(hashes), pos + k) for k in range(n)]
        return F.when(parts[-1].isNotNull(), F.xxhash64(F.lit(n), *parts))

    size = F.size("hashes")
    item = few.select(
        "item_id", F.col("hashes").alias("item"), F.coalesce(*(F.when(size == n, run("hashes", F.lit(0), n)) for n in lengths)).alias("run")
    )
    runs = rows.select("*", F.posexplode("hashes").alias("pos", "word")).select(
        "*", F.explode(F.array(*(run("hashes", F.col("pos"), n) for n in lengths))).alias("run")
    )
    n_words = F.size("item").alias("n_words")
    return (
        runs.where("run is not null")
        .join(item, "run")
        .where(F.slice("hashes", F.col("pos") + 1, F.size("item")) == F.col("item"))
        .select("doc_id", "th", "item_id", "pos", n_words)
        .groupBy("doc_id", "th", "item_id")
        .agg(F.first("n_words").alias("n_window"), F.first("n_words").alias("n_equal"), F.min("pos").alias("first_word"))
    )


def least_equal(window: int = WINDOW, percent: int = PERCENT) -> int:
    return ceil(window * percent / 100)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", short: bool = False
) -> DataFrame:
    """The documents, as they are, without those that overlap with a benchmark item."""
    d, t = fresh(docs, "sf_doc"), fresh(docs, "sf_text")
    bad = overlaps(docs, benchmark, id_col, text_col, short=short).select(F.col("doc_id").alias(d), F.col("th").alias(t)).distinct()
    return docs.join(
        bad,
        docs[id_col].eqNullSafe(bad[d]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == bad[t]),
        "left_anti",
    )
