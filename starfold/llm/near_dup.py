"""Near-duplicate documents by banded MinHash, odd sketches and exact confirmation.

Two documents are linked when 100 * |A and B| >= `percent` * |A or B| for their sets of word
shingles; the result is the connected component of every document.

Method.
1. One pass over the texts gives each document its shingle set, as a key (hash of the whole set),
   MinHash bands, and an odd sketch: every value of the bottom-`SAMPLES` MinHash sample flips one bit
   of a parity map. Texts are not kept.
2. Documents with the same set are one class from here on, represented by the smallest id.
3. Classes that share a band are candidates. The XOR of two sketches never has more bits than the
   samples differ in, so a pair with more bits than the threshold allows is no link. Of sets of
   up to `SAMPLES` shingles the sample is the whole set: for them nothing is lost; for larger sets
   the limit leaves six standard deviations of the sample.
4. In `ROUNDS` rounds one member of each band bucket is its hub and the other members are paired
   with it, so a bucket of n classes gives n - 1 pairs; each member keeps its closest hub. These
   pairs are confirmed on the full shingle sets of both texts, and joined to components.
5. Buckets that then still hold several components are looked at whole: all pairs of members of
   different components within the sketch limit, each pair in the first band it shares, are
   confirmed on the full sets. So every candidate pair is tested or lies within one component.
   Components of all confirmed links are the result.

Chances. The number of bands is set so that a pair at the threshold shares none with a chance of at
most 1e-7. More similar pairs have smaller chances. Nothing is capped.

Scale. Buckets are counted by partial aggregates; the hub comes back by an equi-join that Spark
may split, so a bucket with a third of all classes is dealt to many tasks. Texts travel only for
pairs that passed the sketch.

Defined cases. Null or wordless texts have no shingles and are linked with nothing. Rows of one id
are one document for the components (linked through the id); every row is returned. Rows with a null
id are linked with nothing, have no component and are kept. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import fresh, pa_schema
from starfold.llm.components import components
from starfold.llm.shingles import MinHash, mix, shingle_hashes, shingle_set
from starfold.session import materialize

WORDS = 5
PERCENT = 80
MISS = 1e-7
SKETCH_BITS = 2048
SAMPLES = 4096
ROUNDS = 3

SETS = "doc_id long, th long, n_shingles long, set_key binary, bands array<long>, sketch array<long>"


def band_shape(percent: int) -> tuple[int, int]:
    """(rows, bands) that miss a pair at the threshold with a chance of at most MISS."""
    t = percent / 100
    rows = 6 if percent >= 85 else 5 if percent >= 75 else 3
    return rows, ceil(log(MISS) / log(1 - t**rows))


def document_sets(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    target = pa_schema(docs.sparkSession, SETS)
    rows, bands = band_shape(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash(rows * bands)
        salts = np.arange(1, bands + 1, dtype=np.uint64)
        for batch in batches:
            out: list[list] = [[] for _ in target]
            for doc, th, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = shingle_hashes(text, size)
                if len(hashes):
                    least = minhash(hashes).astype(np.uint64)
                    key = salts
                    for r in range(rows):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least[r::rows])
                    # The hashes are sorted: the first ones are the bottom sample.
                    flips = (hashes[:SAMPLES] % np.uint64(SKETCH_BITS)).astype(np.int64)
                    bits = np.bincount(flips, minlength=SKETCH_BITS)
                    sketch = np.packbits((bits & 1).astype(np.uint8)).view(np.int64)
                    row = (doc, th, len(hashes), hashlib.blake2b(hashes.tobytes(), digest_size=16).digest(), key.view(np.int64), sketch)
                else:
                    row = (doc, th, 0, None, None, None)
                for col, v in zip(out, row, strict=True):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(out, target, strict=True)], schema=target
            )

    return docs.select(F.col(id_col).cast("long"), F.xxhash64(text_col), text_col).mapInArrow(run, SETS)


def xor_bits(a: str, b: str) -> Column:
    words = [F.bit_count(F.get(a, k).bitwiseXOR(F.get(b, k))) for k in range(SKETCH_BITS // 64)]
    total = words[0]
    for w in words[1:]:
        total = total + w
    return total


def bit_limit(na: str, nb: str, percent: int) -> Column:
    """Most XOR bits of two sets of na and nb shingles that may reach the threshold."""
    least = (F.col(na) + F.col(nb)) * (percent / (100 + percent))  # shingles in common
    large = F.greatest(na, nb)
    sampled = SAMPLES * least / large - 6 * SAMPLES**0.5 / 2
    common = F.when(large > SAMPLES, sampled).otherwise(least)
    return F.least(F.col(na), F.lit(SAMPLES)) + F.least(F.col(nb), F.lit(SAMPLES)) - 2 * common


def confirm(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold; rows of one id are one document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=64)
        def full(text: str) -> set:  # the text of a hub comes with each of its members
            return shingle_set(text, size)

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
                a, b = full(x), shingle_set(y, size)
                shared = len(a & b)
                keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))

    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).join(ids, "id", "left_semi")
    with_b = pairs.join(texts.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b")
    with_a = with_b.join(texts.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a")
    return with_a.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _side(classes: DataFrame, name: str, *more: str) -> DataFrame:
    """The class columns of one end of a pair, named after it."""
    cols = {"id": name, "n": f"n{name}", "sketch": f"s{name}", "bands": f"bands_{name}"}
    return classes.select(*[F.col(c).alias(cols[c]) for c in ("id", "n", "sketch", *more)])


def _closest_hubs(mixed: DataFrame, classes: DataFrame, percent: int, turn: int) -> DataFrame:
    """(a, b): for every member its closest hub of another component, within the sketch limit."""
    rank = F.struct(F.col("id") if turn == 0 else F.xxhash64(F.lit(turn), "id"), F.col("id").alias("a"), F.col("component").alias("ca"))
    hubs = mixed.groupBy("band", "h").agg(F.min(rank).alias("hub")).select("band", "h", "hub.a", "hub.ca")
    stars = mixed.join(materialize(hubs, "near-bucket-hubs"), ["band", "h"])
    stars = stars.where("component != ca").select("a", F.col("id").alias("b")).distinct()
    pairs = stars.join(_side(classes, "b"), "b").join(_side(classes, "a"), "a")
    pairs = pairs.withColumn("bits", xor_bits("sa", "sb")).where(F.col("bits") <= bit_limit("na", "nb", percent))
    return pairs.groupBy("b").agg(F.min(F.struct("bits", "a")).alias("best")).select("best.a", "b")


def _grown(nodes: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after more links."""
    if nodes is not None:
        stars = nodes.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        links = links.unionByName(stars)
    return materialize(components(links), "near-labels")


def _mixed(buckets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components, with their component."""
    label = nodes.select(F.col("node").alias("id"), "component")
    labelled = materialize(
        buckets.join(label, "id", "left").withColumn("component", F.coalesce("component", "id")), "near-labelled"
    )
    several = labelled.groupBy("band", "h").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    several = materialize(several.where("lo < hi").select("band", "h"), "near-several")
    return labelled.join(several, ["band", "h"], "left_semi")


def _cross_pairs(mixed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of bucket members of different components within the sketch limit."""
    one = mixed.select("band", "h", F.col("id").alias("a"), F.col("component").alias("ca")).join(_side(classes, "a", "bands"), "a")
    two = mixed.select("band", "h", F.col("id").alias("b"), F.col("component").alias("cb")).join(_side(classes, "b", "bands"), "b")
    first = ~F.when(F.col("band") == 0, F.lit(False)).otherwise(
        F.exists(
            F.zip_with(F.slice("bands_a", F.lit(1), F.col("band")), F.slice("bands_b", F.lit(1), F.col("band")), lambda x, y: x == y),
            lambda same: same,
        )
    )
    return (
        one.join(two, ["band", "h"])
        .where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")))
        .where(xor_bits("sa", "sb") <= bit_limit("na", "nb", percent))
        .where(first)
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, th), one row per document row; `th` is the hash of
    the row's text."""
    sets = materialize(document_sets(docs, id_col, text_col, size, percent), "near-sets")
    known = sets.where("doc_id is not null and n_shingles > 0")
    classes = materialize(
        known.groupBy("set_key").agg(
            F.min("doc_id").alias("id"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        ),
        "near-classes",
    )
    members = classes.select("id", F.posexplode("bands").alias("band", "h"))
    shared = members.groupBy("band", "h").agg(F.count("*").alias("k")).where("k > 1").select("band", "h")
    buckets = materialize(members.join(materialize(shared, "near-shared"), ["band", "h"]), "near-buckets")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).where("id is not null")

    # The components found so far stand for their links as stars (node, component).
    mixed, nodes = buckets.withColumn("component", F.col("id")), None
    for turn in range(ROUNDS):
        close = materialize(_closest_hubs(mixed, classes, percent, turn), "near-hubs")
        new = materialize(confirm(close, texts, "id", "t", size, percent), "near-links")
        if nodes is not None and new.isEmpty():
            break  # what other hubs could find is left to the last step
        nodes = _grown(nodes, new)
        mixed = materialize(_mixed(buckets, nodes), "near-mixed")
    rest = materialize(_cross_pairs(mixed, classes, percent), "near-cross")
    late = materialize(confirm(rest, texts, "id", "t", size, percent), "near-late")
    if not late.isEmpty():
        nodes = _grown(nodes, late)

    found = classes.join(nodes, classes["id"] == nodes["node"], "left").select(
        F.col("set_key").alias("k"), F.coalesce("component", "id").alias("component_id")
    )
    out = sets.join(found, (F.col("set_key") == F.col("k")) & F.col("doc_id").isNotNull(), "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "th"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The documents, as they are, with one document of each component.

    Rows without words or without an id stay. Of several rows of one id with words, one row of the
    text with the smallest hash stays.
    """
    found = materialize(near_duplicates(docs, id_col, text_col, size, percent), "near-result")
    d, t = fresh(docs, "sf_doc"), fresh(docs, "sf_text")
    this = docs[id_col].cast("long")

    def same(right: DataFrame) -> Column:
        return (this == right[d]) & (F.xxhash64(docs[text_col]) == right[t])

    gone = found.where("not kept").select(F.col("doc_id").alias(d), F.col("th").alias(t)).distinct()
    out = docs.join(gone, same(gone), "left_anti")
    words = found.where("kept and n_shingles > 0 and doc_id is not null")
    many = words.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("th").alias(t)).where("n > 1")
    many = materialize(many.select(F.col("doc_id").alias(d), t), "near-repeated")
    if many.isEmpty():
        return out
    single = words.join(many, words["doc_id"] == many[d], "left_semi").select(F.col("doc_id").alias(d), F.col("th").alias(t)).distinct()
    once = docs.join(many, same(many), "left_semi").dropDuplicates([id_col])
    return out.join(single, same(single), "left_anti").unionByName(once)
