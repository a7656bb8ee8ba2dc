"""Phrase collocations by prefix-free parsing.

Method.
1. Texts are split into pieces and words. A piece is cut where a hash of two neighbouring words, so its content
   alone, is a trigger; each chunk goes on for `n_max` - 1 words after its last own word. Equal passages give
   equal chunks wherever they stand. A map-side combined sum makes the dictionary: distinct chunks and how often each was parsed.
2. n-grams are counted inside distinct chunks, weighted by the chunk's frequency. An n-gram belongs to the
   chunk that owns its first word, so the overlaps are counted once and no n-gram is cut.
3. Single words are counted first, then pairs, then all longer phrases. A phrase can only reach `min_count` if
   all its words and pairs do, so the frequent words and the frequent pairs are hashed into a bitmap of fixed size
   each (`FILTER_BITS`), which the tasks of later passes use to leave out phrases early. The bitmaps only
   save work: hash collisions let too much through, never too little, and the exact sum decides.
4. Candidates (2 to `n_max` words) are joined with the counts of the parts of every cut; the score
   is floor(1000 * a * n / (l * r)) in decimals of 38 digits. A candidate goes if a longer one that contains it is as
   frequent. Such a longer one has only phrases between the two in it that are as frequent as well, so looking at
   phrases of one word more is enough.
5. The first `top` of each language, ordered by rows that every task has already cut down to `top`.

Bytes are handled as they are: A-Z are lower-cased, `[.,;:!?\\x0A-\\x0D]` end a piece, space and tab end a word.
All counting is keyed by the phrase itself, not by a hash.

Defined cases. Null or empty texts have no words; null languages are `und`. Repeated rows count every time. A text
without separators is one word, a piece of any length is cut into chunks of at most `MAX_OWN` own words. An empty
table, or one without frequent phrases, gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starfold.session import materialize

UNKNOWN = "und"
# One pair of words in so many is a trigger.
TRIGGER = 16
MAX_OWN = 256
# Bits of the bitmap of frequent phrases, 8 MB at most for each length.
FILTER_BITS = 1 << 26
BLOCK_BITS = 32768
# Chunks that a task sums up before it hands the n-grams on.
HELD = 1_000_000

TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" "
)


class Hashes(dict):
    """Hash of each word, computed once."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = zlib.crc32(word) >> 8
        return value


def cut_piece(words: list[bytes], overlap: int, hashes: Hashes) -> list[tuple[bytes, bool]]:
    """Chunks of a piece, and whether words after the chunk's own ones follow in it."""
    marks = list(map(hashes.__getitem__, words[: len(words) - overlap]))
    out = []
    start = 0
    for i in [i for i, (a, b) in enumerate(zip(marks, marks[1:]), 1) if not (5 * a + b) % TRIGGER]:
        while i - start > MAX_OWN:
            out.append((b" ".join(words[start : start + MAX_OWN + overlap]), True))
            start += MAX_OWN
        out.append((b" ".join(words[start : i + overlap]), True))
        start = i
    while len(words) - overlap - start > MAX_OWN:
        out.append((b" ".join(words[start : start + MAX_OWN + overlap]), True))
        start += MAX_OWN
    out.append((b" ".join(words[start:]), False))
    return out


def dictionary(docs: DataFrame, n_max: int) -> DataFrame:
    """(lang, chunk, open, weight): distinct chunks; the last `n_max` - 1 words of open ones belong to the next chunk."""
    target = pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("open", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            chunks: list[bytes] = []
            opens: list[bool] = []
            ends: list[int] = []
            for text in batch.column(1).to_pylist():
                for piece in text.translate(TABLE).split(b"\n"):
                    words = piece.split()
                    if len(words) > n_max:
                        for chunk, more in cut_piece(words, n_max - 1, hashes):
                            chunks.append(chunk)
                            opens.append(more)
                    elif words:
                        chunks.append(b" ".join(words))
                        opens.append(False)
                ends.append(len(chunks))
            if len(hashes) > HELD:
                hashes.clear()
            owner = np.repeat(np.arange(len(ends)), np.diff([0, *ends]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array(chunks, pa.binary()).cast(pa.string()), pa.array(opens, pa.bool_())],
                schema=target,
            )

    plain = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    chunks = plain.mapInArrow(run, "lang string, chunk string, open boolean")
    return chunks.groupBy("lang", "chunk", "open").agg(F.count(F.lit(1)).alias("weight"))


def hash_column() -> Column:
    """Place of a phrase in the bitmap, from the columns lang and phrase."""
    return F.crc32(F.concat(F.col("lang"), F.lit("\t"), F.col("phrase")).cast("binary")) % F.lit(FILTER_BITS)


def bitmap(frequent: DataFrame) -> np.ndarray:
    """One byte string of FILTER_BITS bits, set where a frequent phrase hashes to."""
    h = hash_column() + 1  # bucket numbers start at 1 for positive values
    blocks = (
        frequent.groupBy(F.bitmap_bucket_number(h).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(h)).alias("bits"))
        .toLocalIterator()
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in blocks:
        start = (row["bucket"] - 1) * (BLOCK_BITS // 8)
        bits = np.frombuffer(row["bits"], np.uint8)
        out[start : start + len(bits)] |= bits
    return out


def passes(lang: str, texts: pa.Array, bits: np.ndarray) -> np.ndarray:
    """Whether each phrase may be frequent; one more entry for places without a phrase."""
    head = zlib.crc32(lang.encode() + b"\t")
    h = np.array([zlib.crc32(t, head) for t in texts.cast(pa.binary()).to_pylist()], np.int64) % FILTER_BITS
    return np.append((bits[h >> 3] >> (h & 7)) & 1 == 1, False)


def count_grams(
    lang: str, chunks: pa.Array, opens: np.ndarray, weights: np.ndarray, n_max: int, lengths: range, filters: list[np.ndarray]
) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Phrases of each of `lengths` in chunks of one language, where the filters of shorter ones let them pass, and
    their weights. All arrays have one entry per word; gram holds local numbers of the phrases that start there."""
    split = pc.split_pattern(chunks, " ")
    coded = split.flatten().dictionary_encode()
    words = texts = coded.dictionary
    gram = coded.indices.to_numpy().astype(np.int64)
    last = np.arange(len(words))  # number of the last word of each phrase
    sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
    ends = np.cumsum(sizes)
    place = np.arange(len(gram))
    left = np.repeat(ends, sizes) - place
    own = sizes - (n_max - 1) * opens
    owned = place < np.repeat(ends - sizes + own, sizes)
    weight = np.repeat(weights, sizes)
    at = place
    for k in range(1, lengths[-1] + 1):
        if k > 1:
            # two phrases of k - 1 words at neighbouring places make one of k words
            at = at[(left[at] >= k)]
            if k - 2 < len(filters):
                passed = passes(lang, texts, filters[k - 2])
                at = at[passed[gram[at]] & passed[gram[at + 1]]]
            else:
                at = at[gram[at + 1] < len(texts)]
            inverse, codes = pd.factorize((gram[at] << 32) | gram[at + 1])
            heads, tails = codes >> 32, codes & 0xFFFFFFFF
            last = last[tails]
            texts = pc.binary_join_element_wise(texts.take(pa.array(heads)), words.take(pa.array(last)), " ")
            gram = np.full(len(gram), len(texts), np.int64)  # no phrase
            gram[at] = inverse
        if k in lengths:
            counted = at[owned[at]]
            # sums of a task's whole numbers stay far below 2**53, where doubles are exact
            total = np.bincount(gram[counted], weight[counted], len(texts)).astype(np.int64)
            yield texts, total


def gram_counts(chunks: DataFrame, lengths: range, n_max: int, filters, held_rows: int = HELD) -> DataFrame:
    """(lang, phrase, f) for phrases of the given lengths; with length 1 the phrase '' has the number of all words."""
    target = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])

    def give(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        langs = table.column("lang").combine_chunks().dictionary_encode()
        numbers = langs.indices.to_numpy()
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            mine = table if len(langs.dictionary) == 1 else table.take(pa.array(np.flatnonzero(numbers == i)))
            opens, weights = (mine.column(c).to_numpy().astype(np.int64) for c in ("open", "weight"))
            parts = count_grams(
                lang, mine.column("chunk").combine_chunks(), opens, weights, n_max, lengths, filters.value if filters else []
            )
            for n, (texts, total) in zip(lengths, parts, strict=True):
                if n == 1:
                    texts, total = pa.concat_arrays([texts, pa.array([""], texts.type)]), np.append(total, total.sum())
                hit = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(hit)), texts.take(pa.array(hit)).cast(pa.string()), pa.array(total[hit], pa.int64())],
                    schema=target,
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size > held_rows:
                yield from give(held)
                held, size = [], 0
        if held:
            yield from give(held)

    counted = chunks.select("lang", "chunk", "open", "weight").mapInArrow(run, "lang string, phrase string, f long")
    # a task's phrases are distinct already, so they are summed once, after the shuffle
    return counted.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(
    docs: DataFrame, n_max: int = 5, min_count: int = 100, held_rows: int = HELD
) -> DataFrame:
    """(lang, phrase, n_words, f): all phrases of up to n_max words found min_count times or more in a
    language, as a written table. n_words = 0 holds each language's number of words."""
    sc = docs.sparkSession.sparkContext
    chunks = materialize(dictionary(docs, n_max), "phrases-chunks")
    tables: list[DataFrame] = []
    bits: list[np.ndarray] = []
    shared = None
    for lengths in (range(1, 2), range(2, 3), range(3, n_max + 1)):
        if not len(lengths) or lengths[0] > n_max:
            continue
        found = gram_counts(chunks, lengths, n_max, shared, held_rows)
        kept = found.where((F.col("f") >= min_count) | (F.col("phrase") == ""))
        size = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
        table = materialize(kept.withColumn("n_words", size), f"phrases-{lengths[0]}")
        tables.append(table)
        if lengths[-1] < n_max:
            bits.append(bitmap(table.where("n_words > 0")))
            if shared:
                shared.unpersist()
            shared = sc.broadcast(list(bits))
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out.select("lang", "phrase", "n_words", "f")


def part(words: Column, start: Column | int, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame, n_max: int = 5, min_count: int = 100, top: int = 2000, held_rows: int = HELD
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases."""
    table = frequent_phrases(docs, n_max, min_count, held_rows)
    counts = table.where("n_words > 0").select("lang", "phrase", "f")
    totals = table.where("n_words = 0").select("lang", F.col("f").alias("n"))
    phrases = table.where("n_words > 1").select("lang", "phrase", "n_words", F.col("f").alias("a"))
    words = F.split("phrase", " ")
    longer = (
        phrases.where("n_words > 2")
        .withColumn("inner", F.explode(F.array(part(words, 1, F.col("n_words") - 1), part(words, 2, F.col("n_words") - 1))))
        .groupBy("lang", F.col("inner").alias("phrase"))
        .agg(F.max("a").alias("most"))
    )
    kept = phrases.join(longer, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most") < F.col("a"))
    )
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    parts = cuts.select(
        "lang", "phrase", "a", "k",
        part(words, 1, F.col("k")).alias("head"),
        part(words, F.col("k") + 1, F.col("n_words") - F.col("k")).alias("tail"),
    )
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    joined = parts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    exact = F.expr(
        "(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    )
    best = (
        joined.select("lang", "phrase", F.struct(exact.alias("score"), "k", "l", "r", "a", "n").alias("cut"))
        .groupBy("lang", "phrase")
        .agg(F.min("cut").alias("cut"))
        .select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
