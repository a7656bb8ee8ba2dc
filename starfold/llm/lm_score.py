"""Masked pseudo-likelihood scores from a bidirectional window network, trained in numpy.

Method. The network predicts a word from the `REACH` words on either side: embeddings are
concatenated, one tanh layer follows, and the output is factored into the class of a word and its
place in the class, so probabilities are normalised at the cost of two small softmaxes. The most
frequent `WORDS` words are places of their own, the others share `BUCKETS` hash buckets; inside its
bucket a word has its share of the bucket's count in the corpus, so every word of the corpus has its
own probability and all of them add up to 1. A document's score is the sum of the log-probabilities
of all its words, each given both sides; the mean per word makes documents comparable.

What grows with the corpus. Documents are encoded once into shards: a list of the shard's words and
the compressed place of every token in it. All words with their numbers and counts, and an embedding
row for each word outside the `WORDS` that is seen `SEEN` times or more, used in place of the
embedding of its bucket, are Spark tables. Words meet their numbers once; later passes join rows to shards by number,
learn them there and average them by an aggregate, so no task and not the driver holds a vocabulary.
The driver sees the frequent words, the bucket totals and the network's weights, all of fixed size.
Shards are large (`SHARD_WORDS`), because a word's row is sent once per shard that has the word.

Training covers every token: over the `ROUNDS` rounds each place of each document is a target exactly
once. In a round each shard starts from the current weights and rows; the weights are
averaged by words learnt, the rows by their use.

What does not grow: the layer sizes and the output classes, so inside a bucket the context does not
tell words apart.

Defined cases. Null, empty or blank texts have no words: log_prob 0, mean null. Repeated rows and
ids are scored row by row. A document is never cut: one longer than a shard is a shard by itself, some
30 bytes a word in its task. On an empty table the result is empty.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.common import pa_schema
from starfold.session import materialize

CLASSES = 32
SIZE = CLASSES * CLASSES
BUCKETS = 256
WORDS = SIZE - BUCKETS
REACH = 2
WIDTH = 16
HIDDEN = 32
ROUNDS = 2
# A shard ends at so many documents or words.
SHARD = 25_000
SHARD_WORDS = 2_000_000
# Words seen so often have an embedding row of their own.
SEEN = 5
# Words of all shards, on average, whose rows are averaged and sent in one group.
BLOCK_WORDS = 500_000
# Weights of the network that are averaged in one group.
SLICE = 1024
BATCH = 1024
RATE = 0.1
# Words that go through the network at once.
BLOCK = 2048
# Exponents of this size neither overflow nor vanish in single precision.
SAFE = 80.0
OFFSETS = np.array([k for k in range(-REACH, REACH + 1) if k])

SHAPES = {
    "embed": (SIZE + 1, WIDTH),
    "w": (2 * REACH * WIDTH, HIDDEN),
    "b": (HIDDEN,),
    "up": (HIDDEN, CLASSES),
    "up_b": (CLASSES,),
    "low": (HIDDEN, CLASSES),
    "low_b": (CLASSES, CLASSES),
}
VECTOR = [f"v{k}" for k in range(WIDTH)]
SHARDS = "doc_ids array<long>, lengths array<long>, tokens binary, size int, words array<string>, counts array<long>"
# Words of a shard in a block; the first `own` have rows, in the order of `ids`.
PLACES = "part long, block int, size int, own int, ids binary, pos binary, n binary, core binary"
GIVEN = "part long, block int, rows binary"
# A shard's rows of a block or, below 0, its weights of a slice.
LEARNT = "block int, size int, learnt double, ids binary, used binary, rows binary"
ROWS = "block int, id long, " + ", ".join(f"{v} float" for v in VECTOR)
SCORES = "doc_id long, n_words long, log_prob double, mean_log_prob double"


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


class Vocabulary:
    def __init__(self, words: list[str]) -> None:
        self.ids = {w: k for k, w in enumerate(words)}


def pack(values: np.ndarray, kind: str = "<i4") -> bytes:
    """Numbers as compressed byte planes: the upper ones are nearly constant."""
    planes = np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T)
    return pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes, size: int, kind: str = "<i4") -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, width * size, codec="zstd"), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def pack_ids(ids: np.ndarray) -> bytes:
    """Ascending numbers by their differences."""
    return pack(np.diff(ids, prepend=0), "<i8")


def unpack_ids(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(unpack(data, size, "<i8"))


def to_table(rows: list[tuple], target: pa.Schema) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], type=f.type) for k, f in enumerate(target)], schema=target)


def new_places() -> defaultdict[str, int]:
    """Every word asked for gets the next free number."""
    place: defaultdict[str, int] = defaultdict()
    place.default_factory = place.__len__
    return place


def encode_shards(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per shard: its documents' ids and lengths, its words and their counts, and the place of
    every token in these words."""
    target = pa_schema(docs.sparkSession, SHARDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        parts: list[np.ndarray] = []
        place = new_places()
        held = 0

        def row() -> pa.RecordBatch:
            tokens = np.concatenate(parts)
            counts = np.bincount(tokens, minlength=len(place))
            cells = (ids, [len(p) for p in parts], pack(tokens), len(place), list(place), counts.tolist())
            return pa.RecordBatch.from_arrays([pa.array([c], type=f.type) for c, f in zip(cells, target, strict=True)], schema=target)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                if ids and (len(ids) >= SHARD or held + len(words) > SHARD_WORDS):
                    yield row()
                    ids, parts, place, held = [], [], new_places(), 0
                ids.append(doc_id)
                parts.append(np.fromiter(map(place.__getitem__, words), dtype=np.int32, count=len(words)))
                held += len(words)
        if ids:
            yield row()

    rows = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, SHARDS)
    return materialize(rows.withColumn("shard", F.monotonically_increasing_id()), "lm-shards", release=True)


def count_words(shards: DataFrame) -> DataFrame:
    """(word, n) over all documents."""
    each = shards.select(F.explode(F.arrays_zip("words", "counts")).alias("x"))
    return materialize(each.groupBy(F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("n")), "lm-words", release=True)


def vocabulary(counts: DataFrame, size: int = WORDS) -> Vocabulary:
    top = counts.orderBy(F.desc("n"), "word").limit(size).collect()
    return Vocabulary([r["word"] for r in top])


def number_words(counts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(word, id, n, core): every word's number, corpus count and output place."""
    top = counts.sparkSession.createDataFrame(list(vocab.ids.items()), "word string, rank int")
    bucket = F.lit(WORDS) + F.crc32(F.col("word").cast("binary")) % BUCKETS
    rows = counts.join(top, "word", "left").select("word", "n", F.coalesce("rank", bucket).cast("int").alias("core"))
    return materialize(rows.withColumn("id", F.monotonically_increasing_id()), "lm-numbers", release=True)


def bucket_totals(numbers: DataFrame) -> np.ndarray:
    """Tokens of every bucket."""
    out = np.zeros(BUCKETS)
    for r in numbers.where(F.col("core") >= WORDS).groupBy("core").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        out[r["core"] - WORDS] = r["n"]
    return out


def place_words(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """The words of every shard by number, packed by block; see PLACES."""
    target = pa_schema(shards.sparkSession, PLACES)
    pairs = shards.agg(F.sum("size").alias("n")).first()["n"] or 0
    blocks = max(1, -(-pairs // BLOCK_WORDS))

    def run(near: pa.Table) -> pa.Table:
        part = near.column("part")[0].as_py()
        block, ids, pos, n, core = (near.column(c).to_numpy() for c in ("block", "id", "pos", "n", "core"))
        known = has_row(core, n)
        order = np.lexsort((ids, ~known, block))
        ends = np.flatnonzero(np.append(np.diff(block[order]) != 0, True)) + 1
        rows = []
        for at in np.split(order, ends[:-1]):
            own = int(known[at].sum())
            rows.append((part, block[at[0]], len(at), own, pack_ids(ids[at[:own]]), pack(pos[at]), pack(n[at], "<i8"), pack(core[at], "<u2")))
        return to_table(rows, target)

    places = shards.select(F.col("shard").alias("part"), F.posexplode("words").alias("pos", "word"))
    near = places.join(numbers.withColumn("block", F.pmod(F.hash("id"), F.lit(blocks)).cast("int")), "word").drop("word")
    return materialize(near.groupBy("part").applyInArrow(run, PLACES), "lm-places", release=True)


def has_row(core: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (core >= WORDS) & (n >= SEEN)


def give_rows(places: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows that every shard asks for, by block."""
    target = pa_schema(places.sparkSession, GIVEN)

    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        ids = rows.column("id").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        values = np.column_stack([rows.column(v).to_numpy() for v in VECTOR]).astype("<f2")[order]
        out = []
        for part, block, own, wanted in zip(*(asked.column(c).to_pylist() for c in ("part", "block", "own", "ids")), strict=True):
            at = np.searchsorted(ids, unpack_ids(wanted, own))
            out.append((part, block, pack(values[at].ravel(), "<f2")))
        return to_table(out, target)

    asks = places.where("own > 0").select("part", "block", "own", "ids")
    return asks.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(run, GIVEN)


def by_shard(shards: DataFrame, places: DataFrame, rows: DataFrame | None):
    """Shards next to their words and the words' rows; without `rows` all rows are zero."""
    near = places.withColumn("rows", F.lit(None).cast("binary"))
    if rows is not None:
        near = near.unionByName(give_rows(places, rows), allowMissingColumns=True)
    return shards.select("shard", "doc_ids", "lengths", "tokens").groupBy("shard").cogroup(near.groupBy("part"))


def near_words(packed: pa.Table) -> tuple[pa.Table, list[tuple[int, np.ndarray]]]:
    """(pos, id, n, core, row) of a shard's words, and the numbers of those with a row by block."""
    rows = packed.to_pylist()
    given = {r["block"]: r["rows"] for r in rows if r["rows"] is not None}
    blocks = []
    cells: dict[str, list[np.ndarray]] = {c: [np.empty(0, dtype=kind)] for c, kind in (("pos", "i4"), ("id", "i8"), ("n", "i8"), ("core", "i4"))}
    vectors = [np.empty((0, WIDTH), dtype=np.float32)]
    for r in rows:
        if r["pos"] is None:
            continue
        size, own = r["size"], r["own"]
        ids = np.zeros(size, dtype=np.int64)
        ids[:own] = unpack_ids(r["ids"], own)
        blocks.append((r["block"], ids[:own]))
        vector = np.zeros((size, WIDTH), dtype=np.float32)
        if r["block"] in given:
            vector[:own] = unpack(given[r["block"]], own * WIDTH, "<f2").reshape(-1, WIDTH)
        vectors.append(vector)
        for c, values in (("pos", unpack(r["pos"], size)), ("id", ids), ("n", unpack(r["n"], size, "<i8")), ("core", unpack(r["core"], size, "<u2").astype(np.int32))):
            cells[c].append(values)
    table = np.concatenate(vectors)
    return pa.table({c: np.concatenate(v) for c, v in cells.items()} | {v: table[:, k] for k, v in enumerate(VECTOR)}), blocks


class Shard:
    """A shard with its rows: `core` has the output place of every word, `own` its row in the embeddings of
    the network followed by `rows`."""

    def __init__(self, shard: pa.Table, near: pa.Table) -> None:
        self.doc_ids = shard.column("doc_ids")[0].values
        self.lengths = np.array(shard.column("lengths")[0].values.to_numpy(zero_copy_only=False), dtype=np.int64)
        self.tokens = unpack(shard.column("tokens")[0].as_py(), int(self.lengths.sum()))
        size = near.num_rows
        pos = near.column("pos").to_numpy()
        self.core = np.full(size + 1, SIZE, dtype=np.uint16)  # the last word stands outside the text
        self.core[pos] = near.column("core").to_numpy()
        self.n = np.ones(size, dtype=np.int64)
        self.n[pos] = near.column("n").to_numpy()
        known = np.flatnonzero(has_row(near.column("core").to_numpy(), near.column("n").to_numpy()))
        self.ids = near.column("id").to_numpy()[known]
        self.rows = np.empty((len(known), WIDTH), dtype=np.float32)
        for k, v in enumerate(VECTOR):
            self.rows[:, k] = near.column(v).to_numpy()[known]
        self.own = self.core.astype(np.int32)
        self.own[pos[known]] = SIZE + 1 + np.arange(len(known))
        docs = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)
        self.padded = np.full(len(self.tokens) + 2 * REACH * len(self.lengths), size, dtype=np.int32)
        self.at = np.arange(len(self.tokens)) + REACH * (2 * docs.astype(np.int64) + 1)
        self.padded[self.at] = self.tokens
        self.around = self.own[self.padded]
        self.turn = docs + np.arange(len(self.tokens)) - (np.cumsum(self.lengths) - self.lengths)[docs]

    def context(self, places: np.ndarray) -> np.ndarray:
        """Rows of the words around the tokens at these places."""
        return np.take(self.around, np.take(self.at, places)[:, None] + OFFSETS)

    def targets(self, turn: int, rounds: int) -> np.ndarray:
        """Places learnt in a round; over all rounds every place once."""
        return np.flatnonzero((self.turn + turn) % rounds == 0)

    def log_probs(self, net: Network, totals: np.ndarray) -> np.ndarray:
        core = self.core[:-1].astype(np.int64)
        rare = core >= WORDS
        share = np.zeros(len(core))
        share[rare] = np.log(self.n[rare]) - np.log(totals[core[rare] - WORDS])
        embed = np.concatenate([net.views["embed"], self.rows])
        out = np.empty(len(self.tokens))
        for at in range(0, len(out), BLOCK):
            places = np.arange(at, min(at + BLOCK, len(out)))
            x = np.take(embed, self.context(places), axis=0).reshape(len(places), -1)
            out[places] = net.target_log_probs(x, core[self.tokens[places]])
        return out + share[self.tokens]


def _sum_rows(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indices and the sums of their rows."""
    # Sorting numbers is several times as fast as sorting by them.
    bits = len(index).bit_length()
    keyed = np.sort((index.astype(np.int64) << bits) | np.arange(len(index)))
    order, ordered = keyed & ((1 << bits) - 1), keyed >> bits
    new = np.append(True, ordered[1:] != ordered[:-1])
    first = np.flatnonzero(new)
    out = np.take(values, np.take(order, first), axis=0)
    # Most indices stand alone; only the others are summed.
    sizes = np.diff(np.append(first, len(order)))
    several = sizes > 1
    if several.any():
        starts = np.cumsum(sizes[several]) - sizes[several]
        out[several] = np.add.reduceat(np.take(values, order[np.repeat(several, sizes)], axis=0), starts, axis=0)
    return np.take(ordered, first), out


class Network:
    """The weights, as one flat vector, with views by name."""

    def __init__(self, flat: np.ndarray | None = None) -> None:
        total = sum(int(np.prod(s)) for s in SHAPES.values())
        if flat is None:
            rng = np.random.default_rng(7)
            flat = (rng.standard_normal(total) * 0.1).astype(np.float32)
        self.flat = flat
        self.views, at = {}, 0
        for name, shape in SHAPES.items():
            n = int(np.prod(shape))
            self.views[name] = flat[at : at + n].reshape(shape)
            at += n

    @staticmethod
    def context(ids: np.ndarray) -> np.ndarray:
        """Ids of the words around every word; SIZE stands outside the text."""
        padded = np.full(len(ids) + 2 * REACH, SIZE, dtype=np.int64)
        padded[REACH:-REACH] = ids
        offsets = [k for k in range(2 * REACH + 1) if k != REACH]
        return np.stack([padded[k : k + len(ids)] for k in offsets], axis=1)

    def forward(self, context: np.ndarray, ids: np.ndarray, table: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """`table`: the embeddings and more rows below them."""
        x = np.take(self.views["embed"] if table is None else table, context, axis=0).reshape(len(context), -1)
        h, zu, zl, upper, lower = self.logits(x, ids)
        up, low = self.bounds()
        return x, h, _softmax(zu, up), _softmax(zl, low), upper, lower

    def logits(self, x: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        v = self.views
        h = x @ v["w"]
        h += v["b"]
        np.tanh(h, out=h)
        upper, lower = ids // CLASSES, ids % CLASSES
        zu = h @ v["up"]
        zu += v["up_b"]
        zl = h @ v["low"]
        zl += np.take(v["low_b"], upper, axis=0)
        return h, zu, zl, upper, lower

    def bounds(self) -> tuple[float, float]:
        """Sizes that no logit of the two layers can exceed, as hidden values lie in -1 to 1."""
        v = self.views
        up = (np.abs(v["up"]).sum(axis=0) + np.abs(v["up_b"])).max()
        return float(up), float(np.abs(v["low"]).sum(axis=0).max() + np.abs(v["low_b"]).max())

    def target_log_probs(self, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        _, zu, zl, upper, lower = self.logits(x, ids)
        up, low = self.bounds()
        return _log_softmax_at(zu, upper, up) + _log_softmax_at(zl, lower, low)

    def log_probs(self, ids: np.ndarray) -> np.ndarray:
        x = self.views["embed"][self.context(ids)].reshape(len(ids), -1)
        return self.target_log_probs(x, ids)

    def learn(
        self, context: np.ndarray, ids: np.ndarray, seen: Network, table: np.ndarray | None = None, table_seen: np.ndarray | None = None
    ) -> None:
        """One adaptive gradient step; `seen` sums squared gradients. `table` learns in place of the embeddings."""
        v = self.views
        x, h, pu, pl, upper, lower = self.forward(context, ids, table)
        n, row = len(ids), np.arange(len(ids))
        pu[row, upper] -= 1
        pl[row, lower] -= 1
        pu /= n
        pl /= n
        back = pu @ v["up"].T
        back += pl @ v["low"].T
        back *= 1 - h * h
        into = (back @ v["w"].T).reshape(-1, WIDTH)
        one_hot = np.zeros((n, CLASSES), dtype=pu.dtype)
        one_hot[row, upper] = 1
        grads = {"up": h.T @ pu, "up_b": pu.sum(axis=0), "low": h.T @ pl, "low_b": one_hot.T @ pl, "w": x.T @ back, "b": back.sum(axis=0)}
        for name, g in grads.items():
            _step(v[name], seen.views[name], None, g)
        at, total = _sum_rows(context.ravel(), into)
        if table is None:
            table, table_seen = v["embed"], seen.views["embed"]
        _step(table, table_seen, at, total)


def _step(values: np.ndarray, seen: np.ndarray, at: np.ndarray | None, grad: np.ndarray) -> None:
    """Moves the rows `at`, or all."""
    squares = grad * grad
    squares += seen if at is None else np.take(seen, at, axis=0)
    moved = RATE * grad
    moved /= np.sqrt(squares) + 1e-6
    if at is None:
        seen[...] = squares
        values -= moved
    else:
        seen[at] = squares
        values[at] = np.take(values, at, axis=0) - moved


def _softmax(z: np.ndarray, bound: float) -> np.ndarray:
    """In place; `bound` limits the size of every entry."""
    if not bound < SAFE:
        z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z *= (1 / (z @ np.ones(z.shape[1], dtype=z.dtype)))[:, None]
    return z


def _log_softmax_at(z: np.ndarray, at: np.ndarray, bound: float) -> np.ndarray:
    """Logarithm of the softmax of every row at one place of it; uses up `z`."""
    if not bound < SAFE:
        z -= z.max(axis=1, keepdims=True)
    picked = z[np.arange(len(z)), at]
    np.exp(z, out=z)
    return picked - np.log(z @ np.ones(z.shape[1], dtype=z.dtype))


def train(shards: DataFrame, places: DataFrame, rounds: int = ROUNDS) -> tuple[Network, DataFrame]:
    """Average of the shards' weights and of the words' rows, round after round."""
    spark = shards.sparkSession
    target = pa_schema(spark, LEARNT)
    net, rows = Network(), None
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((net.flat, turn))

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            flat, turn = shared.value  # noqa: B023
            near, blocks = near_words(right)
            part = Shard(left, near)
            net, seen = Network(flat.copy()), Network(np.full_like(flat, 1e-4))
            table = np.concatenate([net.views["embed"], part.rows])
            table_seen = np.full_like(table, 1e-4)
            targets = part.targets(turn, rounds)
            used = np.zeros(len(table), dtype=np.int64)
            core = part.core.astype(np.int64)
            for k in range(0, len(targets), BATCH):
                at = targets[k : k + BATCH]
                net.learn(part.context(at), core[part.tokens[at]], seen, table, table_seen)
            for k in range(0, len(targets), 16 * BLOCK):
                used += np.bincount(part.context(targets[k : k + 16 * BLOCK]).ravel(), minlength=len(used))
            net.views["embed"][:] = table[: SIZE + 1]
            whole = np.append(net.flat, np.zeros(-len(net.flat) % SLICE, dtype=np.float32)).reshape(-1, SLICE)
            out = [(-1 - k, SLICE, float(len(targets)), None, None, piece.tobytes()) for k, piece in enumerate(whole)]
            at = SIZE + 1
            for block, ids in blocks:
                own = slice(at, at + len(ids))
                out.append((block, len(ids), None, pack_ids(ids), pack(used[own]), pack(table[own].ravel(), "<f2")))
                at += len(ids)
            return to_table(out, target)

        learnt = by_shard(shards, places, rows).applyInArrow(run, LEARNT)
        found = materialize(learnt.groupBy("block").applyInArrow(average, ROWS), "lm-rows", release=True)
        mean = found.where("block < 0").orderBy(F.desc("block"), "id").select(*VECTOR).toArrow()  # the network's weights
        if mean.num_rows:
            net = Network(np.column_stack([mean.column(v).to_numpy() for v in VECTOR]).ravel()[: len(net.flat)].copy())
        rows = found.where("block >= 0")
    return net, rows


def average(key: tuple[pa.Scalar, ...], learnt: pa.Table) -> pa.Table:
    """Mean of a slice of the weights by words learnt, or of a block's rows by their use."""
    block = key[0].as_py()
    if block < 0:
        weight = np.array(learnt.column("learnt").to_pylist())
        values = np.array([np.frombuffer(b, dtype=np.float32) for b in learnt.column("rows").to_pylist()])
        mean = (weight @ values / weight.sum() if weight.any() else values[0]).reshape(-1, WIDTH)
        ids = np.arange(len(mean))
    else:
        sizes = learnt.column("size").to_pylist()
        parts = [list(zip(learnt.column(c).to_pylist(), sizes, strict=True)) for c in ("ids", "used", "rows")]
        ids = np.concatenate([unpack_ids(b, n) for b, n in parts[0]])
        weight = np.concatenate([unpack(b, n) for b, n in parts[1]]).astype(np.float64)
        values = np.concatenate([unpack(b, n * WIDTH, "<f2") for b, n in parts[2]]).reshape(-1, WIDTH)
        order = np.argsort(ids, kind="stable")
        ids, weight, values = ids[order], weight[order], values[order]
        first = np.flatnonzero(np.append(True, np.diff(ids) != 0)[: len(ids)])
        total = np.add.reduceat(weight, first) if len(first) else weight
        summed = np.add.reduceat(values * weight[:, None], first, axis=0) if len(first) else values
        # Rows are sent in half precision, so they are kept in it.
        mean = np.where(total[:, None] > 0, summed / np.maximum(total, 1)[:, None], values[first]).astype(np.float16)
        ids = ids[first]
    mean = mean.astype(np.float32)
    return pa.table({"block": pa.array([block] * len(ids), pa.int32()), "id": ids.astype(np.int64)} | {v: mean[:, k] for k, v in enumerate(VECTOR)})


def score(shards: DataFrame, places: DataFrame, totals: np.ndarray, net: Network, rows: DataFrame) -> DataFrame:
    """(doc_id, n_words, log_prob, mean_log_prob) of every document."""
    spark: SparkSession = shards.sparkSession
    shared = spark.sparkContext.broadcast((net.flat, totals))
    target = pa_schema(spark, SCORES)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        flat, totals = shared.value
        part = Shard(left, near_words(right)[0])
        upto = np.append(0.0, np.cumsum(part.log_probs(Network(flat), totals)))
        ends = np.cumsum(part.lengths)
        sums = upto[ends] - upto[ends - part.lengths]
        means = [s / n if n else None for s, n in zip(sums.tolist(), part.lengths.tolist(), strict=True)]
        cells = [part.doc_ids.to_pylist(), part.lengths.tolist(), sums.tolist(), means]
        return pa.table([pa.array(c, type=f.type) for c, f in zip(cells, target, strict=True)], schema=target)

    return by_shard(shards, places, rows).applyInArrow(run, SCORES)


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the documents and score them."""
    shards = encode_shards(docs, id_col, text_col)
    counts = count_words(shards)
    numbers = number_words(counts, vocabulary(counts))
    places = place_words(shards, numbers)
    return score(shards, places, bucket_totals(numbers), *train(shards, places))
