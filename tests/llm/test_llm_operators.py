"""Operators of starfold.llm against brute force, on odd cases and small fixtures."""

import hashlib
import json
import random
import textwrap
import time
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starfold.llm import (
    chat_tools,
    decontaminate,
    language_id,
    licenses,
    line_dedup,
    lm_score,
    near_dup,
    packing,
    quality,
    suffix_dedup,
)
from starfold.llm.common import prepare
from starfold.llm.components import components
from starfold.llm.queries import QUERIES, tokenizer_path
from starfold.llm.shingles import shingle_hashes, shingle_set
from starfold.session import materialize

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, sf_doc string, H string"
SYLLABLES = "ba co du fe gi lo mu na pe ri so tu va wo xi".split()


def prose(rng, n, alphabet=SYLLABLES):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Odd and ordinary texts by id; None is a null text."""
    rng = random.Random(5)
    base = prose(rng, 300)
    words = base.split()
    passage = prose(rng, 120)
    out = {
        1: None, 2: "", 3: "   \n\t ", 4: "one", 5: "two words", 6: base, 7: base,
        8: " ".join(words[:150] + ["changed"] + words[151:]),
        9: " ".join(words[:20] + [prose(rng, 1) for _ in range(200)]),
        10: prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40),
        11: prose(rng, 60) + "\n" + passage + "\n" + prose(rng, 10),
        12: "Ünï cödé ßtraße\nsame line here ok\nSAME LINE HERE OK  \n" + prose(rng, 30),
        13: "\tsame line here ok\n" + prose(rng, 30) + "\nsame line here ok",
        14: prose(rng, 30_000), 15: "a" * 1200, 16: "ab" * 900, 17: "a b " * 400,
        18: "Released under the MIT License.\n" + prose(rng, 80),
        19: "\n".join(["same line here ok"] * 6), 20: "日本語 テキスト <|endoftext|> it's 12",
    }
    for k in range(21, 60):
        out[k] = prose(rng, rng.randint(5, 400)) + ("\n" + passage if k % 3 == 0 else "")
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    prepare(spark)
    rows = [(k, t, "xx", f"src{k % 3}" if k % 7 else None, len(t or ""), "clash", "clash", "clash") for k, t in texts.items()]
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def odd(spark, texts):
    """Null ids, repeated rows, one id with two texts."""
    prepare(spark)
    rows = [(k, t, None, None, None, None, None, None) for k, t in
            [(None, texts[6]), (None, "x"), (3, texts[6]), (3, texts[6]), (5, texts[8]), (5, "other text of five words"), (9, None)]]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    prepare(spark)
    return spark.createDataFrame([], DOCS)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# ------------------------------------------------------------------------------ suffix dedup


def removed_bytes(texts, length):
    raw = {k: (t or "").encode() for k, t in texts.items()}
    seen = Counter(b[s : s + length] for b in raw.values() for s in range(len(b) - length + 1))
    out = {}
    for k, b in raw.items():
        cover = np.zeros(len(b) + 1, dtype=int)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                cover[s] += 1
                cover[s + length] -= 1
        gone = np.cumsum(cover)[: len(b)] > 0
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~gone])
        out[k] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [4000, 0])
def test_suffix_dedup(docs, texts, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    small = {k: t for k, t in texts.items() if k != 14}
    got = suffix_dedup.remove_repeats(docs.where("doc_id != 14"), keep_first=False)
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == removed_bytes(small, 400)


def test_suffix_dedup_keeps_the_first_copy(docs):
    got = by_id(suffix_dedup.remove_repeats(docs.where("doc_id in (6, 7, 8, 10, 11)"), keep_first=True))
    assert got[6].n_removed == 0 and got[7].n_removed == got[7].n_bytes
    assert 0 < got[8].n_removed < got[8].n_bytes and got[10].n_removed == 0 and got[11].n_removed > 400


def test_suffix_segments(docs, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    small = {k: t for k, t in texts.items() if k != 14}
    got = suffix_dedup.remove_repeats(docs.where("doc_id != 14"), keep_first=False)
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == removed_bytes(small, 400)


def test_suffix_odd_rows(odd, empty):
    rows = suffix_dedup.remove_repeats(odd, keep_first=False).collect()
    assert len(rows) == 7 and sum(r.n_removed == r.n_bytes > 400 for r in rows) == 3
    assert suffix_dedup.remove_repeats(empty).count() == 0


# ------------------------------------------------------------------------------ line dedup


def lines_kept(texts, least=10):
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for k, t in texts.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(k)
    out = {}
    for k, t in texts.items():
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == k]
        out[k] = (len(lines) - len(kept), "\n".join(kept))
    return out


def test_line_dedup(docs, texts):
    out, dropped = line_dedup.dedup_lines(docs)
    assert [c for c in out.columns if c != dropped] == docs.columns
    got = {r["doc_id"]: (r[dropped], r["text"] or "") for r in out.collect()}
    assert got == lines_kept(texts)


def test_line_bitmap_runs(docs):
    runs = by_id(line_dedup.line_bitmaps(docs.where("doc_id in (12, 19)")), "doc")[19]["runs"]
    assert [(r["a"], r["b"]) for r in runs] == [(0, 5)]


def test_line_odd_rows(odd, empty):
    out, dropped = line_dedup.dedup_lines(odd)
    rows = out.collect()
    assert len(rows) == 7 and sum(r[dropped] for r in rows if r.doc_id is None) == 1
    assert sum(r[dropped] for r in rows if r.doc_id == 3) == 0
    assert line_dedup.dedup_lines(empty)[0].count() == 0


# ------------------------------------------------------------------------------ near duplicates


def brute_components(texts, size, percent):
    sets = {k: shingle_set(t, size) for k, t in texts.items()}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: (len(s), find(k)) for k, s in sets.items()}


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, texts, size, percent):
    got = by_id(near_dup.near_duplicates(docs, size=size, percent=percent))
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == brute_components(texts, size, percent)
    assert all(r.kept == (r.component_id == k) for k, r in got.items())


def test_chain_of_near_copies(spark):
    """Neighbours are similar, the ends are not; bands alone would leave several components."""
    rng = random.Random(3)
    words = prose(rng, 200).split()
    texts = {}
    for k in range(60):
        texts[k] = " ".join(words)
        words[3 * k % 200] = prose(rng, 1) + str(k)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = by_id(near_dup.near_duplicates(frame, size=3, percent=85))
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == brute_components(texts, 3, 85)


def test_near_odd_rows(odd, docs, texts, empty):
    rows = near_dup.near_duplicates(odd).collect()
    assert len(rows) == 7 and all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    kept = near_dup.keep_one(odd).collect()
    assert Counter(r.doc_id for r in kept) == {None: 2, 3: 1, 9: 1} and set(kept[0].asDict()) == set(odd.columns)
    assert near_dup.keep_one(empty).count() == 0
    want = {k for k, (_, c) in brute_components(texts, 5, 80).items() if c == k}
    assert {r.doc_id for r in near_dup.keep_one(docs).collect()} == want and not want & {7, 8}


def test_components(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, 7), (7, 300), (300, 301)]
    got = by_id(components(spark.createDataFrame(edges, "a long, b long")), "node")
    assert {k: r.component for k, r in got.items()} == {**{k: 10 for k in range(10, 61)}, 100: 7, 7: 7, 300: 7, 301: 7}


def test_shingles_are_counted_exactly(texts):
    for size in (1, 3, 5):
        for t in texts.values():
            assert len(shingle_hashes(t, size)) == len(shingle_set(t, size))


# ------------------------------------------------------------------------------ decontamination


def test_decontamination(spark):
    rng = random.Random(11)
    items = {k: prose(rng, 30) for k in range(5)}
    items[5], items[6] = "too few words", None

    def change(text, every):
        w = text.split()
        return " ".join(x if i % every else "other" for i, x in enumerate(w))

    texts = {
        1: prose(rng, 50) + " " + items[0] + " " + prose(rng, 50), 2: items[1].upper().replace(" ", ", "),
        3: prose(rng, 9) + " " + change(items[2], 6), 4: prose(rng, 400), 5: None, 6: "", 7: "too few words",
        8: " ".join(items[3].split()[10:24]), 9: change(items[4], 2),
    }
    frame = spark.createDataFrame([(k, t, "clash") for k, t in texts.items()] + [(None, items[0], "clash")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.overlaps(frame, bench).collect()}
    assert set(got) == {(1, 0), (2, 1), (3, 2), (8, 3), (None, 0)}
    assert got[(1, 0)].n_equal == 13 and got[(1, 0)].first_word == 50 and 11 <= got[(3, 2)].n_equal < 13
    left = decontaminate.drop_contaminated(frame, bench)
    assert {r.doc_id for r in left.collect()} == {4, 5, 6, 7, 9} and left.columns == frame.columns
    assert decontaminate.overlaps(frame.where("false"), bench).count() == 0
    assert decontaminate.overlaps(frame, bench.where("false")).count() == 0


def test_decontamination_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda my ny xi"
    frame = spark.createDataFrame([(1, "x " + item), (2, "alpha beta")], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.overlaps(frame, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()] == [1]


def test_short_benchmark_items(spark, tmp_path):
    items = {1: "What is pi?", 2: "seven words make up this short item", 3: "", 4: "pi", 5: None}
    texts = {1: "so: WHAT is, pi! and what is pi", 2: "what is pie", 3: "x seven words make up this short item y",
             4: "seven words make up that short item", 5: None, 6: "what is"}
    path = str(tmp_path / "data")
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): (r.n_window, r.n_equal, r.first_word) for r in QUERIES["op7_decontaminate"](spark, path).collect()}
    assert got == {(1, 1): (3, 3, 1), (1, 4): (1, 1, 3), (3, 2): (7, 7, 1)}
    left = corpus_pipeline.off_benchmark(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
    assert {r.doc_id for r in left.collect()} == {2, 4, 5, 6}


# ------------------------------------------------------------------------------ language ID


@pytest.fixture(scope="module")
def languages(spark):
    rng = random.Random(2)
    kinds = {"aa": SYLLABLES, "bb": "str ung sch keit ver zt".split(), "cc": "ión ñez osa llo qué".split()}
    rows = [(k, prose(rng, 80, kinds[lang]), lang) for k, lang in enumerate(list(kinds) * 60)]
    rows += [(1000, None, "aa"), (1001, "123 !?", "bb"), (1002, prose(rng, 20), None), (1003, "", None), (1004, "QZJXKVQ " * 40, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_id(languages, empty):
    prepare(languages.sparkSession)
    model = language_id.fit(languages, ~language_id.held_out())
    got = by_id(language_id.identify(languages, model))
    truth = {r.doc_id: r.lang for r in languages.collect() if r.doc_id < 1000}
    assert all(got[k].lang_pred == lang and got[k].accepted for k, lang in truth.items())
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k in got)
    for k in (1000, 1001, 1003):
        assert (got[k].lang_pred, got[k].score, got[k].accepted) == ("und", 0.0, False)
    assert got[1002].lang_pred == "aa" and not got[1004].accepted
    assert all(0 <= r.score <= 1 for r in got.values())
    none = language_id.fit(empty, ~language_id.held_out())
    assert {r.lang_pred for r in language_id.identify(languages, none).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0


def test_kneser_ney_sums_to_one():
    model = language_id.KneserNey.train([prose(random.Random(1), 300)])
    context = language_id.grams(language_id.encode("bac"), 3)[-1] << np.uint64(16)
    total = model.prob(np.array([context | np.uint64(c) for c in range(1, 257)], dtype=np.uint64)).sum()
    assert total == pytest.approx(1.0, abs=1e-9)


# ------------------------------------------------------------------------------ LM scoring


def test_lm_gradient():
    net = lm_score.Network(np.random.default_rng(1).standard_normal(lm_score.Network().flat.shape) * 0.1)
    ids = np.array([1, 5, 9, 700, 33, 5, 1000, 2])
    context = lm_score.Network.context(ids)
    before, seen = net.flat.copy(), lm_score.Network(np.zeros_like(net.flat))
    net.learn(context, ids, seen)
    rng = np.random.default_rng(0)
    for k in rng.choice(np.flatnonzero(seen.flat), 12):
        loss = []
        for step in (1e-5, -1e-5):
            flat = before.copy()
            flat[k] += step
            loss.append(-lm_score.Network(flat).log_probs(ids).mean())
        assert abs(loss[0] - loss[1]) / 2e-5 == pytest.approx(np.sqrt(seen.flat[k]), rel=1e-3, abs=1e-7)


def test_lm_scores(spark, empty):
    prepare(spark)
    rng = random.Random(4)
    rows = [(k, "the cat sat on the mat and the dog ran home " * 6) for k in range(60)]
    rows += [(100, " ".join(rng.sample(rows[0][1].split(), 60))), (101, None), (102, " \n "), (None, "cat")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(lm_score.pseudo_likelihood(frame))
    assert got[0].n_words == 66 and got[0].mean_log_prob == pytest.approx(got[0].log_prob / 66)
    assert got[0].mean_log_prob > got[100].mean_log_prob
    assert got[101].n_words == 0 and got[101].log_prob == 0 and got[102].mean_log_prob is None
    assert lm_score.pseudo_likelihood(empty).count() == 0


def test_lm_probabilities_are_normalised():
    net = lm_score.Network()
    context = np.repeat(np.array([[1, 2, 3, 4]]), lm_score.SIZE, axis=0)
    _, _, pu, pl, upper, lower = net.forward(context, np.arange(lm_score.SIZE))
    row = np.arange(lm_score.SIZE)
    assert (pu[row, upper] * pl[row, lower]).sum() == pytest.approx(1.0, abs=1e-4)


def test_lm_learns_every_token_once(spark):
    prepare(spark)
    rng = random.Random(6)
    rows = [(k, prose(rng, rng.randint(0, 9))) for k in range(50)]
    shards = lm_score.encode_shards(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "doc_id", "text").toArrow()
    assert shards.num_rows == 1
    words = shards.column("words")[0].as_py()
    near = {"pos": pa.array(range(len(words)), pa.int32()), "id": pa.array(range(len(words)), pa.int64()), "n": pa.array([1] * len(words), pa.int64())}
    near |= {"core": pa.array([lm_score.WORDS] * len(words), pa.int32())} | {v: pa.array([0.0] * len(words), pa.float32()) for v in lm_score.VECTOR}
    part = lm_score.Shard(shards, pa.table(near))
    assert [words[t] for t in part.tokens] == [w for _, t in rows for w in t.lower().split()]
    learnt = np.concatenate([part.targets(turn, lm_score.ROUNDS) for turn in range(lm_score.ROUNDS)])
    assert sorted(learnt) == list(range(sum(len(t.split()) for _, t in rows)))


def test_lm_model_grows_with_the_corpus(spark):
    """Every rare word has its own share of its bucket, and seen words have their own embedding row."""
    prepare(spark)
    sizes = []
    for n in (2000, 4000):
        rows = [(k, " ".join(f"w{(k * 20 + j) % n}" for j in range(20))) for k in range(n // 2)]
        shards = lm_score.encode_shards(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
        counts = lm_score.count_words(shards)
        numbers = lm_score.number_words(counts, lm_score.vocabulary(counts))
        rare = numbers.where(f"core >= {lm_score.WORDS}")
        totals = lm_score.bucket_totals(numbers)
        share = [r.n / totals[zlib.crc32(r.word.encode()) % lm_score.BUCKETS] for r in rare.collect()]
        assert sum(share) == pytest.approx(np.count_nonzero(totals))
        _, own = lm_score.train(shards, lm_score.place_words(shards, numbers))
        own = own.collect()
        assert sum(any(r[v] for v in lm_score.VECTOR) for r in own) == n - lm_score.WORDS
        sizes.append(len(own))
    assert sizes == [2000 - lm_score.WORDS, 4000 - lm_score.WORDS]


def test_lm_packed_places():
    for tokens in ([], [0], [0, 1, 255, 256, 70_000, 3_999_999]):
        got = lm_score.unpack(lm_score.pack(np.array(tokens, dtype=np.int32)), len(tokens))
        assert got.tolist() == tokens


def test_lm_rows_are_sent_packed(spark, monkeypatch):
    """A shard's words are one row a block, not one a word, and it gets the rows that it asks for."""
    prepare(spark)
    monkeypatch.setattr(lm_score, "BLOCK_WORDS", 700)
    rows = [(k, " ".join(f"w{(k * 20 + j) % 2000}" for j in range(20))) for k in range(1000)]
    shards = lm_score.encode_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), "doc_id", "text")
    counts = lm_score.count_words(shards)
    numbers = lm_score.number_words(counts, lm_score.vocabulary(counts))
    places = lm_score.place_words(shards, numbers)
    packed = places.collect()
    assert sum(r["size"] for r in packed) == sum(r["size"] for r in shards.collect())
    assert len({r["block"] for r in packed}) > 1 and len(packed) == len({(r["part"], r["block"]) for r in packed}) < 20
    asked = {(r["part"], r["block"]): lm_score.unpack_ids(r["ids"], r["own"]) for r in packed}
    block_of = {i: block for (_, block), ids in asked.items() for i in ids.tolist()}
    assert len(block_of) == 2000 - lm_score.WORDS
    vectors = [(block, i, *(float(n + k) for k in range(lm_score.WIDTH))) for n, (i, block) in enumerate(block_of.items())]
    given = lm_score.give_rows(places, spark.createDataFrame(vectors, lm_score.ROWS)).collect()
    of = {i: v for _, i, *v in vectors}
    assert {(r["part"], r["block"]) for r in given} == {key for key, ids in asked.items() if len(ids)}
    for r in given:
        ids = asked[r["part"], r["block"]]
        got = lm_score.unpack(r["rows"], len(ids) * lm_score.WIDTH, "<f2").reshape(-1, lm_score.WIDTH)
        assert got.tolist() == [of[i] for i in ids.tolist()]


def test_lm_averages_by_use():
    def sent(ids, used, value):
        values = np.repeat(np.array(value, dtype=np.float32), lm_score.WIDTH)
        return (0, len(ids), None, lm_score.pack_ids(np.array(ids)), lm_score.pack(np.array(used)), lm_score.pack(values, "<f2"))

    names = ["block", "size", "learnt", "ids", "used", "rows"]
    rows = [sent([3, 5, 9], [1, 0, 2], [1.0, 4.0, 7.0]), sent([3, 5], [3, 0], [5.0, 4.0])]
    got = lm_score.average((pa.scalar(0),), pa.table(dict(zip(names, zip(*rows, strict=True), strict=True))))
    assert got.column("id").to_pylist() == [3, 5, 9] and got.column("v0").to_pylist() == [4.0, 4.0, 7.0]
    slices = [(-1, 32, n, None, None, np.full(32, v, dtype=np.float32).tobytes()) for n, v in ((1.0, 2.0), (3.0, 6.0), (0.0, 99.0))]
    got = lm_score.average((pa.scalar(-1),), pa.table(dict(zip(names, zip(*slices, strict=True), strict=True))))
    assert got.column("id").to_pylist() == [0, 1] and got.column("v3").to_pylist() == [5.0, 5.0]


def test_lm_sums_repeated_rows():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 300):
        index, values = rng.integers(0, n // 2 + 1, n), rng.standard_normal((n, 4))
        at, total = lm_score._sum_rows(index, values)
        assert at.tolist() == sorted(set(index.tolist()))
        assert np.allclose(total, [values[index == k].sum(axis=0) for k in at])


def test_shuffle_files_go_with_their_step(spark):
    prepare(spark)

    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for k in range(found.size()) if (name := found.apply(k).getName()).startswith("shuffle_")}

    before = files()
    frame = materialize(spark.range(1000).repartition(3, "id"), "released", release=True)
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and frame.count() == 1000


def test_lm_softmax_of_large_logits():
    z = np.array([[1000.0, 999.0, -1000.0], [0.5, 0.25, 0.125]])
    e = np.exp(z - z.max(axis=1, keepdims=True))
    expect = e / e.sum(axis=1, keepdims=True)
    assert np.allclose(lm_score._softmax(z.copy(), 1000.0), expect)
    assert np.allclose(lm_score._log_softmax_at(z.copy(), np.array([1, 2]), 1000.0), np.log(expect[[0, 1], [1, 2]]))
    assert np.allclose(lm_score._softmax(z[1:].copy(), 0.5), expect[1:])


def test_lm_log_probs_against_plain_python(spark):
    """Every document's sum again, word by word, from the weights, rows, counts and texts alone."""
    prepare(spark)
    rng = random.Random(8)
    rows = [(k, " ".join(f"w{rng.randrange(1000)}" for _ in range(rng.randint(0, 120)))) for k in range(200)]
    shards = lm_score.encode_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text")
    counts = lm_score.count_words(shards)
    vocab = lm_score.vocabulary(counts)
    numbers = lm_score.number_words(counts, vocab)
    places, totals = lm_score.place_words(shards, numbers), lm_score.bucket_totals(numbers)
    net, own = lm_score.train(shards, places)
    got = {r.doc_id: r.log_prob for r in lm_score.score(shards, places, totals, net, own).collect()}
    v, width = {k: x.astype(float) for k, x in net.views.items()}, lm_score.WIDTH
    vectors = {r.id: [r[c] for c in lm_score.VECTOR] for r in own.collect()}
    ids = {r.word: r.id for r in numbers.collect()}
    n = {}
    for _, text in rows:
        for w in text.split():
            n[w] = n.get(w, 0) + 1
    core = {w: vocab.ids.get(w, lm_score.WORDS + zlib.crc32(w.encode()) % lm_score.BUCKETS) for w in n}
    in_bucket = {}
    for w, c in core.items():
        in_bucket[c] = in_bucket.get(c, 0) + n[w]
    assert len(vocab.ids) == lm_score.WORDS and vectors

    def embedding(words, at):
        if not 0 <= at < len(words):
            return v["embed"][lm_score.SIZE]
        return vectors.get(ids[words[at]], v["embed"][core[words[at]]])

    def log_softmax(z, at):
        return z[at] - np.log(sum(np.exp(x) for x in z))

    for doc_id, text in rows:
        words, total = text.split(), 0.0
        for i, w in enumerate(words):
            x = np.concatenate([embedding(words, i + d) for d in (-2, -1, 1, 2)])
            assert len(x) == 4 * width
            h = np.tanh(x @ v["w"] + v["b"])
            upper, lower = divmod(core[w], lm_score.CLASSES)
            total += log_softmax(h @ v["up"] + v["up_b"], upper) + log_softmax(h @ v["low"] + v["low_b"][upper], lower)
            total += np.log(n[w] / in_bucket[core[w]]) if core[w] >= lm_score.WORDS else 0.0
        assert got[doc_id] == pytest.approx(total, abs=1e-3)


def test_lm_tells_words_of_a_bucket_apart(spark):
    prepare(spark)
    words = [f"x{k}" for k in range(4000)]
    twins = [w for w in words if zlib.crc32(w.encode()) % lm_score.BUCKETS == 7][:2]
    common = [" ".join(f"c{k}" for k in range(lm_score.WORDS))] * 30
    rows = [(k, t) for k, t in enumerate([*common, *[f"c0 {twins[0]} c1"] * (lm_score.SEEN - 1), f"c0 {twins[1]} c1"])]
    got = by_id(lm_score.pseudo_likelihood(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got[30].log_prob - got[30 + lm_score.SEEN - 1].log_prob == pytest.approx(np.log(lm_score.SEEN - 1), abs=1e-3)


# ------------------------------------------------------------------------------ chats

LOOKUP = {"type": "object", "required": ["q"], "properties": {"q": {"type": "string"}, "n": {"type": "integer", "maximum": 9}, "after": {}}, "additionalProperties": False}


@pytest.mark.parametrize("edges", [10_000, 0])
def test_tool_calls(spark, monkeypatch, edges):
    monkeypatch.setattr(chat_tools, "TASK_EDGES", edges)

    def call(i, args, name="lookup"):
        return (i, name, args if isinstance(args, str) or args is None else json.dumps(args))

    rows = [
        (1, 0, "user", "hi", None, None),
        (1, 1, "assistant", None, [call("b", {"q": "x", "after": {"$ref": "a"}}), call("a", {"q": "é"}), call("c", {"q": "y", "after": [{"$ref": "b"}]})], None),
        (1, 2, "tool", "for b", None, "b"), (1, 3, "tool", "for a", None, "a"), (1, 4, "tool", "again", None, "a"),
        (1, 5, "tool", "nobody", None, "zz"),
        (2, 0, "assistant", "x", [call("a", {"n": 1}), call("d", "{"), call("e", {"q": "1", "n": 10}), call("f", {"q": "1"}, "other"), call(None, {"q": "1"})], None),
        (2, 1, "assistant", "x", [call("g", {"q": "1", "after": {"$ref": "h"}}), call("h", {"q": "1", "after": {"$ref": "g"}}), call("i", {"q": "1", "after": {"$ref": "?"}}), call("a", {"q": "2"}), call("j", None)], None),
        (None, 0, "user", None, None, None),
    ]
    frame = spark.createDataFrame(rows, chat_tools.MESSAGE)
    out = chat_tools.link_tools(frame, {"lookup": LOOKUP}).collect()
    got = {(r.conv_id, r.turn, r.kind, r.call_id): r for r in out}
    order = sorted((r.level, r.call_id, r.kind) for r in out if r.conv_id == 1 and r.turn == 1 and r.kind)
    assert order == [(0, "a", 1), (0, "a", 2), (1, "b", 1), (1, "b", 2), (2, "c", 1)]
    assert got[(1, 1, 1, "a")].status == "ok" and got[(1, 1, 1, "c")].status == "no result"
    assert got[(1, 4, 2, "a")].status == "duplicate" and got[(1, 5, 2, "zz")].status == "orphan"
    assert got[(1, 1, 1, "a")].json == '{"role":"assistant","tool_call":{"arguments":{"q":"é"},"id":"a","name":"lookup"}}'
    status = {k: got[(2, 0, 1, k)].status for k in ("a", "d", "e", "f", None)}
    assert status == {"a": "$.q: missing", "d": "arguments are no JSON", "e": "$.n: out of range", "f": "unknown tool", None: "no identifier"}
    late = {k: got[(2, 1, 1, k)].status for k in "ghiaj"}
    assert late == {"g": "cycle", "h": "cycle", "i": "unknown reference", "a": "duplicate", "j": "arguments are no object"}
    assert got[(None, 0, 0, None)].json == '{"content":null,"role":"user"}'
    assert chat_tools.link_tools(frame.where("false"), {}).count() == 0


def test_plain_chats(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (2, 0, "user", None), (3, 1, "assistant", "x")]
    out = chat_tools.link_tools(chat_tools.plain_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), {"reply": chat_tools.REPLY_SCHEMA})
    got = {(r.conv_id, r.kind, r.call_id): (r.turn, r.level, r.status) for r in out.collect() if r.kind}
    assert got == {(1, 1, "q-0"): (0, 0, "ok"), (1, 2, "q-0"): (0, 0, "ok"), (1, 1, "q-2"): (2, 1, "ok"), (1, 2, "q-2"): (2, 1, "ok"),
                   (2, 1, "q-0"): (0, 0, "$.text: length"), (3, 2, "q-0"): (1, None, "orphan")}


# ------------------------------------------------------------------------------ licences


def test_license_scan(docs, texts, empty, spark):
    extra = {100: "MIT-License mit license\nGNU General Public\nLicense", 101: "you may not use this file except in any compliance with the License!", 102: "permission to use and copy"}
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(extra.items()), "doc_id long, text string"))
    got = by_id(licenses.scan(frame))
    for k, t in {**texts, **extra}.items():
        words = licenses.words_of(t or "")
        base = sorted(licenses.phrase_places(words, licenses.PHRASES))
        assert (got[k].n_words, got[k].n_base) == (len(words), len(base))
    assert (got[100].n_base, got[100].first_word, got[100].last_word, got[100].base_labels) == (3, 0, 5, "gpl,mit")
    assert got[101].labels == "apache" and got[101].base_labels == "" and 0.8 <= got[101].score <= 1
    assert got[102].labels == "" and got[102].first_word is None and got[18].labels == "mit"
    assert licenses.scan(empty).count() == 0


def test_license_join_is_exact():
    """The filters lose nothing against comparing every block with every template."""
    rng = random.Random(8)
    pool = [w for _, t in licenses.TEMPLATES for w in t.split()]
    index = licenses.TemplateIndex(licenses.TEMPLATES, {w.lower().encode(): len(w) for w in pool})
    for _ in range(400):
        _, t = rng.choice(licenses.TEMPLATES)
        block = [w for w in t.split() if rng.random() < 0.85] + rng.choices(pool, k=rng.randint(0, 8))
        words = licenses.words_of(" ".join(block))
        brute = Counter()
        for label, template in licenses.TEMPLATES:
            whole = set(licenses.words_of(template))
            share = Fraction(len(whole & set(words)), len(whole))
            if share >= licenses.CONTAINMENT:
                brute[label] = max(brute[label], float(share))
        found = Counter()
        for label, share in index.block(words):
            found[label] = max(found[label], share)
        assert found == brute


def test_wrapped_licenses(spark):
    """Templates wrapped at 70 to 80 characters, with and without comment marks, get their labels."""
    rng = random.Random(12)
    want, rows = {}, []
    for mark in ("", "# ", " * ", "// "):
        for width in (20, 35, 70, 80):
            for label, template in licenses.TEMPLATES:
                body = textwrap.fill(f"Copyright holder. {template}", width, break_on_hyphens=False).split("\n")
                want[len(rows)] = label
                rows.append((len(rows), "\n".join([prose(rng, 45), *(mark + line for line in body), prose(rng, 60)])))
    got = by_id(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert all(want[k] in got[k].labels.split(",") and got[k].score >= 0.8 for k in want)


# ------------------------------------------------------------------------------ packing


def test_packing(docs, texts, empty):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    rows = packing.pack_documents(docs, tokenizer_path()).collect()
    ids = {k: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for k, t in texts.items()}
    sums = Counter()
    for r in rows:
        cut = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == 2048 * r.piece and len(cut) == r.length <= 2048 and zlib.crc32(cut.tobytes()) == r.ids_crc32
        sums[r.doc_id] += r.length
    assert sums == {k: len(v) for k, v in ids.items()}
    end = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == end.get(r.sequence_id, 0)
        end[r.sequence_id] = r.offset + r.length
    assert max(end.values()) <= 2048 and len(end) == -(-sum(sums.values()) // 2048)
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


def test_packing_odd_rows(odd):
    rows = packing.pack_documents(odd, tokenizer_path()).collect()
    assert sum(r.doc_id is None for r in rows) == 2 and len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def test_pre_tokens_match_the_tokenizer(texts):
    tokens = packing.WordTokens(tokenizer_path())
    odd = ["a<|endoftext|>b", "It's DON'T i'll", "x\xa0y\tz\x1cw", "Straße ÉCOLE İ ΣΑΣ.", "é o", "1²½ªºµ ... ,,", "", "ŉ ﬁ ǅ"]
    for t in [*odd, *(t for k, t in texts.items() if t and k != 14)]:
        want = tokens.tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(next(tokens.texts([t])), dtype="<u4").tolist() == want


@pytest.mark.parametrize("seed", range(4))
def test_plan_covers_the_histogram(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 100): rng.randint(1, 40) for _ in range(rng.randint(1, 60))}
    runs = packing.plan_sequences(histogram, capacity=100, groups=5)
    numbers, filled = Counter(), {}
    for length, a, b, sequence, offset in runs:
        assert 0 <= a < b
        numbers.update((length, n) for n in range(a, b))
        for k in range(b - a):
            filled.setdefault(sequence + k, []).append((offset, length))
    assert numbers == Counter({(k, n): 1 for k, c in histogram.items() for n in range(c)})
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100


# ------------------------------------------------------------------------------ quality


def brute_repeat_words(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)})


def test_quality_counts(docs, texts, empty):
    got = by_id(quality.quality_rules(docs))
    for k, t in texts.items():
        t = t or ""
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
        lines = [x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")]
        repeat = brute_repeat_words(words)
        failed = len(words) < 50 or 100 * repeat > 50 * len(words)
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t))
        assert (r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(lines) - len(set(lines)), repeat, failed)
        assert not (r.kept and failed)
    assert quality.quality_rules(empty).count() == 0


def test_frequent_lines(spark):
    prepare(spark)
    rng = random.Random(9)
    menu = prose(rng, 60)
    rows = [(k, f"{menu}\n{prose(rng, 10)} {k}", "h1") for k in range(30)] + [(k, f"{menu}\n{prose(rng, 70)}", "h2") for k in range(30, 35)]
    rows += [(k, menu + "\nsame", "h2") for k in range(40, 80)] + [(90, menu + "\n" + prose(rng, 100), "h1"), (91, None, None)]
    got = by_id(quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    # copies are documents of their own: the line they share is over the limit too
    assert all(got[k].depleted and not got[k].kept for k in [*range(30), *range(40, 80)])
    assert all(got[k].kept for k in [*range(30, 35), 90])
    assert got[90].frequent_words == 60 and not got[91].kept


def test_line_limit_is_the_same_in_small_and_hot_hosts(spark):
    prepare(spark)
    rng = random.Random(10)
    menu, rare = prose(rng, 60), prose(rng, 60)
    rows = [(k, f"{menu}\n{prose(rng, 10)} {k}", "small" if k < 30 else "hot") for k in range(60)]
    rows += [(k, f"{rare}\n{prose(rng, 10)} {k}", "small" if k < 80 else "hot") for k in range(60, 100)]
    rows += [(k, f"{prose(rng, 60)} {k}", "hot") for k in range(1000, 5000)]
    got = by_id(quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    assert all(got[k].depleted and got[k].frequent_words == 60 for k in range(60))
    assert all(got[k].kept and got[k].frequent_words == 0 for k in [*range(60, 100), *range(1000, 5000)])


def test_rows_of_one_id_are_one_document(spark):
    prepare(spark)
    rng = random.Random(11)
    line = prose(rng, 60)
    rows = [(7, f"{line}\n{k}", "h") for k in range(60)] + [(k, f"{line}\n{prose(rng, 5)}", "h") for k in range(10)]
    schema = "doc_id long, text string, source string"
    assert {r.frequent_words for r in quality.quality_rules(spark.createDataFrame(rows, schema)).collect()} == {0}
    rows += [(None, f"{line}\n{k}", "h") for k in range(11)]
    assert {r.frequent_words for r in quality.quality_rules(spark.createDataFrame(rows, schema)).collect()} == {60}


def test_quality_odd_rows(odd):
    assert quality.quality_rules(odd).count() == 7


# ------------------------------------------------------------------------------ pipeline


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline

    bench = [(1, docs.where("doc_id = 30").first().text)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame, names = docs.withColumn("lang", F.lit("xx")), docs.columns
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == names, name
        counts.append({r.doc_id for r in frame.collect()})
    assert not counts[0] & {1, 2, 3} and {6, 7, 8, 14, 30} <= counts[0]
    assert counts[1] == counts[0] and counts[2] <= counts[1] and counts[3] == counts[2] - {10, 30}  # 10 holds the passage of 30
    texts = {r.doc_id: r for r in frame.collect()}
    assert all(r.n_chars == len(r.text) for r in texts.values())


def test_pipeline_of_nothing(spark, empty, tmp_path):
    import corpus_pipeline

    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_dataframes_have_fresh_names():
    from starfold.llm.common import fresh

    class Frame:
        columns = ["SF_doc", "sf_doc_"]

    assert fresh(Frame(), "sf_doc") == "sf_doc__"
