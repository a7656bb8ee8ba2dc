"""Phrase collocations against a plain count of all n-grams."""

import os
import random
import re
import sys
from collections import Counter, defaultdict

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from check_oracles import compare  # noqa: E402

from starfold.llm import phrases  # noqa: E402
from starfold.llm.common import prepare  # noqa: E402
from starfold.llm.queries import ORACLES, QUERIES  # noqa: E402

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "lang string, text string, phrase string, f long, chunk string"


def brute(rows, n_max, least, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UP)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, n_max + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        held = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        gone = set()
        for g, a in held.items():
            for s in range(len(g)):
                for e in range(s + 2, len(g) + 1):
                    if e - s < len(g) and 100 * a >= 100 * held[g[s:e]]:
                        gone.add(g[s:e])
        scored = []
        for g, a in held.items():
            if g not in gone:
                score, k = min((1000 * a * total[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def corpus(rng, n):
    """Documents with odd separators, copies, hot words and passages longer than a chunk."""
    words = ["alpha", "beta", "Gamma", "δέλτα", "the", "the", "the", "of", "x", "漢字"]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\r\n", "\x0b"]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", None, "fr", ""]), text + (passage if rng.random() < 0.3 else "")))
    return [*rows, *rows[: n // 4], (None, None), ("en", ""), ("en", "the " * 3000), ("fr", "z" * 100_000), ("en", passage * 50)]


def mined(spark, rows, **options):
    docs = prepare(spark).createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in phrases.collocations(docs, **options).collect())


@pytest.mark.parametrize(("n_max", "least", "top"), [(5, 4, 2000), (3, 10, 25), (2, 1, 2000)])
def test_collocations(spark, n_max, least, top):
    rows = corpus(random.Random(n_max), 120)
    assert mined(spark, rows, n_max=n_max, min_count=least, top=top) == brute(rows, n_max, least, top)


def test_tasks_that_hand_on_early_change_nothing(spark):
    rows = corpus(random.Random(1), 60)
    want = brute(rows, 5, 5, 2000)
    assert mined(spark, rows, n_max=5, min_count=5, top=2000, held_rows=50) == want


def test_chunks_hold_every_start_once():
    rng = random.Random(2)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c", b"dd"]) for _ in range(rng.randint(1, 700))]
        starts = []
        for chunk, more in phrases.cut_piece(words, 4, phrases.Hashes()):
            held = chunk.split(b" ")
            own = len(held) - 4 * more
            assert words[len(starts) : len(starts) + len(held)] == held and 0 < own
            starts += held[:own]
        assert starts == words


def test_no_frequent_phrases(spark):
    assert mined(spark, [("en", "one two three")]) == []
    assert mined(spark, [(None, None)]) == []
    docs = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(docs).count() == 0


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = QUERIES["op13_phrases"](spark, sf).toPandas()
    assert len(got) and compare(got, con.execute(ORACLES["op13_phrases"]).df()) == "ok"
