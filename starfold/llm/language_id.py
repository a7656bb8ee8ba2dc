"""Language ID with interpolated Kneser-Ney character language models.

Method. For every language a character model of order 4 is trained on labelled documents:
interpolated Kneser-Ney with one absolute discount per order; lower orders count distinct left
contexts instead of occurrences. Characters are lower-cased, everything that is no letter is a
blank, and four characters of 16 bits pack into one 64-bit key without collisions. Keys are hashed
by an odd multiplier and kept in one sorted array of all languages, with one row of
log-probabilities per key (unseen keys of a language are backed off when the array is built). A
text costs one binary search per character; keys that no language has are backed off on the fly.
The language with the lowest cross-entropy per character wins.

Calibration. A fifth of the training documents is kept out of the counts. On those, a temperature
turns cross-entropies into probabilities (`score`, the winner's probability), and for each
language the entropies give a rejection limit: mean plus `REJECT_SIGMA` standard deviations of the
document entropies. `accepted` is false for texts without letters and for texts whose entropy is above the
limit of the language that won; the limit is wider for short texts, whose entropies spread more.

Bounds. The classifier is fitted on at most `TRAIN_DOCS` documents of a language, chosen
by a hash of their id; the model is then bounded by their distinct 4-grams and is sent to all tasks.
The number of languages is taken to be small (one group of training texts and one column each).
Prediction covers whole texts of all documents.

Defined cases. Null, empty or letterless texts are `und`, score 0, not accepted. Null languages
are not learned. Without training documents everything is `und`. Repeated training texts count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starfold.session import materialize

ORDER = 4
TRAIN_DOCS = 600
REJECT_SIGMA = 8.0
UNKNOWN = "und"
BLANK = 32
HASH = np.uint64(0x9E3779B97F4A7C15)
# Size of the alphabet that the uniform base distribution is spread over.
ALPHABET = 256.0

MODEL = "lang string, kind string, keys binary, vals binary"


@lru_cache(maxsize=1)
def letter_codes() -> np.ndarray:
    """16-bit code of every code point: itself for letters, a blank for the rest."""
    table = np.full(0x110000, BLANK, dtype=np.uint16)
    for cp in range(0x110000):
        if chr(cp).isalpha():
            table[cp] = cp if cp < 0xFFFF else 0xFFFF
    return table


def encode(text: str) -> np.ndarray:
    """Codes of a text with ORDER - 1 blanks in front."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    out = np.full(len(points) + ORDER - 1, BLANK, dtype=np.uint64)
    out[ORDER - 1 :] = letter_codes()[points]
    return out


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Packed n-gram that ends at every position from ORDER - 1."""
    out = np.zeros(len(codes) - ORDER + 1, dtype=np.uint64)
    for k in range(n):
        at = ORDER - n + k
        out = out << np.uint64(16) | codes[at : at + len(out)]
    return out


class Table:
    """Sorted keys with values."""

    def __init__(self, keys: np.ndarray, vals: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.vals = keys[order], vals[order]

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, found) of every key."""
        if not len(self.keys):
            return np.zeros(len(keys)), np.zeros(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.vals[at], self.keys[at] == keys


class KneserNey:
    """One language: probabilities of seen n-grams and back-off weights of their contexts."""

    def __init__(self, probs: list[Table], weights: list[Table]) -> None:
        self.probs, self.weights = probs, weights

    @staticmethod
    def train(texts: list[str]) -> KneserNey:
        codes = [encode(t) for t in texts]
        keys, counts = np.unique(np.concatenate([grams(c, ORDER) for c in codes]), return_counts=True)
        by_order = {ORDER: (keys, counts.astype(float))}
        for n in range(ORDER - 1, 0, -1):  # distinct left contexts of each shorter gram
            mask = np.uint64((1 << 16 * n) - 1)
            lower, distinct = np.unique(by_order[n + 1][0] & mask, return_counts=True)
            by_order[n] = (lower, distinct.astype(float))
        probs, weights, below = [], [], None
        for n in range(1, ORDER + 1):
            keys, counts = by_order[n]
            ones, twos = (counts == 1).sum(), (counts == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            contexts, inverse, kinds = np.unique(keys >> np.uint64(16), return_inverse=True, return_counts=True)
            totals = np.bincount(inverse, counts)
            weight = discount * kinds / totals
            if below is None:
                lower = np.full(len(keys), 1.0 / ALPHABET)
            else:
                lower = below.get(keys & np.uint64((1 << 16 * (n - 1)) - 1))[0]
            below = Table(keys, np.maximum(counts - discount, 0) / totals[inverse] + weight[inverse] * lower)
            probs.append(below)
            weights.append(Table(contexts, weight))
        return KneserNey(probs, weights)

    def prob(self, keys: np.ndarray, n: int = ORDER) -> np.ndarray:
        """Interpolated probability of packed n-grams."""
        if n == 0:
            return np.full(len(keys), 1.0 / ALPHABET)
        out, found = self.probs[n - 1].get(keys)
        out = out.astype(float)
        if not found.all():
            miss = keys[~found]
            weight, known = self.weights[n - 1].get(miss >> np.uint64(16))
            lower = self.prob(miss & np.uint64((1 << 16 * (n - 1)) - 1), n - 1)
            out[~found] = np.where(known, weight, 1.0) * lower
        return out


class Classifier:
    """All languages, with one sorted hash array for the longest grams."""

    def __init__(self, models: dict[str, KneserNey], limits: dict[str, tuple[float, float]], temperature: float) -> None:
        self.langs = sorted(models)
        self.models = [models[x] for x in self.langs]
        self.limits = np.array([limits.get(x, (np.inf, 0.0)) for x in self.langs])
        self.temperature = temperature
        if self.langs:
            keys = np.unique(np.concatenate([m.probs[-1].keys for m in self.models]))
            rows = np.stack([np.log2(m.prob(keys)) for m in self.models], axis=1).astype(np.float32)
            hashed = keys * HASH
            order = np.argsort(hashed)
            self.hashes, self.rows = hashed[order], rows[order]

    def entropies(self, text: str) -> tuple[np.ndarray, int]:
        """Bits per character in every language, and the number of letters."""
        codes = encode(text)
        n = len(codes) - ORDER + 1
        letters = int((codes != BLANK).sum())
        if not letters:
            return np.full(len(self.langs), np.inf), 0
        keys = grams(codes, ORDER)
        # Runs of blanks carry no language.
        keys = keys[(keys & np.uint64(0xFFFFFFFF)) != np.uint64(BLANK << 16 | BLANK)]
        hashed = keys * HASH
        at = np.minimum(np.searchsorted(self.hashes, hashed), len(self.hashes) - 1)
        hit = self.hashes[at] == hashed
        total = self.rows[at[hit]].sum(axis=0, dtype=np.float64)
        if not hit.all():
            miss = keys[~hit]
            total += np.array([np.log2(m.prob(miss)).sum() for m in self.models])
        return -total / max(1, len(keys)), letters

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.langs:
            return UNKNOWN, 0.0, False
        bits, letters = self.entropies(text)
        if not letters:
            return UNKNOWN, 0.0, False
        best = int(bits.argmin())
        share = np.exp(-(bits - bits[best]) * self.temperature)
        mean, spread = self.limits[best]
        limit = mean + REJECT_SIGMA * (spread + 1.5 / np.sqrt(letters))
        return self.langs[best], float(1.0 / share.sum()), bool(bits[best] <= limit)


# ---------------------------------------------------------------------------------- training


def _train_group(pdf: pd.DataFrame) -> pd.DataFrame:
    """Model of one language from its bounded training texts, as rows of arrays."""
    lang = pdf["lang"].iloc[0]
    texts = sorted(set(t for t in pdf["text"] if t))
    fit = [t for k, t in enumerate(texts) if k % 5 or len(texts) < 5]
    if not fit:
        return pd.DataFrame(columns=["lang", "kind", "keys", "vals"])
    model = KneserNey.train(fit)
    rows = []
    for n in range(ORDER):
        for kind, t in ((f"p{n}", model.probs[n]), (f"w{n}", model.weights[n])):
            rows.append((lang, kind, t.keys.astype("<u8").tobytes(), t.vals.astype("<f8").tobytes()))
    return pd.DataFrame(rows, columns=["lang", "kind", "keys", "vals"])


def training_rows(
    docs: DataFrame, usable: Column, id_col: str, text_col: str, lang_col: str, per_lang: int
) -> DataFrame:
    """At most `per_lang` labelled documents a language, chosen by hashes of their ids."""
    labelled = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("h"), F.xxhash64(text_col).alias("th")
    )
    # Only hashes that can be among the smallest travel: three times as many as wanted are expected.
    sizes = materialize(labelled.groupBy("lang").agg(F.count("*").alias("n")), "language-sizes")
    share = F.pmod(F.xxhash64(F.lit("share"), "h"), F.lit(1 << 30)) / float(1 << 30)
    low = labelled.select("lang", "h", "th").join(sizes, "lang").where(share * F.col("n") <= 3 * per_lang)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("h"), "h", "th")
    ranked = low.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_lang)
    chosen = materialize(ranked.select("lang", "h", "th").distinct(), "language-training")
    return labelled.join(chosen, ["lang", "h", "th"], "left_semi").select("lang", "text")


def fit(
    docs: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_lang: int = TRAIN_DOCS,
) -> Classifier:
    """Train on the labelled documents for which `usable` holds."""
    train = materialize(training_rows(docs, usable, id_col, text_col, lang_col, per_lang).distinct(), "language-texts")
    parts: dict[str, dict[str, Table]] = {}
    for r in train.groupBy("lang").applyInPandas(_train_group, MODEL).collect():
        parts.setdefault(r["lang"], {})[r["kind"]] = Table(
            np.frombuffer(r["keys"], dtype="<u8").astype(np.uint64), np.frombuffer(r["vals"], dtype="<f8")
        )
    models = {
        lang: KneserNey([t[f"p{n}"] for n in range(ORDER)], [t[f"w{n}"] for n in range(ORDER)])
        for lang, t in parts.items()
    }
    plain = Classifier(models, {}, 1.0)
    bits = _held_back(train, plain).collect() if models else []
    return Classifier(models, *_calibrate(plain.langs, bits))


def _held_back(train: DataFrame, model: Classifier) -> DataFrame:
    """(lang, bits) of the training texts that were kept out of the counts."""
    shared = train.sparkSession.sparkContext.broadcast(model)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = sorted(set(t for t in pdf["text"] if t))
        rest = [t for k, t in enumerate(texts) if k % 5 == 0 and len(texts) >= 5]
        bits = [shared.value.entropies(t)[0].tolist() for t in rest]
        bits = [b for b in bits if np.isfinite(b).all()]
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]] * len(bits), "bits": bits})

    return train.groupBy("lang").applyInPandas(score, "lang string, bits array<double>")


def _calibrate(langs: list[str], rows: list) -> tuple[dict[str, tuple[float, float]], float]:
    """Entropy mean and spread of each language, and the temperature of the scores."""
    limits = {}
    for k, lang in enumerate(langs):
        own = np.array([r["bits"][k] for r in rows if r["lang"] == lang])
        if len(own) >= 5:
            limits[lang] = (float(own.mean()), float(own.std()))
    if not rows:
        return limits, 1.0
    bits = np.array([r["bits"] for r in rows])
    truth = np.array([langs.index(r["lang"]) for r in rows])

    def loss(t: float) -> float:
        z = -bits * t
        z -= z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]).mean())

    return limits, min((0.5, 1.0, 2.0, 4.0, 8.0, 16.0), key=loss)


# ---------------------------------------------------------------------------------- prediction


def predict_column(docs: DataFrame, model: Classifier, text_col: str = "text") -> Column:
    """Struct column (lang_pred, score, accepted) of a text column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score", "accepted"])

    return predict(F.col(text_col))


def held_out(id_col: str = "doc_id") -> Column:
    """Every fifth document by the CRC of its id is kept out of the training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) of every document."""
    return docs.select(
        F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), predict_column(docs, model, text_col).alias("p")
    ).select("doc_id", "held_out", "p.lang_pred", "p.score", "p.accepted")
