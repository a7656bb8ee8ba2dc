"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

Method.
1. A text is escaped as the library does: spaces become `MARK`, and one `MARK` goes before a text that is not empty.
2. It is cut into words, each a run of marks and the characters up to the next mark. Every distinct
   word of a task is encoded once. Words are cut further between two characters that stand next to each
   other in no piece: no merge can cross such a place.
3. The symbols of all new words lie in one flat numpy array. In each round every word takes the smallest
   rank among its adjacent pairs (a segmented minimum) and merges that pair, leftmost first; arrays are
   compacted, and only pairs next to a merge are looked up again. Words without a pair leave the arrays.
   All occurrences of the pair in a word merge in one round where no longer piece that contains the merged
   one has a rank at least as good; otherwise only the leftmost one does, as the library's queue
   would. So every round gives what the library gives, ties between equal scores included.
4. Words of more than `LONG` characters take the same merges from a heap, so that the work of a round is
   bounded by short words.
5. Characters that are no piece become their UTF-8 bytes' pieces.

Decoding joins the pieces' texts, turns marks into spaces, drops the mark that encoding put first, joins byte
pieces into characters, and gives U+FFFD for every byte that belongs to none, as the library does.

Spark gives every task a part of the documents; there is no shuffle and nothing is collected. A task keeps the
encodings of up to `KEEP` distinct words.

Defined cases. Null and empty texts have no tokens and decode to an empty text. A mark in a text
reads as a space. Repeated rows give repeated rows, an empty table an empty result; extra columns, also ones
named like results, are not read. The model must be a BPE model with byte fallback, without normalisation table,
user-defined pieces or removal of extra spaces; any other raises ValueError. Its path is a parameter.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame

from starfold.llm.common import map_rows

MARK = "▁"
# Characters of the longest word that goes through the rounds.
LONG = 2048
# Distinct words whose encodings a task keeps, and the longest that it keeps.
KEEP = 400_000
KEEP_CHARS = 64

NONE = np.iinfo(np.int32).max
BASE = 0x110001
SHIFT = 21
WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One integer for a pair of symbols."""
    return ((left.astype(np.int64) + BASE) << SHIFT) | (right.astype(np.int64) + BASE)


class PieceModel:
    """Encoder and decoder of one model file.

    A symbol is a piece id, or -1 - code point for a character that is no piece.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        kinds = [p.type for p in proto.pieces]
        if (
            spec.model_type != spec.BPE
            or not spec.byte_fallback
            or spec.treat_whitespace_as_suffix
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not norm.escape_whitespaces
            or not set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}
            or kinds.count(BYTE) != 256
        ):
            raise ValueError(f"{path}: only BPE models with byte fallback and no normalisation are supported")
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.bytes_of = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.byte_ids = {i: b for b, i in self.bytes_of.items()}
        self.normal = set(self.ids.values())
        self.controls = {i for i, k in enumerate(kinds) if k == CONTROL}
        self.decimal = [str(i).encode() for i in range(len(kinds))]
        self.texts = [p.piece.replace(MARK, " ").encode() for p in proto.pieces]
        for i, kind in enumerate(kinds):
            if kind == CONTROL:
                self.texts[i] = b""
            elif kind == UNKNOWN:
                self.texts[i] = spec.unk_surface.encode()
            elif kind == BYTE:
                self.texts[i] = bytes([self.byte_ids[i]])
        self._tables([p.score for p in proto.pieces])
        self.known: dict[str, int] = {}
        self._forget()

    def _tables(self, scores: list[float]) -> None:
        order = sorted({scores[i] for i in self.ids.values()}, reverse=True)
        rank_of_score = {s: k for k, s in enumerate(order)}
        rank = {p: rank_of_score[scores[i]] for p, i in self.ids.items()}
        left, right, ranks, merged, safe = [], [], [], [], dict.fromkeys(self.ids, True)
        bigrams = set()
        held = [0] * len(order)
        for piece, r in rank.items():
            held[r] += len(piece) > 1
            bigrams.update(zip(piece, piece[1:]))
            for k in range(1, len(piece)):
                head, tail = piece[:k], piece[k:]
                for part in (head, tail):
                    if part in rank and rank[part] >= r:
                        safe[part] = False
                a, b = self.symbol(head), self.symbol(tail)
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    ranks.append(r)
                    merged.append(self.ids[piece])
        keys = _key(np.array(left, np.int64), np.array(right, np.int64))
        at = np.argsort(keys)
        self.pair_keys = keys[at]
        # The last entry of each table is that of a pair which is no piece.
        self.pair_rank = np.append(np.array(ranks, np.int32)[at], NONE).astype(np.int32)
        self.pair_to = np.append(np.array(merged, np.int32)[at], 0).astype(np.int32)
        fine = np.zeros(len(scores), bool)
        for piece, ok in safe.items():
            fine[self.ids[piece]] = ok and held[rank[piece]] == 1
        self.pair_safe = np.append(fine[self.pair_to[:-1]], False)
        self.bigrams = np.sort(np.array([(ord(a) << SHIFT) | ord(b) for a, b in bigrams], np.int64))
        singles = {ord(p): i for p, i in self.ids.items() if len(p) == 1}
        self.char_ids = np.array(sorted(singles), np.int64)
        self.char_syms = np.array([singles[c] for c in sorted(singles)], np.int64)
        self.pairs = dict(zip(zip(left, right), zip(ranks, merged)))

    def _forget(self) -> None:
        self.known = {}
        self.flat = np.zeros(1024, np.int32)
        self.used = 0
        self.starts: list[int] = [0]

    def symbol(self, part: str) -> int | None:
        """The symbol that stands for a part of a piece, None where no symbol can have that text."""
        if part in self.ids:
            return self.ids[part]
        return -1 - ord(part) if len(part) == 1 else None

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Table places of pairs; the last place where a pair is no piece."""
        keys = _key(left, right)
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, at, len(self.pair_keys)).astype(np.int32)

    def _symbols(self, codes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.char_ids, codes)
        at[at == len(self.char_ids)] = 0
        return np.where(self.char_ids[at] == codes, self.char_syms[at], -1 - codes)

    def _rounds(self, syms: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all words to the end; the symbols left and their words, in order."""
        none = len(self.pair_keys)
        pair = np.full(len(syms), none, np.int32)
        inside = np.flatnonzero(word[1:] == word[:-1])
        pair[inside] = self._lookup(syms[inside], syms[inside + 1])
        done_syms, done_words = [], []
        while len(syms):
            rank = self.pair_rank[pair]
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lengths = np.diff(np.append(first, len(word)))
            best = np.repeat(np.minimum.reduceat(rank, first), lengths)
            over = best == NONE
            if over.any():
                done_syms.append(syms[over])
                done_words.append(word[over])
                stay = ~over
                syms, word, pair, rank, best = syms[stay], word[stay], pair[stay], rank[stay], best[stay]
                if not len(syms):
                    break
            hit = np.flatnonzero(rank == best)
            opens = np.append(True, hit[1:] != hit[:-1] + 1)
            new_word = np.append(True, word[hit[1:]] != word[hit[:-1]])
            group = np.maximum.accumulate(np.where(opens, np.arange(len(hit)), 0))
            every_second = (np.arange(len(hit)) - group) % 2 == 0
            hit = hit[np.where(self.pair_safe[pair[hit]], every_second, new_word)]
            syms[hit] = self.pair_to[pair[hit]]
            stay = np.ones(len(syms), bool)
            stay[hit + 1] = False
            place = np.cumsum(stay) - 1
            syms, word, pair = syms[stay], word[stay], pair[stay]
            at = place[hit]
            again = np.unique(np.concatenate([at, at[at > 0] - 1]))
            pair[again] = none
            again = again[again + 1 < len(syms)]
            again = again[word[again] == word[again + 1]]
            pair[again] = self._lookup(syms[again], syms[again + 1])
        if not done_syms:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        syms, word = np.concatenate(done_syms), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return syms[order], word[order]

    def _heap(self, syms: list[int]) -> list[int]:
        """The same merges for one long word, smallest rank and leftmost first."""
        n = len(syms)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def offer(i: int) -> tuple | None:
            j = after[i]
            found = self.pairs.get((syms[i], syms[j])) if j < n else None
            return found and (found[0], i, syms[i], syms[j], found[1])

        queue = [item for i in range(n) if (item := offer(i))]
        heapq.heapify(queue)
        alive = [True] * n
        while queue:
            _, i, left, right, merged = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or j >= n or syms[i] != left or syms[j] != right:
                continue
            syms[i], alive[j], after[i] = merged, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (item := offer(k)):
                    heapq.heappush(queue, item)
        return [s for s, ok in zip(syms, alive) if ok]

    def _spell(self, syms: np.ndarray) -> list[int]:
        """Ids of symbols; characters that are no piece become bytes."""
        out: list[int] = []
        for s in syms.tolist():
            if s >= 0:
                out.append(s)
            else:
                out.extend(self.bytes_of[b] for b in chr(-1 - s).encode())
        return out

    def _encode_words(self, words: list[str]) -> None:
        """Add the encodings of new words to the table."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(lengths)
        opens = np.zeros(len(codes), bool)
        opens[ends - lengths] = True
        pairs = (codes[:-1] << SHIFT) | codes[1:]
        at = np.searchsorted(self.bigrams, pairs)
        at[at == len(self.bigrams)] = 0
        opens[1:] |= self.bigrams[at] != pairs
        part = np.cumsum(opens) - 1
        size = np.bincount(part)
        syms = self._symbols(codes)
        short = size[part] <= LONG
        out, out_part = self._rounds(syms[short], part[short])
        if not short.all():
            extra, extra_part = [out], [out_part]
            for p in np.flatnonzero(size > LONG).tolist():
                lo, hi = np.searchsorted(part, [p, p + 1])
                merged = np.array(self._heap(syms[lo:hi].tolist()), np.int64)
                extra.append(merged)
                extra_part.append(np.full(len(merged), p, np.int64))
            out, out_part = np.concatenate(extra), np.concatenate(extra_part)
            order = np.argsort(out_part, kind="stable")
            out, out_part = out[order], out_part[order]
        word_of_part = np.searchsorted(ends, np.flatnonzero(opens), side="right")
        owner = word_of_part[out_part]
        counts = np.bincount(owner, minlength=len(words))
        if (out < 0).any():
            chunks = np.split(out, np.cumsum(counts)[:-1])
            spelled = [self._spell(c) for c in chunks]
            counts = np.array([len(c) for c in spelled], np.int64)
            out = np.array([i for c in spelled for i in c], np.int64)
        while self.used + len(out) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros(len(self.flat), np.int32))
        self.flat[self.used : self.used + len(out)] = out
        for w, stop in zip(words, (self.used + np.cumsum(counts)).tolist(), strict=True):
            self.known[w] = len(self.starts) - 1
            self.starts.append(stop)
        self.used += len(out)

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [WORDS.findall(self.prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > KEEP:
            self._forget()
        new = {w for words in cut for w in words if w not in self.known}
        if new:
            self._encode_words(sorted(new))
        known, starts = self.known, np.array(self.starts, np.int64)
        flat = np.array([known[w] for words in cut for w in words], np.int64)
        lo, n = starts[flat], starts[flat + 1] - starts[flat]
        stop = np.cumsum(n)
        total = int(stop[-1]) if len(stop) else 0
        ids = self.flat[np.arange(total) + np.repeat(lo - (stop - n), n)]
        bounds = np.concatenate([[0], stop])[np.cumsum([0, *map(len, cut)])]
        for w in new:
            if len(w) > KEEP_CHARS:
                del self.known[w]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a list of ids."""
        listed = list(ids)
        if not self.controls.isdisjoint(listed):
            return self._decode_runs(listed)
        joined = b"".join([self.texts[i] for i in listed])
        if listed and self.prefix and listed[0] in self.normal and joined[:1] == b" ":
            joined = joined[1:]
        try:
            return joined.decode()
        except UnicodeDecodeError:
            return self._decode_runs(listed)

    def _decode_runs(self, ids: list[int]) -> str:
        """Decoding with byte pieces that may not make up characters."""
        out: list[str] = []
        run = bytearray()
        open_text = bool(self.prefix)
        for i in [*ids, -1]:
            if i in self.byte_ids:
                run.append(self.byte_ids[i])
                continue
            if run:
                out.append(characters(bytes(run)))
                run.clear()
                open_text = False
            if i < 0 or i in self.controls:
                continue
            text = self.texts[i].decode()
            if open_text and text.startswith(" ") and i in self.normal:
                text = text[1:]
            open_text = False
            out.append(text)
        return "".join(out)


def characters(run: bytes) -> str:
    """UTF-8 text of bytes, one U+FFFD for every byte that belongs to no character."""
    out, at = [], 0
    while at < len(run):
        lead = run[at]
        size = 1 if lead < 0x80 else 2 if lead >> 5 == 6 else 3 if lead >> 4 == 14 else 4 if lead >> 3 == 30 else 1
        try:
            out.append(run[at : at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(`id_col`, ids, decoded): the ids of every text and the text that they decode to."""
    kind = docs.schema[id_col].dataType.simpleString()
    return _mapped(docs, path, id_col, text_col, f"{id_col} {kind}, ids array<int>, decoded string", _whole)


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(`id_col`, n_tokens, ids_sha256, decoded_sha256) of every text: digests instead of ids and texts."""
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, path, id_col, text_col, ddl, _digests)


def _whole(model: PieceModel, texts: list[str | None]) -> dict[str, list]:
    ids = [i.tolist() for i in model.encode(texts)]
    return {"ids": ids, "decoded": [model.decode(i) for i in ids]}


def _digests(model: PieceModel, texts: list[str | None]) -> dict[str, list]:
    out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
    for found in model.encode(texts):
        ids = found.tolist()
        out["n_tokens"].append(len(ids))
        out["ids_sha256"].append(hashlib.sha256(b",".join([model.decimal[i] for i in ids])).hexdigest())
        out["decoded_sha256"].append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
    return out


def _mapped(docs: DataFrame, path: str, id_col: str, text_col: str, ddl: str, fn) -> DataFrame:
    def make():
        model = PieceModel(path)
        return lambda cols: {id_col: cols[id_col], **fn(model, cols[text_col])}

    return map_rows(docs.select(id_col, text_col), make, ddl)
