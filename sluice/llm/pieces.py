"""SentencePiece encoding and decoding with seeded merge-dropout.

The vocabulary is a BPE model with byte fallback. Adjacent pairs that form a piece go on an agenda, best score first,
leftmost first; a candidate merge is skipped when the keyed hash of (seed, document, word, pieces) falls under the dropout
rate, so segmentations vary from text to text and word to word, but are the same on every run and machine. With rate 0 the
result is the model's own encoding. Decoding gives back every text exactly.

No piece spans the start of a word, so the agendas of all words of a block of texts advance together: each step takes the best
candidate of every word at once, in numpy arrays (`Encoder.rows`). Words over WIDTHS[-1] signs have an agenda of their own
(`Encoder.word`), which also says what the arrays must give.

Edge cases: a null text is empty and has no tokens; a null id counts as the empty string; repeated rows are encoded alike; an
empty table gives an empty result; the sign U+2581, which stands for a blank inside the model, is encoded by its bytes, so it
too comes back. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, table, whole_text

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED, RATE = 20_240_611, 0.1
BLANK = 0x2581
#: Sign numbers: code points, then one for a U+2581 of the text itself.
OWN_BLANK, SIGNS = 0x110000, 0x110001
#: Word lengths that share an array; signs in a block of texts.
WIDTHS, BLOCK = (4, 6, 8, 10, 13, 17, 24, 48), 400_000
#: Rows that are encoded together.
BATCH_ROWS = 500
NEVER = np.int32(2**31 - 1)
K1, K2, K4 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))


def load(path: str = MODEL) -> tuple[list[str], list[float], list[int]]:
    """Pieces, scores and, by byte, the ids of the byte pieces; at most the vocabulary's size, to be broadcast."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(p.get_piece_size())
    return [p.id_to_piece(i) for i in ids], [p.get_score(i) for i in ids], [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


def document_key(doc_id: str, seed: int = SEED) -> int:
    return int.from_bytes(hashlib.blake2b(doc_id.encode("utf-8", "surrogatepass"), key=seed.to_bytes(8, "big"), digest_size=8).digest(), "big")


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * K4
    return x ^ (x >> np.uint64(29))


class Encoder:
    """Encoding and decoding with one vocabulary and dropout rate."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], rate: float = RATE) -> None:
        special = {*byte_ids, *(i for i, p in enumerate(pieces) if p in ("<unk>", "<s>", "</s>"))}
        ids = {p: i for i, p in enumerate(pieces) if i not in special}
        order = np.unique(-np.array(scores), return_inverse=True)[1]
        self.size, self.below = len(pieces), int(rate * 2**32)
        self.byte_ids, self.byte_of = np.array(byte_ids, np.int32), {i: b for b, i in enumerate(byte_ids)}
        self.bytes_of = [p.replace(chr(BLANK), " ").encode() for p in pieces]
        for b, i in enumerate(byte_ids):
            self.bytes_of[i] = bytes([b])
        # A sign without a piece has the number size + sign; it is never the result of a merge.
        self.sign = np.arange(SIGNS, dtype=np.int32) + self.size
        for p, i in ids.items():
            if len(p) == 1:
                self.sign[ord(p)] = i
        number = lambda s: ids.get(s, self.size + ord(s) if len(s) == 1 else -1)
        pairs = {(a << 22) | b: i for p, i in ids.items() for k in range(1, len(p)) if (a := number(p[:k])) >= 0 and (b := number(p[k:])) >= 0}
        self.made, self.rank = pairs, order.astype(np.int32)
        self.piece_of = np.zeros(len(pieces) + 1, np.int32)
        self.piece_of[self.rank[list(ids.values())]] = list(ids.values())
        kinds, times = np.unique(self.rank[sorted({*pairs.values()})], return_counts=True)
        self.piece_of[kinds[times > 1]] = -1  # pieces of equal score: the pair itself tells
        self.slots = 1 << max(4, (4 * len(pairs)).bit_length())
        self.keys, self.values = np.full(self.slots, -1, np.int64), np.full(self.slots, -1, np.int32)
        for k, i in pairs.items():
            at = self.slot(np.array([k]))[0]
            while self.keys[at] >= 0:
                at = (at + 1) % self.slots
            self.keys[at], self.values[at] = k, i

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * K1) >> np.uint64(40)).astype(np.int64) & (self.slots - 1)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair forms, or -1: open addressing, all pairs at once."""
        key = (left.astype(np.int64) << 22) | right
        at = self.slot(key)
        found = self.keys[at]
        out = np.where(found == key, self.values[at], -1)
        rest = np.flatnonzero((found != key) & (found >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & (self.slots - 1)
            found = self.keys[at[rest]]
            hit = found == key[rest]
            out[rest[hit]] = self.values[at[rest[hit]]]
            rest = rest[~hit & (found >= 0)]
        return out

    def candidates(self, left: np.ndarray, right: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The rank of the piece that each pair forms; NEVER for pairs that form none or that the hash skips."""
        piece = self.merged(left, right)
        rank = np.where(piece >= 0, self.rank[piece], NEVER)
        if self.below:
            x = mix(key ^ (left.astype(np.uint64) * K1 + right.astype(np.uint64) * K2))
            rank[(x & np.uint64(0xFFFFFFFF)) < np.uint64(self.below)] = NEVER
        return rank

    def rows(self, sym: np.ndarray, length: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The agendas of many words in step. sym: a column for each word, padded, overwritten; gives the pieces in the same form and their number."""
        width, n = sym.shape
        out, total, live, count = sym, length.copy(), None, length.copy()
        if width < 2:
            return out, total
        rank = np.full((width, n), NEVER)
        for j in range(width - 1):
            ok = np.flatnonzero(length > j + 1)
            rank[j, ok] = self.candidates(sym[j, ok], sym[j + 1, ok], key[ok])
        while True:
            best, at = rank[0].copy(), np.zeros(rank.shape[1], np.int64)
            for j in range(1, width - 1):
                np.copyto(at, j, where=rank[j] < best)
                np.minimum(best, rank[j], out=best)
            going = best != NEVER
            left = np.count_nonzero(going)
            if left < 0.8 * len(going):
                if live is None:
                    live = np.arange(n)
                else:
                    out[:, live[~going]] = sym[:, ~going]
                total[live[~going]] = count[~going]
                if not left:
                    return out, total
                live, sym, count, rank, key, best, at = live[going], sym[:, going], count[going], rank[:, going], key[going], best[going], at[going]
                going = np.ones(left, bool)
            at[~going] = width
            now = np.flatnonzero(going)
            place = at[now]
            made = self.piece_of[best[now]]
            if len(equal := np.flatnonzero(made < 0)):
                made[equal] = self.merged(sym[place[equal], now[equal]], sym[place[equal] + 1, now[equal]])
            sym[place, now] = made
            # What stands right of the merged pair moves one place left.
            for j in range(1, width - 1):
                behind = at < j
                np.copyto(sym[j], sym[j + 1], where=behind)
                np.copyto(rank[j], rank[j + 1], where=behind)
            count -= going
            for p in (place - 1, place):
                ok = np.flatnonzero((p >= 0) & (p + 1 < count[now]))
                c, q = now[ok], p[ok]
                rank[q, c] = self.candidates(sym[q, c], sym[q + 1, c], key[c])
                gone = np.flatnonzero((p >= 0) & (p + 1 >= count[now]))
                rank[p[gone], now[gone]] = NEVER

    def word(self, sym: list[int], key: int) -> list[int]:
        """One word with an agenda of its own."""
        n = len(sym)
        sym, nxt, prv, end = list(sym), list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive, agenda = bytearray(b"\1" * n), []

        def offer(a: int, b: int) -> None:
            made = self.made.get((sym[a] << 22) | sym[b])
            if made is None:
                return
            if self.below:
                x = key ^ ((sym[a] * int(K1) + sym[b] * int(K2)) & 0xFFFFFFFFFFFFFFFF)
                x = (x ^ (x >> 31)) * int(K4) & 0xFFFFFFFFFFFFFFFF
                if ((x ^ (x >> 29)) & 0xFFFFFFFF) < self.below:
                    return
            heapq.heappush(agenda, (int(self.rank[made]), a, b, end[b], made))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, a, b, stop, made = heapq.heappop(agenda)
            if not (alive[a] and alive[b] and nxt[a] == b and end[b] == stop and self.made.get((sym[a] << 22) | sym[b]) == made):
                continue
            alive[b], sym[a], end[a], nxt[a] = 0, made, stop, nxt[b]
            if nxt[a] < n:
                prv[nxt[a]] = a
                offer(a, nxt[a])
            if prv[a] >= 0:
                offer(prv[a], a)
        return [sym[i] for i in range(n) if alive[i]]

    def encode(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """The ids of each text; keys: a document key for each."""
        out, block, held, size = [], [], [], 0
        for t, k in zip(texts, keys, strict=True):
            block.append(t)
            held.append(k)
            size += len(t) + 1
            if size >= BLOCK:
                out += self.block(block, held)
                block, held, size = [], [], 0
        return out + (self.block(block, held) if block else [])

    def block(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        sizes = np.array([len(t) for t in texts])
        full = [t for t in texts if t]
        if not full:
            return [np.empty(0, np.int32) for _ in texts]
        points = np.frombuffer(" ".join(["", *full]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
        points[points == BLANK] = OWN_BLANK
        points[points == 32] = BLANK
        begin = np.cumsum(np.append(0, sizes[sizes > 0] + 1))
        blank = points == BLANK
        first = blank & ~np.append(False, blank[:-1])
        first[begin[:-1]] = True
        at = np.flatnonzero(first)
        length = np.diff(np.append(at, len(points)))
        doc = np.searchsorted(begin, at, "right") - 1
        ordinal = np.arange(len(at)) - np.searchsorted(at, begin[:-1])[doc]
        key = mix(np.array([k for k, t in zip(keys, texts, strict=True) if t], np.uint64)[doc] + ordinal.astype(np.uint64) * K1)
        sym = self.sign[points]
        pieces, count = sym.copy(), length.copy()
        low = 0
        for width in WIDTHS:
            mine = np.flatnonzero((length > low) & (length <= width))
            low = width
            if not len(mine):
                continue
            place = at[mine] + np.minimum(np.arange(width)[:, None], length[mine] - 1)
            got, n = self.rows(sym[place], length[mine], key[mine])
            count[mine] = n
            keep = np.arange(width)[:, None] < n
            pieces[(at[mine] + np.arange(width)[:, None])[keep]] = got[keep]
        for i in np.flatnonzero(length > low):
            got = self.word(sym[at[i] : at[i] + length[i]].tolist(), int(key[i]))
            count[i] = len(got)
            pieces[at[i] : at[i] + len(got)] = got
        # Each word's pieces stand at its place; close the gaps, then put bytes for signs without a piece.
        kept = np.repeat(at - np.cumsum(np.append(0, count[:-1])), count) + np.arange(count.sum())
        ids, owner = pieces[kept], np.repeat(doc, count)
        bare = np.flatnonzero(ids >= self.size)
        if len(bare):
            signs = ids[bare] - self.size
            kinds, which = np.unique(signs, return_inverse=True)
            spelt = [self.byte_ids[list(chr(BLANK if c == OWN_BLANK else c).encode("utf-8", "surrogatepass"))] for c in kinds.tolist()]
            times = np.ones(len(ids), np.int64)
            times[bare] = np.array([len(s) for s in spelt])[which]
            where = np.cumsum(times) - times
            ids, owner = np.repeat(ids, times), np.repeat(owner, times)
            flat, flat_at = np.concatenate(spelt), np.cumsum([0, *map(len, spelt)])[:-1]
            for k in range(4):
                more = times[bare] > k
                ids[where[bare[more]] + k] = flat[flat_at[which[more]] + k]
        split = iter(np.split(ids, np.searchsorted(owner, np.arange(1, len(full)))))
        return [next(split) if s else np.empty(0, np.int32) for s in sizes]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))[1:].decode("utf-8", "surrogatepass")


def encoded(documents: DataFrame, model: str = MODEL, seed: int = SEED, rate: float = RATE, keep_ids: bool = True) -> DataFrame:
    """All columns of documents and `pieces`: n_tokens, ids_sha256 (over little-endian 32-bit ids), lossless and, if asked for, token_ids."""
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(load(model))

    @F.pandas_udf("n_tokens long, ids_sha256 string, lossless boolean" + ", token_ids array<int>" * keep_ids)
    @lean
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        e = Encoder(*sent.value, rate)
        for every_id, every_text in batches:
            for at in range(0, len(every_text), BATCH_ROWS):  # ids take more memory than texts, so few rows at a time
                ids, texts = every_id[at : at + BATCH_ROWS], list(every_text[at : at + BATCH_ROWS])
                got = e.encode(texts, [document_key(d, seed) for d in ids])
                out = pd.DataFrame({"n_tokens": [len(g) for g in got], "ids_sha256": [hashlib.sha256(g.astype("<u4").tobytes()).hexdigest() for g in got], "lossless": [e.decode(g) == t for g, t in zip(got, texts, strict=True)]})
                yield out.assign(token_ids=got) if keep_ids else out

    return documents.withColumn("pieces", run(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), whole_text()))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_ids=False)
    return rows.select("doc_id", "pieces.*")
