"""Secret scans: base patterns, then a password guess-cost dynamic programme over credential-context values.

A value that stands where credentials stand is split at least cost, in log10 guesses, into words (by their rank among all
words of the whole corpus), dates, repeats, keyboard walks and brute-force spans. Values that
cost at least COST guesses get a span of kind `guess`; cheaper ones are ordinary words or placeholders.

Edge cases: a null text is empty and gives no spans; rows with null or repeated ids each give one row; an empty table
gives an empty result; words of equal frequency rank by their text; only doc_id and text are read, so other columns cannot
clash. Texts, values and words of any length are read and scored whole; the parts of a value that may be words leave its task
in portions, FLUSH at a time.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, staged, table, whole_text

KINDS = ("assign", "access", "hex")
#: The least log10 guesses of a secret.
COST = 8.0
FLUSH = 400_000

ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Wider places where credentials stand; the search runs where a text has one of these names.
NAMES = ("pwd", "passphrase", "passcode", "credentials?", "bearer", "authorization", "private_key", "access_key", "client_secret", "login")
PLACE = re.compile(rf"(?i:\b({'|'.join(NAMES)}))[\"']?\x20*+(?:(?:[:=]|\bis\b)\x20*+)?[\"']?([^\s\"',;]{{6,}})", re.ASCII)
PLACES = tuple(n.removesuffix("s?") for n in NAMES)
CUES = ("passw", "secret", "token", "api_key", "apikey")
DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:(?:19|20)\d\d)|(?:19|20)\d\d", re.ASCII)
WORD = re.compile(r"[^\W\d_]{3,}")
#: Words of more letters are looked up by their first HEAD letters, then compared whole.
HEAD = 16
#: Rows of a keyboard (fixed values).
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "azertyuiop")
NEXT = {r[i : i + 2] for row in ROWS for r in (row, row[::-1]) for i in range(len(row) - 1)}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), by start, then kind."""
    out, low = [], text.lower()
    if any(c in low for c in CUES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def alphabet(span: str) -> int:
    n = 10 * any(c.isdigit() for c in span) + 26 * any(c.islower() for c in span) + 26 * any(c.isupper() for c in span)
    return n + 33 * any(not c.isalnum() for c in span) or 95


def prefix_matches(s: str | list) -> list[int]:
    """For each place, how many signs from there equal the start of s; linear."""
    n, z, a, b = len(s), [len(s)] + [0] * (len(s) - 1), 0, 0
    for k in range(1, n):
        m = min(b - k, z[k - a]) if k < b else 0
        while k + m < n and s[m] == s[k + m]:
            m += 1
        z[k] = m
        if k + m > b:
            a, b = k, k + m
    return z


def repeats(value: str) -> list[tuple[int, int, int]]:
    """(start, end, size) of all longest stretches that repeat a unit of `size` signs at least twice, where no smaller unit
    repeats through the whole stretch. Halves are searched first, then what crosses their border: n log n steps."""
    n, found, parts = len(value), set(), [(0, len(value))]
    while parts:
        lo, hi = parts.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        parts += [(lo, mid), (mid, hi)]
        left, right = value[lo:mid], value[mid:hi]
        nl, nr = len(left), len(right)
        back = [*prefix_matches(left[::-1]), 0]
        ahead = [*prefix_matches(right), 0]
        # A list keeps the border apart from every sign.
        right_left = prefix_matches([*right, None, *left])
        left_right = prefix_matches([*left[::-1], None, *right[::-1]])
        for size in range(1, nl + 1):  # unit ends at the border
            k1, k2 = back[size], right_left[nr + 1 + nl - size]
            if k2 == size <= nr:
                k2 += ahead[size]
            if k1 + k2 >= size:
                found.add((mid - size - k1, mid + k2, size))
        for size in range(1, nr + 1):  # unit starts at the border
            k1, k2 = left_right[nl + 1 + nr - size], ahead[size]
            if k1 == size <= nl:
                k1 += back[size]
            if k1 + k2 >= size:
                found.add((mid - k1, mid + size + k2, size))
    # Smaller units first: a stretch inside one already kept says nothing new. `far` is a Fenwick tree of the furthest end by start.
    out, far = [], [0] * (n + 1)
    for a, b, size in sorted(found, key=lambda r: (r[2], r[0], -r[1])):
        k, end = a + 1, 0
        while k:
            end, k = max(end, far[k]), k & (k - 1)
        if end < b:
            out.append((a, b, size))
            k = a + 1
            while k <= n:
                far[k], k = max(far[k], b), k + (k & -k)
    return out


def lowered(value: str) -> str:
    """Lower case, sign by sign."""
    return "".join(c if len(x := c.lower()) > 1 else x for c in value)


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """Least log10 guesses over all segmentations of the whole value."""
    n, low = len(value), lowered(value)
    per_sign = math.log10(alphabet(value))
    best = [0.0] + [math.inf] * n
    forced = [math.inf] * (n + 1)  # of the ways that end in a brute-force span: its next sign needs no choice
    step = math.log10(2)  # to choose a kind of part
    walk = [n] * n  # where the keyboard walk from each sign ends
    for at in range(n - 2, -1, -1):
        walk[at] = walk[at + 1] if low[at : at + 2] in NEXT else at + 1
    starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    copies: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for a, b, size in repeats(value):
        for at in range(a, b - (3 if size == 1 else 2) * size + 1):
            starts[at].append((size, (b - at) // size))
            copies[at + size].append((size, (b - at) // size))

    classes = [(w, list(accumulate(map(f, value), initial=0))) for w, f in ((10, str.isdigit), (26, str.islower), (26, str.isupper), (33, lambda c: not c.isalnum()))]

    def signs(a: int, b: int) -> int:  # alphabet(value[a:b])
        return sum(w for w, s in classes if s[b] > s[a]) or 95

    def offer(at: int, end: int, cost: float) -> None:
        best[end] = min(best[end], best[at] + cost + step)

    def offer_word(at: int, end: int, rank: int) -> None:
        upper = sum(x.isupper() for x in value[at:end])
        offer(at, end, math.log10(rank + 1) + (0 if not upper else step if upper == 1 and value[at].isupper() or upper == end - at else upper * step))

    longer: dict[str, list[str]] = {}
    for word in ranks:
        if len(word) > HEAD:
            longer.setdefault(word[:HEAD], []).append(word)
    for at in range(n):
        forced[at + 1] = min(forced[at], best[at] + step) + per_sign
        best[at + 1] = min(best[at + 1], forced[at + 1])
        for end in range(at + 3, min(n, at + HEAD) + 1):
            if rank := ranks.get(low[at:end]):
                offer_word(at, end, rank)
        for word in longer.get(low[at : at + HEAD], ()):
            if low.startswith(word, at):
                offer_word(at, at + len(word), ranks[word])
        if m := DATE.match(value, at):
            offer(at, m.end(), math.log10(120 if m.end() - at == 4 else 365 * 120 * (1 if m[0].isdigit() else 4)))
        # A unit costs what guessing it from its own signs costs, or, where it has just been paid for, nothing more.
        for size, k in starts[at]:
            offer(at, at + k * size, size * math.log10(signs(at, at + size)) + math.log10(k))
        for size, k in copies[at]:
            offer(at, at + (k - 1) * size, math.log10(k))
        if walk[at] - at >= 4:
            offer(at, walk[at], math.log10(len("".join(ROWS))) + math.log10(2 * (walk[at] - at)))
    return best[n]


def credential_values(text: str) -> list[tuple[int, int]]:
    """Places of the values in base assignments and in wider credential contexts."""
    low, out = text.lower(), set()
    if any(c in low for c in CUES):
        out |= {m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 6}
    if any(c in low for c in PLACES):
        out |= {m.span(2) for m in PLACE.finditer(text)}
    return sorted(out)


def corpus_words(documents: DataFrame) -> DataFrame:
    """All words of all documents with their rank, from 1, by frequency, then text. The order is made by ranges, and ranks
    from the sizes of the ranges before."""

    @lean
    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for b in batches:
            for t in b.text:
                seen.update(WORD.findall(t.lower()))
                if len(seen) > FLUSH:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                    seen.clear()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    found = documents.select(whole_text().alias("text")).mapInPandas(one, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    place = F.monotonically_increasing_id()
    ordered = staged(staged(found, "secrets-words").orderBy(F.desc("n"), "word").select("word", F.shiftright(place, 33).alias("range"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("inside")), "secrets-ordered")
    before, at = [], 0
    for r in sorted(ordered.groupBy("range").count().collect()):
        before.append((r["range"], at))
        at += r["count"]
    before = documents.sparkSession.createDataFrame(before, "range long, before long")
    return ordered.join(F.broadcast(before), "range").select("word", (F.col("before") + F.col("inside") + 1).alias("rank"))


def values_of(texts: pd.Series) -> pd.Series:
    return pd.Series([sorted({t[a:b] for a, b in credential_values(t)}) for t in texts], dtype=object)


@lean
def heads_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, head) of all parts of a value that can be a word, or its first HEAD letters; a part may come more than once."""
    seen: set[tuple[str, str]] = set()
    for b in batches:
        for key, low in zip(b.key, b.low, strict=True):
            for m in WORD.finditer(low):
                for k in range(m.start(), m.end() - 2):
                    seen.update((key, low[k:e]) for e in range(k + 3, min(m.end(), k + HEAD) + 1))
                    if len(seen) > FLUSH:
                        yield pd.DataFrame(list(seen), columns=["key", "head"])
                        seen.clear()
    if seen:
        yield pd.DataFrame(list(seen), columns=["key", "head"])


def words_within(values: DataFrame, ranks: DataFrame) -> DataFrame:
    """(key, words) of values (key, low): all words of the corpus (word, rank) that stand in them, once each, with their rank."""
    heads = staged(values.select("key", "low").mapInPandas(heads_of, "key string, head string"), "secrets-heads")
    # A word of the corpus whose head no value has is dropped before it is shuffled further.
    ranked = staged(ranks.withColumn("head", F.substring("word", 1, HEAD)).join(heads.select("head").distinct(), "head"), "secrets-ranked")
    found = heads.join(ranked, "head")
    long = F.length("word") > HEAD
    whole = found.where(long & (F.length("head") == HEAD)).join(values.select("key", "low"), "key").where(F.col("low").contains(F.col("word"))).select("key", "word", "rank")
    return found.where(~long).select("key", "word", "rank").unionByName(whole).groupBy("key").agg(F.collect_set(F.struct("word", "rank")).alias("words"))


def is_costly(values: pd.Series, words: pd.Series) -> pd.Series:
    return pd.Series([guess_cost(v, {w["word"]: w["rank"] for w in ([] if found is None else found)}) >= COST for v, found in zip(values, words, strict=True)], dtype=bool)


def with_costly(documents: DataFrame) -> DataFrame:
    """(row, own_id, own_hash, costly) for each row of documents, whatever the names of its columns: costly are the credential values of its text that cost at least COST; null where there are none."""
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64(whole_text()).alias("own_hash"))
    held = staged(documents.select(F.col("doc_id").alias("id"), F.xxhash64(whole_text()).alias("hash"), F.explode(F.pandas_udf(values_of, "array<string>")(whole_text())).alias("value")), "secrets-values")
    low = F.pandas_udf(lambda v: v.map(lowered), "string")
    values = staged(held.select("value").distinct().withColumns({"key": F.sha2(F.col("value").cast("binary"), 256), "low": low("value")}), "secrets-distinct")
    known = words_within(values, corpus_words(documents))
    costly = staged(values.join(known, "key", "left").where(F.pandas_udf(is_costly, "boolean")("value", "words")).select("value"), "secrets-costly")
    hits = staged(held.join(costly, "value").groupBy("id", "hash").agg(F.collect_set("value").alias("costly")), "secrets-hits")
    return rows.join(hits, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("hash")), "left").drop("id", "hash")


def scan_text(text: str, ranks: dict[str, int], cost: float = COST) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Base spans and the places of costly values."""
    return base_spans(text), [(a, b) for a, b in credential_values(text) if guess_cost(text[a:b], ranks) >= cost]


def scan_known(text: str, costly: Iterable[str] | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """As scan_text, where the costly values of the text are known."""
    known = set() if costly is None else set(costly)
    return base_spans(text), [(a, b) for a, b in credential_values(text) if text[a:b] in known] if known else []


def redact(text: str, base: list[tuple[int, int, int]], added: list[tuple[int, int]]) -> str:
    """Every span becomes [SECRET]; spans that overlap become one."""
    out, at = [], 0
    merged: list[list[int]] = []
    for a, b in sorted([(a, b) for a, _, b in base] + added):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[at:a], "[SECRET]"]
        at = b
    return "".join([*out, text[at:]])


def scan_all(texts: pd.Series, costly: pd.Series) -> pd.DataFrame:
    rows = []
    for t, known in zip(texts, costly, strict=True):
        base, added = scan_known(t, known)
        kinds = [k for _, k, _ in base]
        every = sorted(base + [(a, 3, e) for a, e in added])
        rows.append((*map(kinds.count, range(3)), ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e in base), ",".join(f"{(*KINDS, 'guess')[k]}:{a}:{e}" for a, k, e in every)))
    return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans"])


def redact_all(texts: pd.Series, costly: pd.Series) -> pd.Series:
    return pd.Series([redact(t, *scan_known(t, known)) for t, known in zip(texts, costly, strict=True)], dtype=object)


def find(documents: DataFrame) -> DataFrame:
    """One row for each row of documents: doc_id, n_assign, n_access, n_hex, base, spans."""
    one = F.pandas_udf(scan_all, "n_assign long, n_access long, n_hex long, base string, spans string")
    return with_costly(documents).select(F.col("own_id").alias("doc_id"), one(whole_text("row.text"), "costly").alias("r")).select("doc_id", "r.*")


def redacted(documents: DataFrame) -> DataFrame:
    """documents with every secret in `text` replaced; null texts and all other columns stay."""
    text = F.col("row.text")
    clean = F.when(text.isNull(), text).otherwise(F.pandas_udf(redact_all, "string")(whole_text("row.text"), "costly"))
    return with_costly(documents).select(*[clean.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in documents.columns])


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
