"""Secret scans against plain versions."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from sluice.llm import secrets
from sluice.llm.common import table

BASE = {"assign": (r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, re.I | re.A), "access": (r"(AKIA[A-Z0-9]+)", 20, 0), "hex": (r"([0-9a-f]+)", 24, 0)}


def plain_cost(value: str, ranks: dict[str, int]) -> float:
    """The least cost over every way to cut the value, each part at the cost of its cheapest kind."""
    n, low, step = len(value), value.lower(), math.log10(2)
    runs = []
    for size in range(1, n // 2 + 1):
        for m in re.finditer("1+", "".join("01"[value[k] == value[k + size]] for k in range(n - size))):
            a, b = m.start(), m.end() + size
            if b - a >= 2 * size and not any(value[a:b][q:] == value[a:b][:-q] for q in range(1, size)):
                runs.append((a, b, size))

    def part(a: int, b: int) -> float:
        s, costs = value[a:b], [(b - a) * math.log10(secrets.alphabet(value))]
        if low[a:b] in ranks and len(s) >= 3:
            upper = sum(c.isupper() for c in s)
            costs.append(math.log10(ranks[low[a:b]] + 1) + (0 if not upper else step if upper == len(s) or upper == 1 and s[0].isupper() else upper * step))
        if (m := secrets.DATE.match(value, a)) and m.end() == b:
            costs.append(math.log10(120 if b - a == 4 else 365 * 120 * (1 if s.isdigit() else 4)))
        for x, y, size in runs:
            if a >= x and a + (3 if size == 1 else 2) * size <= y and b == a + (y - a) // size * size:
                costs.append(size * math.log10(secrets.alphabet(value[a : a + size])) + math.log10((y - a) // size))
            if (c := a - size) >= x and c + (3 if size == 1 else 2) * size <= y and b == c + (y - c) // size * size:
                costs.append(math.log10((y - c) // size))
        pairs = [low[k : k + 2] in secrets.NEXT for k in range(a, b - 1)]
        if b - a >= 4 and all(pairs) and (b == n or low[b - 1 : b + 1] not in secrets.NEXT):
            costs.append(math.log10(len("".join(secrets.ROWS))) + math.log10(2 * (b - a)))
        return min(costs) + step

    best = [0.0] + [math.inf] * n
    for cut in range(1 << (n - 1)):
        ends = [k + 1 for k in range(n - 1) if cut >> k & 1] + [n]
        best[n] = min(best[n], sum(part(a, b) for a, b in zip([0, *ends], ends)))
    return best[n]


def test_cost_against_all_segmentations():
    random = np.random.default_rng(7)
    ranks = {"dra": 3, "dragon": 9, "gon": 40, "sum": 2, "aab": 5}
    bits = ["dragon", "Dra", "GON", "sum", "aab", "aaaa", "abab", "1999", "qwert", "2", "x7", "K", "-", "0101"]
    for _ in range(60):
        value = "".join(random.choice(bits, 4))[:9]
        assert secrets.guess_cost(value, ranks) == pytest.approx(plain_cost(value, ranks)), value


def test_long_words(spark):
    """A word of any length is one word, with its own rank; what shares only its first letters with a word is not."""
    long = "geschwindigkeitsbegrenzung"
    near = long[:-4] + "qzxw"
    huge = "".join(np.random.default_rng(3).choice(list("abcdefghijklmnop"), 5000))
    rows = [(1, f"schilder {long} {huge}"), (2, f"login {long}"), (3, "login x7Kq9vB2mZpL"), (4, f"pwd: {long.title()}"), (5, f"pwd: {huge}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ranks = {r["word"]: r["rank"] for r in secrets.corpus_words(docs).collect()}
    assert ranks[long] == 1 and huge in ranks and long[:16] not in ranks
    values = spark.createDataFrame([("a", long), ("b", near), ("c", "x" + long + huge)], "key string, low string")
    got = {r["key"]: {w["word"] for w in r["words"]} for r in secrets.words_within(values, spark.createDataFrame(list(ranks.items()), "word string, rank long")).collect()}
    assert long in got["a"] and long not in got.get("b", set()) and {long, huge} <= got["c"]
    spans = {r["doc_id"]: r["spans"] for r in secrets.find(docs).collect()}
    assert spans[2] == spans[4] == spans[5] == "" and spans[3] == "guess:6:18"


def test_heads_leave_in_portions(monkeypatch):
    monkeypatch.setattr(secrets, "FLUSH", 1000)
    low = "".join(np.random.default_rng(4).choice(list("abcdefghijklmnop"), 2000))
    parts = list(secrets.heads_of(iter([pd.DataFrame({"key": ["k"], "low": [low]})])))
    assert max(map(len, parts)) <= 1000 + secrets.HEAD
    assert set(pd.concat(parts)["head"]) == {low[a:b] for a in range(len(low)) for b in range(a + 3, min(a + 16, len(low)) + 1)}


def test_query_against_plain_version(spark, sf_dir, tmp_path):
    """The documents of the table, with a secret of some kind in every third."""
    random = np.random.default_rng(5)
    word = lambda signs, k: "".join(random.choice(list(signs), k))
    kinds = [lambda: f" API_KEY: '{word('abXY019+/', 14)}'", lambda: f" AKIA{word('ABC123', 16)}", lambda: f" {word('0123456789abcdef', 30)}", lambda: f" pwd is {word('abc#$9Q', 12)}", lambda: " password=short login: summer"]
    planted = pd.read_parquet(f"{sf_dir}/documents.parquet")
    planted["text"] = [f"é😀 {t}{kinds[k % len(kinds)]()} {t}" if k % 3 == 0 else t for k, t in enumerate(planted["text"])]
    sf_dir = str(tmp_path)
    planted.to_parquet(f"{sf_dir}/documents.parquet")
    docs = [(r["doc_id"], r["text"] or "") for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    n = Counter(w for _, t in docs for w in re.findall(r"[^\W\d_]{3,}", t.lower()))
    ranks = {w: k for k, w in enumerate(sorted(n, key=lambda w: (-n[w], w)), 1)}
    want = []
    for d, t in docs:
        base = sorted((m.start(), k, m.end()) for k, (p, least, flags) in enumerate(BASE.values()) for m in re.finditer(p, t, flags) if len(m[1]) >= least)
        added = [(a, 3, b) for a, b in secrets.credential_values(t) if secrets.guess_cost(t[a:b], ranks) >= secrets.COST]
        name = lambda spans: ",".join(f"{[*BASE, 'guess'][k]}:{a}:{b}" for a, k, b in spans)
        want.append((d, *[sum(k == x for _, k, _ in base) for x in range(3)], hashlib.sha256(name(base).encode()).hexdigest(), name(sorted(base + added))))
    assert Counter(want) == Counter(tuple(r) for r in secrets.op8_secrets(spark, sf_dir).collect())
    assert all(any(k in w[-1] for w in want) for k in [*BASE, "guess"])
