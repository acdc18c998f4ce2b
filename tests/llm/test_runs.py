import hashlib
import random
import re
import zlib

import pytest

from sluice.llm import runs


def plain_runs(w, least=runs.LEAST):
    """Every stretch in which words q apart are identical, for every q; the smallest q of a stretch counts."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        same = "".join("01"[w[k] == w[k + q]] for k in range(len(w) - q))
        for m in re.finditer("1+", same):
            s, e = m.start(), m.end() + q
            if e - s >= max(least, 2 * q):
                out.setdefault((s, e), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def plain_collapse(w, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return [x for k, x in enumerate(w) if k not in gone]


@pytest.mark.parametrize("least", [2, 12])
@pytest.mark.parametrize("small", [False, True])
def test_runs_against_brute_force(least, small, monkeypatch):
    """Random, periodic and Fibonacci words, several documents a block; small: few jumps and steps, so that the plain scan and the cuts are taken."""
    if small:
        for name in ("STEP", "TOGETHER", "JUMPS"):
            monkeypatch.setattr(runs, name, 1)
    draw = random.Random(least)
    for _ in range(150):
        docs = []
        for _ in range(draw.randint(1, 4)):
            n, letters = draw.randint(0, 70), draw.choice(["a", "ab", "abc"])
            w = [draw.choice(letters) for _ in range(n)]
            if n and draw.random() < 0.4:
                w = (w[: draw.randint(1, 9)] * 70)[:n]
            elif draw.random() < 0.4:
                x, w = ["a"], ["a", "b"]
                while len(w) < n:
                    x, w = w, w + x
                w = w[:n]
            docs.append([c.encode() for c in w])
        for w, got, text in zip(docs, *runs.search(docs, least), strict=True):
            want = plain_runs(w, least)
            assert [tuple(r) for r in got.tolist()] == want
            assert text == b" ".join(plain_collapse(w, want))


def digests(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(plain_collapse(w, found))))


def test_query_against_brute_force(spark, sf_dir):
    want = [digests(r["doc_id"], r["text"] if len(r["text"] or "") < 20_000 else None) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    long = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) >= 20000").collect()}
    got = runs.op11_runs(spark, sf_dir)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(tuple(r) for r in got.collect() if r["doc_id"] not in long) == sorted(w for w in want if w[0] not in long)
    assert sum(w[1] for w in want) > 10


def test_odd_tables(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows, clashing names, white space that is none of ASCII's; an empty table."""
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (None, "x " * 30), (4, "   é\u0085 " * 20), (4, "   é\u0085 " * 20), (5, "w " * 300_000), (6, " ".join(f"w{k}" for k in range(200_000)))]
    docs = spark.createDataFrame([(i, t, "r", 7, "c") for i, t in rows], "doc_id long, text string, runs string, start int, collapsed string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = runs.op11_runs(spark, str(tmp_path)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got if r[0] not in (5, 6)), key=key) == sorted((digests(*r) for r in rows if r[0] not in (5, 6)), key=key)
    assert [(r["n_runs"], r["length"], r["period"]) for r in got if r["doc_id"] == 5] == [(1, 300_000, 1)]
    assert len(got) == len(rows) and runs.find_runs(docs.limit(0)).count() == 0
    found = {r["doc_id"]: r for r in runs.find_runs(docs).collect()}
    assert found[5]["collapsed"] == "w" and [tuple(x) for x in found[5]["runs"]] == [(0, 300_000, 1)] and found[1]["runs"] == []
