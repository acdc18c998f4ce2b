import hashlib
import math
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import jaccard, mixing, pieces, pii, quality, registry, secrets, shingles, toxicity, vectors, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash."""
    long = " ".join(f"w{k}" for k in range(20_000))
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, ""), (None, "x"), (None, "x"), (5, long), (6, long + " end"), (7, " \t\n"), (8, "one two"), (9, "ONE two")]
    return spark.createDataFrame([(i, t, None, None, 0, "s") for i, t in rows], DOCS)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_as_sql(same_as_sql, name):
    same_as_sql(name)


def test_jaccard_against_brute_force(spark, sf_dir, odd):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    lower = {c: c + 32 for c in range(65, 91)}
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(lower))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {}
    for k, r in zip(label, rows, strict=True):
        least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    want = {(r["doc_id"], len(s), least[k]) for r, s, k in zip(rows, sets, label, strict=True)}
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()} == want
    got = jaccard.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r["component_id"] for r in got}
    assert by[1] == by[2] == 1 and by[5] == by[6] == 5 and by[8] == by[9] == 8 and by[3] == 3 and by[None] is None


def near_copies(spark, n):
    """n texts of 100 words that differ from one in one to four words each, and share a line with others of their own."""
    random = np.random.default_rng(3)
    rows = []
    for k in range(n):
        w = [f"w{j}" for j in range(100)]
        for j in random.choice(100, random.integers(1, 5), replace=False):
            w[j] = f"x{k}_{j}"
        rows.append((k, " ".join(w)))
    line = "a very common line that all of these documents share with each other"
    rows += [(10_000 + k, line + " " + " ".join(f"y{k}_{j}" for j in range(8))) for k in range(n // 4)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


@pytest.fixture(scope="module")
def near_copy_runs(spark):
    """For groups of three sizes: the rows, the classes found, how many pairs of a member and its pivot were compared, and how many pairs of members."""
    out, links, close = {}, jaccard.links_by_difference, jaccard.close_pairs
    with pytest.MonkeyPatch.context() as patch:
        for n in (150, 300, 600):
            seen, met = [], []
            patch.setattr(jaccard, "close_pairs", lambda pairs, points, met=met: (met.append(pairs.count()), close(pairs, points))[1])
            patch.setattr(jaccard, "links_by_difference", lambda pairs, diffs, seen=seen: (seen.append(pairs.count()), links(pairs, diffs))[1])
            docs, rows = near_copies(spark, n)
            out[n] = rows, {(r["doc_id"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()}, sum(met), sum(seen)
    return out


@pytest.mark.parametrize("n", [150, 300, 600])
def test_jaccard_near_copies(near_copy_runs, n):
    """A large group of near copies gives the classes of brute force."""
    rows, got = near_copy_runs[n][:2]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {}
    for k, (i, _) in zip(label, rows, strict=True):
        least[k] = min(least.get(k, i), i)
    assert got == {(i, least[k]) for k, (i, _) in zip(label, rows, strict=True)}


@pytest.mark.parametrize("n", [150, 300])
def test_jaccard_near_copies_growth(near_copy_runs, n):
    """At twice the group the pairs that are compared, with pivots and of members, should at most triple."""
    pairs = {n: x[2] + x[3] for n, x in near_copy_runs.items()}
    print("PAIRS", {n: x[2:] for n, x in near_copy_runs.items()})
    assert pairs[2 * n] < 3 * pairs[n]


def test_jaccard_compares_few_pairs(near_copy_runs):
    """Of all pairs of a group few are compared, and those with pivots are few for each member."""
    for n, (_, _, met, seen) in near_copy_runs.items():
        assert met + seen < n * n / 2 / 5 and met < 10 * n


def test_parities():
    """Sketches, the larger folded, differ in no more bits than sets do in shingles."""
    random = np.random.default_rng(5)
    for n in (1, 5, 200, 250, 300, 500, 600, 5000):
        for cut, new in ((0, 0), (0, 1), (n // 8, 0), (n // 10, n // 10), (n, n)):
            x = np.unique(random.integers(0, 2**64, n, dtype=np.uint64))
            y = np.unique(np.concatenate([x[cut:], random.integers(0, 2**64, new, dtype=np.uint64)]))
            if not len(y):
                continue
            s = sorted((jaccard.parities(x), jaccard.parities(y)), key=len)
            while len(s[0]) < len(s[1]):
                s[1] = s[1][: len(s[1]) // 2] ^ s[1][len(s[1]) // 2 :]
            bits = int(np.bitwise_count((s[0] ^ s[1]).view(np.uint64)).sum())
            assert bits <= len(np.setxor1d(x, y)) and (cut + new == 0) <= (bits == 0)


def test_prefix_and_sets():
    got = shingles.shingle_sets(["a b c d e f", "A  b\tc d e f", "", "a b", "b a"])
    assert [len(g) for g in got] == [2, 2, 0, 1, 1] and (got[0] == got[1]).all() and got[3][0] != got[4][0]


def test_forest_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    p = rows.toPandas()
    x, ids = np.array(p.embedding.tolist(), float), p.vec_id.to_numpy()
    got = vectors.op1_forest(spark, sf_dir).toPandas()
    hits = total = 0
    for q, part in got.groupby("query_id"):
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        want = set(ids[np.lexsort((ids, d))[:10]])
        hits, total = hits + len(want & set(part.vec_id)), total + 10
        assert np.allclose(part.sort_values("rank").score, [d[ids == v][0] for v in part.sort_values("rank").vec_id])
    assert hits >= 0.9 * total


def test_vectors_odd(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [0.0, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vectors.best_products(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 65536), (0, 2, 65536), (0, 50, 32768), (0, 6, 0), (50, 0, 32768), (50, 1, 32768), (50, 2, 32768), (50, 6, 0)]
    near = vectors.approximate_neighbours(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r["vec_id"] for r in near] == [1, 2, 50]
    assert vectors.best_products(df.limit(0), F.lit(True)).count() == 0



@pytest.fixture
def groups():
    """Vectors around few heads, one of which many rows repeat."""
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(12, 8)) * 4)[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 8)) * 0.1
    x[100:400] = x[100]
    return x


def test_products_of_groups(spark, groups, monkeypatch):
    """Several blocks of points and of queries, against brute force."""
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 200)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(groups)], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in vectors.best_products(df, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect()]
    z, ids = np.floor(groups * 256).astype(np.int64), np.arange(len(groups))
    want = []
    for q in range(0, len(z), 10):
        s = z @ z[q]
        want += [(q, k + 1, int(j), int(s[j])) for k, j in enumerate([j for j in np.lexsort((ids, -s)) if j != q][:5])]
    assert got == want
    assert vectors.best_products(df, F.col("vec_id") < 0).count() == 0


def test_dual_search_prunes_node_pairs(groups):
    """The best six of every query are found, ties with the sixth too, and few of all pairs are kept."""
    z = np.floor(groups * 256).astype(np.int64)
    a, b = vectors.CoverTree(z[::10]), vectors.CoverTree(z)
    q, d, score = vectors.dual_search(a, b, np.full(len(a.points), -(2.0**62)), 6)
    every = a.points @ b.points.T
    r, c = np.nonzero(every >= np.sort(every, axis=1)[:, -6:-5])
    kept = set(zip(q.tolist(), d.tolist(), strict=True))
    assert kept >= set(zip(r.tolist(), c.tolist(), strict=True)) and len(kept) < every.size / 20
    assert (score == every[q, d]).all()


def test_forest_of_cut_leaves(spark, groups, monkeypatch):
    """Leaves that are cut into parts give the same result."""
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(groups)], "vec_id long, embedding array<double>")
    find = lambda: [tuple(r) for r in vectors.approximate_neighbours(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    whole = find()
    monkeypatch.setattr(vectors, "LEAF_ROWS", 10)
    assert find() == whole and len(whole) == 300


def test_pieces(spark, odd):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    plain, dropped = pieces.Encoder(*pieces.load(), rate=0.0), pieces.Encoder(*pieces.load())
    texts = ["Hello  world", " a ", "", "日本語 \n\tx", "a" * 300, " " * 40, "<s> <0x41>", "▁ x"]
    for t, g in zip(texts, plain.encode(texts, [1] * len(texts)), strict=True):
        assert plain.decode(g) == t and ("▁" in t or g.tolist() == sp.encode(t))
    one, two = (dropped.encode(["internationally known tokenizers"] * 40, list(range(k, k + 40))) for k in (0, 0))
    assert all((a == b).all() for a, b in zip(one, two, strict=True)) and len({g.tobytes() for g in one}) > 1
    for t, g in zip(texts, dropped.encode(texts, [3] * len(texts)), strict=True):
        assert dropped.decode(g) == t
    sym, key = dropped.sign[[0x2581, *map(ord, "internationally")]], np.array([77], np.uint64)
    rows, n = dropped.rows(sym.reshape(-1, 1).copy(), np.array([len(sym)]), key)
    assert rows[: n[0], 0].tolist() == dropped.word(sym.tolist(), 77)
    assert all(r["pieces"]["lossless"] for r in pieces.encoded(odd).collect())



def test_pieces_against_single_agendas(spark, sf_dir):
    """Every text of the table at the query's rate, word by word with an agenda of its own."""
    e = pieces.Encoder(*pieces.load())
    texts = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        texts.setdefault(r["doc_id"], r["text"] or "")
    got = {r["doc_id"]: r for r in pieces.op3_pieces(spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        signs = [pieces.BLANK if c == " " else pieces.OWN_BLANK if ord(c) == pieces.BLANK else ord(c) for c in f" {text}"] if text else []
        starts = [k for k, c in enumerate(signs) if c == pieces.BLANK and (k == 0 or signs[k - 1] != pieces.BLANK)]
        ids = []
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(signs)], strict=True)):
            key = pieces.mix(np.array([(int(pieces.document_key(str(i), pieces.SEED)) + n * int(pieces.K1)) % 2**64], np.uint64))[0]
            for x in e.word(e.sign[signs[a:b]].tolist(), int(key)):
                if x < e.size:
                    ids.append(x)
                else:
                    c = x - e.size
                    ids += e.byte_ids[list(chr(pieces.BLANK if c == pieces.OWN_BLANK else c).encode("utf-8", "surrogatepass"))].tolist()
        assert got[i]["n_tokens"] == len(ids) and got[i]["lossless"]
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_pii_base():
    text = "mail a.b@c.de, 10.0.0.255 300.1.1.1; 4111 1111 1111 1111 +49 (30) 1234567 x@y"
    spans = pii.base_spans(text)
    assert [(k, text[a:b]) for k, a, b in spans] == [("email", "a.b@c.de"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+49 (30) 1234567")]
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for t in ("a@b.c@d.e", "@@a@b..c", "x@y.z.w", "a" * 50 + "@b.c", "q@.x a@b-c.d", "a@b a@b.c"):
        assert list(pii.emails(t)) == [m.span() for m in email.finditer(t)]


def test_pii_disclosure(spark, odd):
    rows = [(k, f"call zorblax quux the admin bob@x.org about the {w}") for k, w in enumerate(["alpha", "beta", "gamma"])] + [(100 + k, "about the admin call nothing here") for k in range(40)]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", pii.term_spans().alias("spans")).collect()}
    assert "term:5:12" in got[0] and "term:23:28" not in got[0] and got[100] == []
    assert pii.find(odd).count() == odd.count()
    assert "bob" not in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 0").first()["text"]


def test_pii_disclosure_at_any_distance(spark):
    """A term far from the entity discloses it, also where only the term is written; counts are those of whole documents."""
    gap = " ".join(["filler"] * 40)
    rows = [(k, f"Zorblax {gap} mail bob@x.org now") for k in range(4)] + [(10, "nobody but zorblax, Zorblax!"), (None, "x zorblax")] + [(100 + k, f"filler mail now and {'quux' * (k < 3)}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["added"] for r in pii.find(docs).collect()}
    n, c, t, both = len(rows), 4, 6, 4
    share = np.log(n * both / (c * t)) / np.log(n / c)
    assert [r["share"] for r in pii.disclosures(pii.rows_of(docs), n).collect()] == [pytest.approx(share)]
    assert got[0] == ["0:7:remove"] and got[10] == ["11:18:remove", "20:27:remove"] and got[None] == ["2:9:remove"]
    assert not any(got[100 + k] for k in range(60)) and pii.find(docs).count() == n
    assert "orblax" not in "".join(r["text"] for r in pii.sanitise(docs).collect())



def plain_spans(text):
    """The base patterns as the contract writes them."""
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    }
    return [(k, *m.span()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text) if ok(m[0])]


def test_pii_against_brute_force(spark, sf_dir):
    """Every base span, and every term that discloses by counts of document rows, of the whole table."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    texts = [r["text"] or "" for r in rows]
    spans = [plain_spans(t) for t in texts]
    terms, entities = [], []
    for t, found in zip(texts, spans, strict=True):
        terms.append([(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W\d_]{3,}", t) if not any(a < m.end() and m.start() < b for _, a, b in found)])
        entities.append({pii.entity(k, t[a:b]) for k, a, b in found})
    n, action = len(rows), {}
    n_t = Counter(x for t in terms for x in {w for _, _, w in t})
    for c, n_c in Counter(e for held in entities for e in held).items():
        for w, both in Counter(x for t, held in zip(terms, entities, strict=True) if c in held for x in {w for _, _, w in t}).items():
            if both >= pii.SUPPORT and n_c < n:
                share = np.log(n * both / (n_c * n_t[w])) / np.log(n / n_c)
                if share >= pii.GENERALISE:
                    action[w] = max(action.get(w, ""), "remove" if share >= pii.REMOVE else "generalise")
    want = []
    for r, found, held in zip(rows, spans, terms, strict=True):
        out = [f"{k}:{a}:{b}" for k, a, b in found] + [f"term:{a}:{b}" for a, b, w in held if w in action]
        want.append((r["doc_id"], *[sum(x[0] == k for x in found) for k in pii.KINDS], ",".join(out), ",".join(sorted(f"{a}:{b}:{action[w]}" for a, b, w in held if w in action))))
    names = ["doc_id", *[f"n_{k}" for k in pii.KINDS], "spans", "actions"]
    assert Counter(want) == Counter(tuple(r) for r in pii.op4_pii(spark, sf_dir).select(*names).collect())
    assert any(spans)


def test_pii_odd_columns_and_long_digits(spark, odd):
    """Columns whose names clash stay, an empty table stays empty, and a long run of digits takes linear time."""
    rows = [(k, "+ bob@x.org", "mine", k, 7, "r") for k in range(3)] + [(None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string, added long, f_id long, row string")
    got = pii.sanitise(docs).orderBy("added").collect()
    assert [tuple(r) for r in got] == [tuple([None] * 6)] + [(k, "+ [EMAIL]", "mine", k, 7, "r") for k in range(3)]
    assert pii.find(odd.limit(0)).count() == 0 and pii.sanitise(odd.limit(0)).count() == 0
    took = []
    for size in (100_000, 400_000):
        began = time.perf_counter()
        assert pii.base_spans("7" * size + ".1") == []
        took.append(time.perf_counter() - began)
    assert took[1] < 10 * took[0] + 0.5


def test_secrets(spark, odd):
    ranks = {"password": 1, "dragon": 2, "summer": 3}
    assert secrets.guess_cost("dragonsummer", ranks) < 3 < secrets.guess_cost("x7Kq9vB2mZpL", ranks)
    assert secrets.guess_cost("aaaaaaaaaaaa", ranks) < 4 and secrets.guess_cost("19990101", ranks) < 6 and secrets.guess_cost("qwertyuiop", ranks) < 4
    text = "API_KEY: 'abcdef' password=abc AKIA" + "A" * 16 + " " + "0f" * 12 + " pwd: x7Kq9vB2mZpL"
    base, added = secrets.scan_text(text, ranks)
    assert [k for _, k, _ in base] == [0, 1, 2] and "x7Kq9vB2mZpL" in [text[a:b] for a, b in added]
    assert "x7Kq" not in secrets.redact(text, base, added)
    assert secrets.find(odd).count() == odd.count()


@pytest.mark.parametrize("name", "pwd passphrase passcode credential credentials bearer authorization private_key access_key client_secret login".split())
def test_secrets_each_place_alone(name):
    value = "p@ss#9x!Zk"
    for text in (f'{name}: "{value}"', f"{name.upper()}{' ' * 9}={' ' * 7}{value} end", f"{name} is {value}", f"{name} {value}"):
        assert [text[a:b] for a, b in secrets.scan_text(text, {})[1]] == [value]
    long = f"{name}{' ' * 200_000}:"  # many blanks take linear time
    assert secrets.credential_values(long) == []


def test_secrets_long_values():
    """Parts of a value cross any place, units of repeats have any size, and a unit costs no more than by itself."""
    assert secrets.guess_cost("x" * 600, {}) < 5 and secrets.scan_text("login: " + "x" * 600, {})[1] == []
    assert secrets.guess_cost("z9" * 120 + "-1234567890" * 120, {}) < 14
    ranks = {"correct": 5, "horse": 6, "battery": 7}
    once = secrets.guess_cost("correcthorsebattery", ranks)
    assert secrets.guess_cost("correcthorsebattery" * 50, ranks) == pytest.approx(once + np.log10(50) + np.log10(2))
    assert secrets.guess_cost("A7" + "b" * 300 + "dragon" * 3, {"dragon": 2}) < 12
    random = np.random.default_rng(1)
    for _ in range(200):
        v = "".join(random.choice(list("abc"), random.integers(1, 40)))
        want = set()
        for p in range(1, len(v) // 2 + 1):
            for m in re.finditer("1+", "".join("01"[v[k] == v[k + p]] for k in range(len(v) - p))):
                w = v[m.start() : m.end() + p]
                if len(w) >= 2 * p and not any(w[q:] == w[:-q] for q in range(1, p)):
                    want.add((m.start(), m.end() + p, p))
        assert sorted(secrets.repeats(v)) == sorted(want)


def test_secrets_rare_words(spark):
    """A word counts at its own rank, however many words are more frequent."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    common = ["q" + a + b + c for a in letters for b in letters for c in letters]
    rows = [(k, " ".join(common[k::20])) for k in range(20)] * 2 + [(100, "login metamorphosis"), (None, "login x7Kq9vB2mZpL")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ranks = {r["word"]: r["rank"] for r in secrets.corpus_words(docs).collect()}
    assert ranks == {w: k for k, w in enumerate(["login", *common, "metamorphosis", "mzpl"], 1)}
    got = {r["doc_id"]: r["spans"] for r in secrets.find(docs).collect()}
    assert got[100] == "" and got[None] == "guess:6:18" and secrets.find(docs).count() == len(rows)
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(docs).collect()}
    assert clean[100] == "login metamorphosis" and clean[None] == "login [SECRET]"


def test_mixing(spark, odd):
    rows = [(k, "a b c d", "big" if k % 10 else "small") for k in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, entropy=0.9, repeats=10.0, block_tokens=400)
    n = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
    p = n["small"] / sum(n.values())
    assert abs(-(p * np.log(p) + (1 - p) * np.log(1 - p)) - 0.9 * np.log(2)) < 0.01
    few = mixing.mix(df, entropy=1.0, repeats=2.0, block_tokens=400)
    assert few.where("source = 'small'").agg(F.max("copy")).first()[0] == 2
    assert got.groupBy("block").agg((F.max("position") == F.count("*")).alias("ok")).where("not ok").count() == 0
    assert mixing.mix(odd).count() > 0 and mixing.mix(odd.limit(0)).count() == 0


@pytest.mark.parametrize(("query", "label", "least"), [("op7_quality", "quality", 0.9), ("op10_toxicity", "toxic", 0.85)])
def test_held_out(spark, query, label, least):
    d = "/root/testdata/sf0.01"
    got = registry.QUERIES[query](spark, d)
    both = got.where("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    assert both.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0] >= least


def test_classifiers_odd(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score_documents(odd.drop("score"), toxicity.fit(odd, none)).collect()} == {0.5}
    assert {r["score"] for r in quality.score_documents(odd.drop("score"), quality.fit(odd, none)).collect()} == {0.5}



def test_score_takes_the_place_of_a_column(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for m in (toxicity, quality):
        got = m.score_documents(odd, m.fit(odd, none))
        assert got.columns == odd.columns and dict(got.dtypes)["score"] == "double" and got.count() == odd.count()
        assert m.score_documents(odd.limit(0), m.fit(odd.limit(0), none)).count() == 0


def test_votes_against_full_sort():
    """Nearest by similarity, then place; plain similarity weighs. Products of these vectors are exact, so that many are equal."""
    rng = np.random.default_rng(2)
    draw = lambda n: np.sign(rng.integers(-1, 2, (n, 4))).astype(np.float32) / 2
    known, asked, labels = draw(60), draw(200), rng.integers(0, 2, 60).astype(np.float32)
    want = []
    for v in asked:
        cos = [float(v @ u) for u in known]
        near = sorted(range(60), key=lambda k: (-cos[k], k))[: quality.NEIGHBOURS]
        total = sum(max(cos[k], 0) for k in near)
        want.append(sum(max(cos[k], 0) * labels[k] for k in near) / total if total else labels.mean())
    assert quality.vote(asked, known, labels) == pytest.approx(want, abs=1e-6)


def test_ftrl_against_plain_loop():
    """One coordinate at a time, in dictionaries."""
    rng = np.random.default_rng(4)
    bits, epochs, a, b, l1, l2 = 8, 3, 0.3, 1.0, 2.0, 0.1
    rows = [(np.unique(rng.integers(0, 40, 6) + 30 * y), y) for y in rng.integers(0, 2, 80).tolist()]
    z, n, bias = Counter(), Counter(), "bias"

    def weight(i):
        shrink = 0 if i == bias else l1
        if abs(z[i]) <= shrink:
            return 0.0
        return -(z[i] - math.copysign(shrink, z[i])) / ((b + math.sqrt(n[i])) / a + l2)

    order = np.random.default_rng(17)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            x, y = rows[k]
            held = [*x.tolist(), bias]
            w = {i: weight(i) for i in held}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in held:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / a * w[i]
                n[i] += g * g
    got = toxicity.ftrl(rows, bits, epochs, a, b, l1, l2)
    want = {i: weight(i) for i in sorted(k for k in z if k != bias) if weight(i)}
    assert got.index.tolist() == list(want) and got.value == pytest.approx(list(want.values()), rel=1e-5)
    assert got.bias == pytest.approx(weight(bias)) and len(want) < len(z) - 1


def test_warc_odd(spark, tmp_path):
    body = "x" * 200
    rows = [(5, "u 1", body), (3, None, body), (None, "v", body), (7, "w", None), (8, "w", "short"), (9, "w", "short"), (3, "z", body), (10, "w", "é" * 300_000)]
    got = warc.archive(spark, spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path)).collect()
    assert len(got) == len(rows) and sum(r["record_type"] == "response" for r in got if r["payload_bytes"] == 200) == 1
    assert {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {3}
    assert {r["page_id"] for r in got if r["payload_bytes"] == 600_000} == {10}


def test_warc_no_pages_and_short_ones(spark, tmp_path):
    """An empty table gives no rows; short payloads that stand very often are all responses and don't join; the folder is named as Spark names it."""
    schema = "page_id long, url string, html string"
    assert warc.archive(spark, spark.createDataFrame([], schema), str(tmp_path / "none")).count() == 0
    rows = [(k, "u", None if k % 3 else "short") for k in range(900)] + [(900 + k, "u", "y" * (99 + k // 2)) for k in range(4)]
    got = warc.archive(spark, spark.createDataFrame(rows, schema), str(tmp_path / "some")).collect()
    assert len(got) == 904 and [(r["page_id"], r["refers_to"]) for r in got if r["record_type"] == "revisit"] == [(903, 902)]
    assert warc.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    records = spark.createDataFrame([("f", k, k, 5 if k else 100, "d") for k in range(3)], "file string, seq long, page_id long, payload_bytes long, payload_digest string")
    assert [r["revisit"] for r in warc.settle(records).collect()] == [False] * 3
