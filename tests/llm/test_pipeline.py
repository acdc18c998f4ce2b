import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import mixing, pieces, toxicity
from sluice.llm.common import staged, table

LOWER = {c: c + 32 for c in range(65, 91)}
BASE = [r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]{6,})", r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """(input rows, output rows) of each stage, as run() has them."""
    docs, out = table(spark, sf_dir, "documents"), {}
    text = "The deploy notes of {} say api_key = 'q9Zr{}Lm2' and AKIA" + "B7" * 9 + " then {} more words"
    planted = [(10**9 + k, text.format(k, k, k), "en", "src0", 0) for k in range(3)]
    docs = docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string, lang string, source string, n_chars long").select(*[F.col(f.name).cast(f.dataType) for f in docs.schema]))
    for name, stage in corpus_pipeline.STAGES:
        got = staged(stage(spark, docs, sf_dir), f"test-{name}")
        out[name] = docs.collect(), got.collect()
        docs = got
    return out


def test_toxicity(stages, spark, sf_dir):
    before, after = stages["toxicity"]
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    weight = dict(zip(model.index.tolist(), model.value.tolist(), strict=True))
    keep = []
    for r in before:
        found = set(toxicity.features(r["text"] or "", toxicity.Hashes()).tolist())
        if model.bias + sum(weight.get(i, 0) for i in found) < 0:
            keep.append(r)
    assert sorted(after) == sorted(keep) and 0 < len(keep) < len(before)


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    sets = []
    for r in before:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(LOWER))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(before)))
    for i in range(len(before)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for g, r in zip(group, before, strict=True):
        least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    assert sorted(after) == sorted(r for g, r in zip(group, before, strict=True) if r["doc_id"] == least[g])


def test_secrets(stages):
    before, after = (({r["doc_id"]: r for r in rows}) for rows in stages["secrets"])
    assert before.keys() == after.keys()
    changed = 0
    for k, r in before.items():
        text, new = r["text"] or "", after[k]["text"] or ""
        assert not any(m.group(m.lastindex or 0) for p in BASE for m in re.finditer(p, new) if "SECRET" not in m.group())
        assert len(new) == after[k]["n_chars"] and after[k]["source"] == r["source"]
        assert new == text or "[SECRET]" in new
        if any(re.search(p, text) for p in BASE):
            assert new != text
        changed += new != text
        # What is left of the old text stands in its old order.
        at = 0
        for part in new.split("[SECRET]"):
            at = text.index(part, at) + len(part)
    assert 0 < changed < len(before)


def test_mixing(stages):
    before, after = stages["mixing"]
    assert set(after) <= set(before)
    tokens = lambda rows: {s: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows if r["source"] == s) for s in {r["source"] for r in before}}
    old, new = tokens(before), tokens(after)
    flat = lambda n: (lambda p: -(p * np.log(p)).sum())(np.array([v for v in n.values() if v]) / sum(n.values()))
    assert flat(new) >= flat(old) - 0.01
    assert abs(sum(new.values()) / sum(old.values()) - 1) < 0.2


def test_encoding(stages):
    before, after = stages["encoding"]
    assert len(before) == len(after) and all(r["lossless"] for r in after)
    text = {r["doc_id"]: r["text"] or "" for r in before}
    decoder = pieces.Encoder(*pieces.load())
    assert all(decoder.decode(np.array(r["token_ids"], np.int32)) == text[r["doc_id"]] for r in after)


def test_odd_tables(spark, sf_dir):
    """Columns with clashing names keep their values; null and empty texts stay; an empty table stays empty."""
    names = "doc_id text lang source n_chars score costly_ hash_ id_ row".split()
    rows = [(1, "a b c d e f g"), (2, "A b c d e f g"), (2, "A b c d e f g"), (3, None), (4, ""), (None, None), (None, ""), (5, "password=abcdefgh1")]
    odd = spark.createDataFrame([(i, t, None, None, 7, *"cdefg") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score string, costly_ string, hash_ string, id_ string, row string")
    docs = {None: odd, True: odd.limit(0)}
    for empty, d in docs.items():
        for name, stage in corpus_pipeline.STAGES:
            d = staged(stage(spark, d, sf_dir), f"odd-{name}")
            if name == corpus_pipeline.STAGES[-1][0]:
                break
            assert d.columns == names
            got = d.collect()
            assert all(r[5:] == tuple("cdefg") for r in got) and bool(got) != bool(empty)
            if name == "near_duplicates" and not empty:
                assert sorted(str(r["doc_id"]) for r in got) == sorted(["1", "3", "4", "5", "None", "None"])
        assert d.where("not lossless").count() == 0


def test_mixing_of_repeated_rows(spark):
    """Rows that repeat id and text get, together, as many copies as the mixture has for them, and other columns of each stay; rows come in block order."""
    rows = [(1, "a b c d", "small", k) for k in range(10)] + [(100 + k, "w " * 4, "big", k) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n long")
    settings = {"entropy": 1.0, "repeats": 50.0, "block_tokens": 400}
    plan = mixing.mix(docs, **settings)
    got = mixing.mixed_documents(docs, **settings)
    want = {(r["doc_id"], r["block"]): r["n"] for r in plan.groupBy("doc_id", "block").agg(F.count("*").alias("n")).collect()}
    assert got.count() == sum(want.values())
    small = [r["n"] for r in got.where("doc_id = 1").groupBy("n").count().select(F.col("count").alias("n")).collect()]
    assert len(small) == 10 and sum(small) == sum(n for (i, _), n in want.items() if i == 1) and max(small) - min(small) <= 1
    order = [r["doc_id"] for r in plan.orderBy("block", "position").collect()]
    assert [r["doc_id"] for r in got.collect()] == order
