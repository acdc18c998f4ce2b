from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import language
from sluice.llm.common import fold, table

DOCS = "doc_id long, text string, lang string, lang_pred string, score string, hash int, n int"


def plain_terms(text):
    """N-grams one by one: letters lower-cased, anything else a blank, none with two blanks in a row, no single blanks."""
    signs = [(c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text]
    out, mask = Counter(), 2**32 - 1
    m1, m2 = int(language.M1), int(language.M2)
    for n in (1, 2, 3):
        for k in range(len(signs) - n + 1):
            g = "".join(signs[k : k + n])
            if g == " " or "  " in g:
                continue
            h = ord(g[0]) * m1 & mask
            if n > 1:
                h = (h ^ ord(g[1]) + 1) * m2 & mask
            if n > 2:
                h = (h ^ ord(g[2]) + 2) * m1 & mask
            out[h >> 18] += 1
    return out if any(c != " " for c in signs) else None


def dense(counts):
    out = np.zeros(language.DIMS)
    for k, n in counts.items():
        out[k] = n
    return out


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 10**6])
def test_terms(monkeypatch, piece):
    """Against a plain loop, however long texts are cut."""
    monkeypatch.setattr(language, "PIECE", piece)
    for text in ("", " ", "12 ,.", "a", "Ab", "a b", "  Straße  ÉTÉ, 3x d'accord", "İ ǅ 日本語x", "\ud800a", "a" * 50 + "  " * 9 + "b"):
        got, want = language.terms(text), plain_terms(text)
        assert (got is None) == (want is None)
        if want is not None:
            assert (got == dense(want)).all()


def test_predictions_against_brute_force(spark, sf_dir):
    """Frequencies and cosines of the whole table from plain counts; the query's own rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    train = F.coalesce(fold("doc_id", 3) != 1, F.lit(False))
    idf, languages, centres, of, reach = language.fit(docs, train)
    learned = [plain_terms(r["text"] or "") for r in docs.where(train).where("lang is not null").collect()]
    df = Counter(k for c in learned if c for k in c)
    n = sum(c is not None for c in learned)
    want = np.array([np.log((1 + n) / (1 + df[k])) + 0.1 for k in range(language.DIMS)])
    assert idf == pytest.approx(want, rel=1e-5) and languages == sorted(set(languages)) and Counter(of.tolist()).most_common()[-1][1] > 1
    got = {r["doc_id"]: r for r in language.op13_language(spark, sf_dir).collect()}
    held = 0
    for r in docs.withColumn("held_out", fold("doc_id", 3) == 1).collect():
        c, g = plain_terms(r["text"] or ""), got[r["doc_id"]]
        assert g["held_out"] == r["held_out"]
        if c is None:
            assert (g["lang_pred"], g["score"]) == ("und", 0.0)
            continue
        w = np.log1p(dense(c)) * want
        cos = centres @ (w / np.linalg.norm(w))
        k = int(cos.argmax())
        assert g["score"] == pytest.approx(cos[k], abs=1e-4) and (g["lang_pred"] == languages[of[k]] or np.sort(cos)[-2] > cos[k] - 1e-4)
        held += r["held_out"]
    assert len(got) == docs.count() and held


def test_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = language.op13_language(spark, d).where("held_out").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] >= 0.97


def test_clusters_and_rejection(spark):
    """Clusters of a language part, unlike texts are rejected, a small language keeps its rows in the sample."""
    rng = np.random.default_rng(4)
    rows = np.zeros((60, 8), np.float32)
    rows[np.arange(60), np.arange(60) % 3] = 1
    rows = language.clustered((rows + rng.normal(size=rows.shape) * 0.01).astype(np.float32), most=3)[0]
    assert np.allclose(np.abs(rows).max(1), 1, atol=0.1) and sorted(np.abs(rows).argmax(1).tolist()) == [0, 1, 2]
    docs = [(k, f"the house and the garden {k} with that thing", "en") for k in range(400)] + [(1000 + k, f"der garten und das haus {k} mit dem ding", "de") for k in range(4)] + [(2000, "zzzqqq xxkkj wwwq", "en")]
    df = spark.createDataFrame([(*d, "x", "y", 1, 2) for d in docs], DOCS)
    model = language.fit(df.where("doc_id < 2000"), sample=6)
    got = {r["doc_id"]: r for r in language.identify(df, model).collect()}
    assert got[1000]["lang_pred"] == "de" and got[5]["lang_pred"] == "en" and got[2000]["rejected"] and not got[5]["rejected"]


def test_odd_tables(spark):
    """Nulls, empty and very long texts, no letters, repeated rows and clashing names; nothing learned; an empty table."""
    rows = [(1, "the cat and the dog", "en"), (1, "the cat and the dog", "en"), (2, None, "en"), (3, "", "de"), (4, "12 3,4", "de"), (None, "und der hund", "de"), (5, "le chat", None), (6, "der hund und die katze " * 100_000, "de")]
    docs = spark.createDataFrame([(*r, "p", "s", 1, 2) for r in rows], DOCS)
    got = language.identify(docs, language.fit(docs)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert [by[k] for k in (1, 2, 3, 4, None, 6)] == ["en", "und", "und", "und", "de", "de"] and by[5] in ("de", "en")
    nothing = language.fit(docs, F.lit(False))
    assert {(r["lang_pred"], r["score"]) for r in language.identify(docs, nothing).collect()} == {("und", 0.0)}
    assert language.identify(docs.limit(0), language.fit(docs.limit(0))).count() == 0
    again = language.fit(docs.repartition(5))
    assert (again[2] == language.fit(docs)[2]).all()
