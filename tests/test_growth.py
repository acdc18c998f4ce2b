"""Work that has to grow no faster than the input: how often a step is made, and over how many tasks it is spread."""

import re

import pytest

from sluice import registry
from sluice.llm import jaccard
from sluice.streaming import loader


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["failure_counts", "dead_letter", "reject_unknown_column", "reject_placeholder_mismatch", "reject_row_arity"])
def test_envelopes_are_decoded_once(spark, sf_dir, name):
    """A filter on the error does not take a copy of the decoded envelope and INSERT shape to each place that names them."""
    plan = plan_of(registry.QUERIES[name](spark, sf_dir))
    assert (plan.count("from_json"), plan.count("regexp_extract(")) == (1, 2)


def gathers(df):
    """Joins that bring a partition's messages together in one task."""
    return re.findall(r"SortMergeJoin(?:\(skew=true\))? \[zone#\d+, topic#\d+, part#\d+L\]", df._jdf.queryExecution().sparkPlan().toString())


def test_messages_stay_spread(spark, sf_dir):
    log = registry.log(spark, sf_dir)
    assert not gathers(registry.polls(spark, sf_dir)) and not gathers(registry.until_half(log)) and not gathers(registry.retained(log))
    assert not gathers(loader.sequenced(log, spark.createDataFrame([], loader.POSITIONS), False))


def test_one_component_meets_nowhere(spark, monkeypatch):
    """Shingles that only members of one component share are not joined; members of several components meet as before."""
    group = [(0, a, 50, True, 1, [*range(10), 100 + a]) for a in range(1, 21)]
    apart = [(0, 30, 50, True, 30, [900, 901, 902]), (0, 31, 50, True, 31, [900, 901, 903])]
    diffs = spark.createDataFrame(group + apart, "pivot long, a long, n_a long, far boolean, component long, diff array<long>")
    counts, staged = {}, jaccard.staged

    def counted(df, name):
        out = staged(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "staged", counted)
    met = jaccard.met_in_regions(diffs)
    assert {(r["a"], r["b"]) for r in met.collect()} == {(30, 31)}
    assert counts["jac-shared-diff"] == 4


def test_small_regions_join_what_could_meet(spark, monkeypatch):
    """Of regions with few members only those that could be linked with another are looked at by shingles; the same members meet."""
    rows = [(p, 10 * p + k, 50, True, 10 * p + k, [5, *range(1000 * p + 40 * k + 10, 1000 * p + 40 * k + 45)]) for p in range(20) for k in range(2)]
    rows += [(99, 1000 + k, 50, True, 1000 + k, [7, 8, 100 + k]) for k in range(2)]
    diffs = spark.createDataFrame(rows, "pivot long, a long, n_a long, far boolean, component long, diff array<long>")
    counts, staged = {}, jaccard.staged

    def counted(df, name):
        out = staged(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "staged", counted)
    met = jaccard.met_in_regions(diffs)
    assert {(r["a"], r["b"]) for r in met.collect()} == {(1000, 1001)}
    assert counts["jac-shared-diff"] < 44


def test_small_regions_are_compared_as_they_are(spark, monkeypatch):
    """Long texts that share much with one text, two of them linked: no shingle of a difference is looked up, and the links are those of the recursion."""
    rows = []
    for g in range(6):
        base = [f"g{g}w{j}" for j in range(400)]
        own = base[:300] + [f"g{g}x{j}" for j in range(100)]
        for k, words in enumerate((base, own, [*own[:-10], *(f"g{g}z{j}" for j in range(10))], base[:290] + [f"g{g}y{j}" for j in range(110)])):
            rows.append((10 * g + k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts, staged = {}, jaccard.staged

    def counted(df, name):
        out = staged(df, name)
        counts[name] = counts.get(name, 0) + out.count()
        return out

    def found(large):
        counts.clear()
        monkeypatch.setattr(jaccard, "LARGE", large)
        return {(r["doc_id"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()}

    monkeypatch.setattr(jaccard, "staged", counted)
    want = {(10 * g + k, 10 * g + (1 if k == 2 else k)) for g in range(6) for k in range(4)}
    assert found(jaccard.LARGE) == want
    assert counts["jac-shared-diff"] == 0 and 0 < counts["jac-met-small"] <= 6 * 6
    assert found(1) == want
    assert counts["jac-met-small"] == 0
    print("LOOKED UP", counts["jac-shared-diff"])


def test_python_workers_give_memory_back():
    """A task's end gives the memory that Python no longer uses back to the system; workers live on for later stages."""
    psutil = pytest.importorskip("psutil")
    own = lambda: psutil.Process().memory_info().rss

    def work(batches):
        for n in batches:
            many = [bytes(1000) for _ in range(n)]
            last.append(bytes(1000))  # stands behind them, so that the heap cannot shrink from its end
            yield len(many)

    from sluice.llm.common import lean

    last: list[bytes] = []
    before = own()
    assert list(lean(work)([100_000, 10])) == [100_000, 10]
    assert own() - before < 30e6
