"""PII: base patterns, then information-theoretic sanitisation.

The values that the patterns find are the protected entities. Over all documents the corpus gives, for an entity c and
a term t, the pointwise mutual information ln(N n(c,t) / (n(c) n(t))), where all three n count document rows: those that hold
c, those that hold t outside the entities, and those that hold both, however far apart. A term that reaches GENERALISE of
the information ln(N / n(c)) of some entity is generalised, one that reaches REMOVE is removed, at every place in every
document, whether the entity is written there or not. Counts under SUPPORT rows say nothing reliable and disclose nothing.

Edge cases: a null text is empty and gives no spans; rows with null or repeated ids each give one row, and repeated
rows count as often as they stand there; an empty table gives an empty result; ties (equal information) are treated alike;
only doc_id and text are read, and `sanitise` carries all other columns, of any names, in one struct. There is no
taxonomy to generalise by: a generalised term becomes [TERM] where it stands, a removed one leaves nothing. Texts of any length are read whole, in linear time.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, table, whole_text

KINDS = ("email", "ip", "card", "phone")
SUPPORT, GENERALISE, REMOVE = 3, 0.6, 0.85
#: Terms, or pairs with an entity, that a task counts before it passes them on.
FLUSH = 400_000

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does; without saying so, a long run would be read from each of its digits.
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TERM = re.compile(r"[^\W\d_]{3,}")
LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches found from each @ sign, so that long runs without one cost nothing."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL_SET:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        else:
            last = at + 1
        at = text.find("@", last)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), by kind as listed, then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return out
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind == 'email' else '.'.join(value.split('.')) if kind == 'ip' else ''.join(DIGIT.findall(value))}"


def outside(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, int, str]]:
    """(start, end, term) of the terms that no span touches."""
    inside = sorted((a, b) for _, a, b in spans)
    reach = list(accumulate((b for _, b in inside), max))
    for m in TERM.finditer(text):
        k = bisect_left(reach, m.start() + 1)
        if k == len(inside) or inside[k][0] >= m.end():
            yield m.start(), m.end(), m[0].lower()


def distinct_terms(text: str) -> set[str]:
    spans = base_spans(text)
    return {t for _, _, t in outside(text, spans)} if spans else {t.lower() for t in set(TERM.findall(text))}


def counted(found: Iterator[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    """How often each tuple comes, in parts of at most FLUSH."""
    seen: Counter = Counter()
    for x in found:
        seen[x] += 1
        if len(seen) >= FLUSH:
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=[*names, "n"])
            seen.clear()
    if seen:
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=[*names, "n"])


def entities_of(texts: pd.Series) -> pd.Series:
    return pd.Series([sorted({entity(k, t[a:b]) for k, a, b in base_spans(t)}) for t in texts], dtype=object)


def terms_of(texts: pd.Series) -> pd.Series:
    return pd.Series([list(distinct_terms(t)) for t in texts], dtype=object)


SCAN = "n_email long, n_ip long, n_card long, n_phone long, base string, added array<string>"


def scan_text(texts: pd.Series, told: pd.Series) -> pd.DataFrame:
    """Base spans, and the places (start:end:action) of the terms told as action:term."""
    spans = [base_spans(t) for t in texts]
    counts = [Counter(k for k, _, _ in s) for s in spans]
    added = []
    for text, found, terms in zip(texts, spans, told, strict=True):
        action = {t: a for a, t in (x.split(":", 1) for x in terms)} if terms is not None else {}
        added.append(sorted(f"{s}:{e}:{action[t]}" for s, e, t in outside(text, found) if t in action) if action else [])
    return pd.DataFrame({f"n_{k}": [c[k] for c in counts] for k in KINDS} | {"base": [joined(s) for s in spans], "added": added})


def rows_of(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).withColumn("text_hash", F.xxhash64("text"))


def with_key(rows: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """rows with the list that stands in `lists` for their id and text; each row stays one."""
    lists = lists.withColumnsRenamed({"doc_id": "l_id", "text_hash": "l_hash"})
    return rows.join(lists, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("text_hash") == F.col("l_hash")), how).drop("l_id", "l_hash")


def document_frequencies(rows: DataFrame) -> DataFrame:
    """(term, n_t) over all document rows; each task adds up what it sees before the shuffle."""

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return counted(((x,) for b in batches for t in b.text for x in distinct_terms(t)), ["term"])

    return rows.select("text").mapInPandas(one, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_t"))


def co_occurrences(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """(entity, term, n_ct) over the rows that hold an entity of `hosts`; tasks add up pairs first, so a frequent entity is no hot key."""

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return counted(((c, t) for b in batches for text, held in zip(b.text, b.entities, strict=True) for terms in [distinct_terms(text)] for c in held for t in terms), ["entity", "term"])

    held = with_key(rows, hosts, "inner").select("text", "entities")
    return held.mapInPandas(one, "entity string, term string, n long").groupBy("entity", "term").agg(F.sum("n").alias("n_ct"))


def disclosures(rows: DataFrame, total: int) -> DataFrame:
    """(entity, term, information share, action) for the terms that say too much of an entity."""
    held = staged(rows.select("doc_id", "text_hash", F.explode(F.pandas_udf(entities_of, "array<string>")("text")).alias("entity")), "pii-entities")
    # An entity of fewer rows than SUPPORT cannot share that many with a term.
    entities = staged(held.groupBy("entity").agg(F.count("*").alias("n_c")).where((F.col("n_c") >= SUPPORT) & (F.col("n_c") < total)), "pii-frequent")
    hosts = staged(held.join(entities, "entity").groupBy("doc_id", "text_hash").agg(F.collect_set("entity").alias("entities")), "pii-hosts")
    share = F.log(F.lit(float(total)) * F.col("n_ct") / (F.col("n_c") * F.col("n_t"))) / F.log(F.lit(float(total)) / F.col("n_c"))
    return (
        co_occurrences(rows, hosts)
        .where(F.col("n_ct") >= SUPPORT)
        .join(entities, "entity")
        .join(document_frequencies(rows), "term")
        .withColumn("share", share)
        .where(F.col("share") >= GENERALISE)
        .select("entity", "term", "share", F.when(F.col("share") >= REMOVE, "remove").otherwise("generalise").alias("action"))
    )


def find(documents: DataFrame) -> DataFrame:
    """One row for each row of documents: doc_id, text_hash, counts, base, added (an array of start:end:action)."""
    rows = rows_of(documents)
    told = disclosures(rows, rows.count()).groupBy("term").agg(F.max("action").alias("action"))  # "remove" goes before "generalise"
    told = staged(told, "pii-told")
    hits = rows.select("doc_id", "text_hash", F.explode(F.pandas_udf(terms_of, "array<string>")("text")).alias("term")).join(told, "term")
    hits = staged(hits.groupBy("doc_id", "text_hash").agg(F.collect_set(F.concat_ws(":", "action", "term")).alias("told")), "pii-hits")
    return with_key(rows, hits, "left").select("doc_id", "text_hash", F.pandas_udf(scan_text, SCAN)("text", "told").alias("r")).select("doc_id", "text_hash", "r.*")


def term_spans(added: str = "added") -> F.Column:
    """The added places as term:start:end, by start; a place that is both generalised and removed counts once."""
    pairs = F.transform(F.col(added), lambda x: F.struct(F.split(x, ":")[0].cast("int").alias("s"), F.split(x, ":")[1].cast("int").alias("e")))
    return F.transform(F.array_sort(F.array_distinct(pairs)), lambda p: F.concat_ws(":", F.lit("term"), p["s"].cast("string"), p["e"].cast("string")))


def redact(text: str, base: str, added: list[str]) -> str:
    """Entities become [KIND], generalised terms [TERM], removed terms nothing."""
    cuts = []
    for x in filter(None, base.split(",")):
        k, a, b = x.split(":")
        cuts.append((int(a), int(b), f"[{k.upper()}]"))
    gone = {tuple(x.split(":")[:2]) for x in added if x.endswith("remove")}
    for x in added:
        a, b, action = x.split(":")
        if action == "remove" or (a, b) not in gone:
            cuts.append((int(a), int(b), "" if action == "remove" else "[TERM]"))
    out, at = [], 0
    for a, b, s in sorted(cuts):
        if a >= at:
            out += [text[at:a], s]
            at = b
        else:
            at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(documents: DataFrame) -> DataFrame:
    """documents with `text` sanitised; all other columns stay."""
    found = find(documents).dropDuplicates(["doc_id", "text_hash"]).select(F.col("doc_id").alias("f_id"), F.col("text_hash").alias("f_hash"), "base", "added").where((F.col("base") != "") | (F.size("added") > 0))

    @F.pandas_udf("string")
    def clean(text: pd.Series, base: pd.Series, added: pd.Series) -> pd.Series:
        return pd.Series([t if b is None else redact(t, b, list(a)) for t, b, a in zip(text, base, added, strict=True)])

    rows = documents.select(F.struct("*").alias("row"), whole_text().alias("whole"))
    rows = rows.join(found, F.col("row.doc_id").eqNullSafe(F.col("f_id")) & (F.xxhash64("whole") == F.col("f_hash")), "left")
    cleaned = F.when(F.col("base").isNull(), F.col("row.text")).otherwise(clean("whole", "base", "added"))
    return rows.select(*[cleaned.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in documents.columns])


def op4_pii(spark, sf_dir: str) -> DataFrame:
    """The contract's columns, and `actions`: start:end:action of each term span."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.when(F.col("base") == "", F.array().cast("array<string>")).otherwise(F.split("base", ","))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), F.array_join(F.concat(base, term_spans()), ",").alias("spans"), F.array_join("added", ",").alias("actions"))
