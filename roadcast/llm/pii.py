r"""Operator 7: personal data by patterns and information-theoretic sanitisation.

Base spans are what the four patterns find (email, ip, card, phone).  Beyond
them, a term that stands near a protected value may give it away even when the
value itself is masked.  The corpus tells how much: with N documents, c(e) of
them holding value e, c(t) holding term t and c(t, e) holding t near e,

    PMI(t, e) / IC(e) = 1 - log(c(t) / c(t, e)) / log(N / c(e))

is the share of the value's information that the term carries (1: the term
occurs only with it).  Terms above ``remove`` are removed, above
``generalise`` replaced by their kind, wherever they occur in the documents
that hold that value.

A pair must also be unlikely to be chance.  Of the m different contexts of a
value, k hold the term (copies of one document are one context); a term that
stands anywhere with the rate p = c(t) / N does so with at most
exp(-m KL(k/m || p)), which is p for one context of one.  Times the number of
terms tried for the value, this must not exceed ``chance``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_filter, in_filter, keep_probable, row_key, save

KINDS = ("email", "ip", "card", "phone")
#: The patterns asked for.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Fixed pattern; a match never begins or stops inside a run of digits, so only the beginnings of runs are tried.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")
_TERM = re.compile(r"[^\W\d_]+")
WINDOW = 6


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    """Leftmost non-overlapping matches of EMAIL: each starts a run of local
    characters right before an ``@``, so only those places are tried."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m
            end = m.end()
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in code points, by start, then kind."""
    out = [(m.start(), 0, m.end()) for m in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(_small(p) for p in m.group().split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                    if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def term_hash(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term.lower().encode()) - (1 << 63)


def value_hash(text: str, span: tuple[int, int, int]) -> int:
    start, kind, end = span
    return xxhash.xxh3_64_intdigest(f"{KINDS[kind]}:{text[start:end].lower()}".encode()) - (1 << 63)


def mentions(text: str, spans: list[tuple[int, int, int]], window: int = WINDOW):
    """(value, context, term, start, end) for the terms near each base span."""
    out = []
    for start, kind, end in spans:
        value = value_hash(text, (start, kind, end))
        near, reach = [], 40 * window
        left = [m for m in _TERM.finditer(text, max(0, start - reach), start)][-window:]
        right = []
        for m in _TERM.finditer(text, end, min(len(text), end + reach)):
            right.append(m)
            if len(right) == window:
                break
        for m in [*left, *right]:
            if not any(s < m.end() and m.start() < e for s, _, e in spans):
                near.append((m.group().lower(), m.start(), m.end()))
        context = xxhash.xxh3_64_intdigest("\0".join(t for t, _, _ in near).encode()) - (1 << 63)
        out += [(value, context, t, s, e) for t, s, e in near]
    return out


_SPAN = "array<struct<start:int,kind:string,end:int>>"
_NEAR = "array<struct<value:long,context:long,term:long,start:int,end:int>>"


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_sql = rows.schema["id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
    near = pa.list_(pa.struct([("value", pa.int64()), ("context", pa.int64()), ("term", pa.int64()),
                               ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            counts, sha, base, held, terms = [[] for _ in KINDS], [], [], [], []
            for t in b.column(3):
                text = t.as_py()
                found = base_spans(text)
                for k in range(len(KINDS)):
                    counts[k].append(sum(f[1] == k for f in found))
                sha.append(hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found).encode()).hexdigest())
                base.append([{"start": s, "kind": KINDS[k], "end": e} for s, k, e in found])
                held.append(list({value_hash(text, f) for f in found}))
                terms.append([{"value": v, "context": c, "term": term_hash(w), "start": s, "end": e}
                              for v, c, w, s, e in mentions(text, found)] if found else [])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], *[pa.array(c, pa.int64()) for c in counts], pa.array(sha, pa.string()),
                 pa.array(base, span), pa.array(held, pa.list_(pa.int64())), pa.array(terms, near)],
                ["id", "k1", "k2", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "held", "near"])

    return rows.mapInArrow(run, f"id {id_sql}, k1 long, k2 long, " + "".join(f"n_{k} long, " for k in KINDS)
                           + f"base_sha256 string, base {_SPAN}, held array<long>, near {_NEAR}")


def _term_counts(docs: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """Documents that hold each of ``terms`` (and a superset of them), over all texts."""
    bitmap = bounded_filter(terms, "term")
    if not bitmap.any():
        return terms.select("term", F.lit(0).cast("long").alias("docs")).limit(0)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        for b in batches:
            tally: dict[int, int] = {}
            known: dict[str, int | None] = {}
            for t in b.column(0):
                words = set(_TERM.findall(t.as_py() or ""))
                new = [w for w in words if w not in known]
                if new:
                    h = np.array([term_hash(w) for w in new], dtype=np.int64)
                    known.update(zip(new, (x if ok else None for x, ok in zip(h.tolist(), in_filter(shared.value, h.view(np.uint64)).tolist()))))
                for h in {known[w] for w in words}:
                    if h is not None:
                        tally[h] = tally.get(h, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(tally), pa.int64()), pa.array(list(tally.values()), pa.int64())],
                                             ["term", "docs"])

    return (docs.select(text_col).mapInArrow(run, "term long, docs long")
            .groupBy("term").agg(F.sum("docs").alias("docs")))


def disclosures(docs: DataFrame, near: DataFrame, holds: DataFrame, text_col: str = "text", chance: float = 0.05,
                generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """(value, term, share, action) of the terms above the disclosure thresholds.

    ``near``: k1, k2, value, context, term -- one row per term standing near a
    protected value; ``holds``: k1, k2, value of each document.  Counts are over
    all documents.
    """
    both = (near.select("k1", "k2", "value", "term").distinct()
            .groupBy("value", "term").agg(F.count(F.lit(1)).alias("both")))
    contexts = (near.select("value", "term", "context").distinct()
                .groupBy("value", "term").agg(F.count(F.lit(1)).alias("contexts")))
    tried = (near.select("value", "context").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("of"))
             .join(contexts.groupBy("value").agg(F.count(F.lit(1)).alias("terms")), "value"))
    held = holds.groupBy("value").agg(F.count(F.lit(1)).alias("held"))
    pairs = save(contexts.join(both, ["value", "term"]).join(tried, "value").join(held, "value"), "pii-pairs")
    total = float(docs.count())
    counts = _term_counts(docs, text_col, pairs.select("term").distinct())
    share = 1 - F.log(F.greatest(F.col("docs") / F.col("both"), F.lit(1.0))) / F.log(F.lit(total) / F.col("held"))
    q, p = F.col("contexts") / F.col("of"), F.col("docs") / F.lit(total)
    rest = F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - p))).otherwise(0.0)
    by_chance = F.when(q <= p, 1.0).otherwise(F.exp(-F.col("of") * (q * F.log(q / p) + rest)))
    return (pairs.join(counts, "term").where(F.col("held") < total)
            .withColumn("share", share).where((F.col("share") >= generalise) & (by_chance * F.col("terms") <= chance))
            .select("value", "term", "share",
                    F.when(F.col("share") >= remove, "remove").otherwise("generalise").alias("action")))


def _occurrences(docs: DataFrame, id_col: str, text_col: str, holds: DataFrame, told: DataFrame) -> DataFrame:
    """(k1, k2, more): all places of told terms in the documents that hold their value."""
    asked = save(holds.join(told, "value").groupBy("k1", "k2", "term").agg(F.max(F.col("action") == "remove").alias("remove"))
                 .groupBy("k1", "k2").agg(F.collect_list(F.struct("term", "remove")).alias("terms")), "pii-asked")
    rows = docs.select(*row_key(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    some = keep_probable(rows, "k1", bounded_filter(asked, "k1")).join(asked, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            out = []
            for text, terms in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                kind = {t["term"]: "term" if t["remove"] else "hint" for t in terms}
                spans = base_spans(text)
                found = ((m, kind.get(term_hash(m.group()))) for m in _TERM.finditer(text))
                out.append([{"start": m.start(), "kind": k, "end": m.end()} for m, k in found
                            if k and not any(s < m.end() and m.start() < e for s, _, e in spans)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, span)], ["k1", "k2", "more"])

    return some.select("k1", "k2", "text", "terms").mapInArrow(run, f"k1 long, k2 long, more {_SPAN}")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chance: float = 0.05,
             generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """Row per input row: id, n_email, n_ip, n_card, n_phone, base_sha256, spans
    (``kind:start:end`` joined by commas) and ``found`` (the same as an array).

    Kinds beyond the base: ``term`` (removed) and ``hint`` (generalised).  Null
    and empty texts have no spans; null ids and repeated rows are rows like any
    other; an empty table gives an empty result.
    """
    scanned = save(_scan(docs, id_col, text_col), "pii-scan")
    near = scanned.where(F.size("near") > 0).select("k1", "k2", F.explode("near").alias("m")).select("k1", "k2", "m.*")
    holds = scanned.select("k1", "k2", F.explode("held").alias("value")).distinct()
    told = save(disclosures(docs, near, holds, text_col, chance, generalise, remove), "pii-told")
    added = _occurrences(docs, id_col, text_col, holds, told)
    order = F.create_map(*[x for i, k in enumerate((*KINDS, "term", "hint")) for x in (F.lit(k), F.lit(i))])
    every = F.array_sort(F.transform(F.concat("base", F.coalesce(F.col("more"), F.array().cast(_SPAN))),
                                     lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("no"),
                                                        s["kind"].alias("kind"), s["end"].alias("end"))))
    joined = scanned.join(added, ["k1", "k2"], "left")
    return (joined.withColumn("found", every)
            .select(F.col("id").alias(id_col), *[f"n_{k}" for k in KINDS], "base_sha256",
                    F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
                    F.transform("found", lambda s: F.struct(s["start"], s["kind"], s["end"])).alias("found")))


def sanitise(text: str | None, found: list) -> str | None:
    """``text`` with base spans and hints replaced by their kind and terms removed."""
    if text is None:
        return None
    out, at = [], 0
    for start, kind, end in ((s[0], s[1], s[2]) for s in found):
        if end <= at:
            continue
        out.append(text[at:max(at, start)])
        if kind != "term":
            out.append(f"[{'TERM' if kind == 'hint' else kind.upper()}]")
        at = end
    return "".join(out) + text[at:]
