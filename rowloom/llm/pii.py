"""Information-theoretic sanitisation of personal data.

Protected entities are the e-mail, network and card numbers and phone numbers that fixed patterns
find (the base spans). Words in the same document may give an entity away as well. How much a term t
tells about an entity e is their pointwise mutual information, estimated over all documents:

    PMI(e; t) = log(N * n(e, t) / (n(e) * n(t)))        IC(e) = log(N / n(e))

n(e) and n(t) count documents that hold e or t, n(e, t) those that hold both, the term outside of base
spans and at any distance. PMI / IC is the share of the entity's information that the term discloses, 1
when the term occurs with the entity alone. Terms at or above ``remove_at`` are removed, those at or above
``generalise_at`` are generalised to their shape, at every place where they stand in a document that holds
the entity. A pair needs ``support`` documents: a count of n has a relative error of about 1 / sqrt(n), and
in a single document every rare word would stand with the entity alone.

Counts are summed per slice before they are shuffled, keyed by (entity, term), by term or by entity, so a
frequent entity or term is one row per task. Only documents with an entity of ``support`` documents are
searched for terms. Nothing but the number of documents, and a bit table of bounded size, reaches the driver.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.sieve import bit_table, look_up
from rowloom.llm.words import ALNUM_LOWER, slices, small_batches, split_words
from rowloom.operators.keys import apart
from rowloom.session import materialize

KINDS = ["email", "ip", "card", "phone", "term"]
TERM = KINDS.index("term")
SUPPORT = 3
REMOVE_AT = 0.95
GENERALISE_AT = 0.8
PAIRS = 1 << 20  # pairs of a slice that are held before they are summed

# fixed patterns of the base spans; see base_spans for how they are searched in linear time
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

SPAN = "struct<kind:int,start:int,end:int>"
SCAN = f"struct<base:array<{SPAN}>,entities:array<bigint>>"
_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_SCAN = pa.struct([("base", pa.list_(_SPAN)), ("entities", pa.list_(pa.int64()))])


def _emails(text: str) -> list[tuple[int, int]]:
    found, floor = [], 0
    at = text.find("@")
    while at >= 0:
        left = at
        while left > floor and text[left - 1] in _LOCAL:
            left -= 1
        domain = _DOMAIN.match(text, at + 1) if left < at else None
        if domain:
            found.append((left, domain.end()))
        floor = domain.end() if domain else at + 1
        at = text.find("@", floor)
    return found


def _addresses(text: str) -> list[tuple[int, int]]:
    found = []
    for chain in _DOTTED.finditer(text):
        if chain[0].count(".") < 3:
            continue
        parts = [m for m in _PART.finditer(text, chain.start(), chain.end())]
        for i in range(0, len(parts) - 3, 4):
            if all(len(v := p[0].lstrip("0")) <= 3 and int(v or 0) <= 255 for p in parts[i : i + 4]):
                found.append((parts[i].start(), parts[i + 3].end()))
    return found


def _luhn(digits: str) -> bool:
    values = [int(c) for c in digits[::-1]]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of personal data, per kind leftmost and non-overlapping, in code points."""
    found = [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        found += [(1, a, b) for a, b in _addresses(text)]
        found += [(2, *m.span()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and _luhn(d)]
        if "+" in text:
            found += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def _entity(kind: int, value: str) -> int:
    value = _digits(value) if KINDS[kind] in ("card", "phone") else value.lower()
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "little", signed=True)


def _outside(text: str, spans: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms that lie in no span: hash, start and end in code points."""
    words = split_words(pa.array([text]), ALNUM_LOWER)
    start, end = words.start, words.end
    if not text.isascii():  # bytes to code points
        points = np.cumsum((words.data & 0xC0) != 0x80)
        start, end = points[start] - 1, points[end - 1]
    free = np.ones(len(start), bool)
    for s in spans:
        free[np.searchsorted(end, s["start"], side="right") : np.searchsorted(start, s["end"])] = False
    return words.hash.view(np.int64)[free], start[free], end[free]


def _scan(texts: pa.Array) -> pa.Array:
    out = []
    for text in texts.to_pylist():
        spans = base_spans(text) if text else []
        out.append({"base": [dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans], "entities": sorted({_entity(k, text[a:b]) for k, a, b in spans})})
    return pa.array(out, type=_SCAN)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    e, t = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((t, e))
    e, t = e[order], t[order]
    at = np.flatnonzero(np.concatenate([[True], (e[1:] != e[:-1]) | (t[1:] != t[:-1])])) if len(e) else np.zeros(0, np.int64)
    return pa.record_batch({"e": e[at], "t": t[at], "n": np.diff(np.append(at, len(e)))})


def _pairs(batches):
    """Rows (entity, term, documents with both) of documents given as text, base spans and entities."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for batch in batches:
        for at, to in slices(batch.column(0)):
            for row in batch.slice(at, to - at).to_pylist():
                term = np.unique(_outside(row["text"], row["base"])[0])
                for e in row["entities"]:
                    parts.append((np.full(len(term), e, np.int64), term))
                    held += len(term)
                    if held > PAIRS:
                        yield _summed(parts)
                        parts, held = [], 0
    if parts:
        yield _summed(parts)


def _marks(shared):
    """Occurrences of terms that, by a bit table of (entity xor term), perhaps disclose an entity of their document."""

    def run(batches):
        for batch in batches:
            for at, to in slices(batch.column(0)):
                for row in batch.slice(at, to - at).to_pylist():
                    term, start, end = _outside(row["text"], row["base"])
                    for e in row["entities"]:
                        hit = look_up(shared.value, term ^ np.int64(e))
                        if hit.any():
                            n = int(hit.sum())
                            yield pa.record_batch({"rid": np.full(n, row["rid"]), "e": np.full(n, e, np.int64), "t": term[hit], "start": start[hit].astype(np.int32), "end": end[hit].astype(np.int32)})

    return run


def _terms(batches):
    """Rows (term, documents with it), summed over a batch."""
    for batch in batches:
        texts = batch.column(0)
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for at, to in slices(texts):
            words = split_words(texts.slice(at, to - at), ALNUM_LOWER)
            # one row per document and term: distinct hashes of (term, document)
            order = np.lexsort((words.text, words.hash))
            term, text = words.hash[order], words.text[order]
            fresh = np.ones(len(term), bool)
            fresh[1:] = (term[1:] != term[:-1]) | (text[1:] != text[:-1])
            parts.append(np.unique(term[fresh], return_counts=True))
        term, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n = np.bincount(place, weights=np.concatenate([p[1] for p in parts]), minlength=len(term)).astype(np.int64)
        yield pa.record_batch({"t": term.view(np.int64), "n": n})


def find_private(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, support: int = SUPPORT,
    remove_at: float = REMOVE_AT, generalise_at: float = GENERALISE_AT,
) -> DataFrame:
    """``row`` (the columns ``keep``, all by default) with ``spans``, sorted by kind and start.

    A span has kind (a place in ``KINDS``), start, end (code points, exclusive) and, for terms,
    ``share``, the part of the entity's information it discloses, and ``drop``. Null texts are empty.
    Rows are told apart by a number of their own, so null or repeated ids do no harm.
    """
    small_batches(docs.sparkSession)
    chosen = docs.select(*[F.col(f"`{c}`") for c in keep]) if keep is not None else docs
    scanned = docs.select(F.struct(*[F.col(f"`{c}`") for c in chosen.columns]).alias("row"), F.col(f"`{text}`").alias("text"), F.arrow_udf(_scan, SCAN)(F.col(f"`{text}`")).alias("s"))
    held = F.when(F.size("s.entities") > 0, F.col("text")).alias("text")
    scanned = materialize(scanned.select(F.monotonically_increasing_id().alias("rid"), "row", held, "s.base", "s.entities"), "pii-scan")
    n_docs = scanned.count()
    named = scanned.filter(F.size("entities") > 0).select("rid", F.explode("entities").alias("e"))
    entities = materialize(named.groupBy("e").agg(F.count(F.lit(1)).alias("n_e")).filter(F.col("n_e") >= support), "entities")
    lists = named.join(entities, "e", "left_semi").groupBy("rid").agg(F.collect_list("e").alias("entities"))  # of one text
    texts = scanned.filter("text IS NOT NULL").select("rid", "text", "base").join(lists.select(apart("rid").alias("r"), "entities"), F.col("rid") == F.col("r"))
    texts = materialize(texts.select("text", "base", "entities", "rid"), "pii-texts")
    pairs = texts.mapInArrow(_pairs, "e bigint, t bigint, n bigint").groupBy("e", "t").agg(F.sum("n").alias("n_et")).filter(F.col("n_et") >= support)
    pairs = materialize(pairs, "pairs")
    # counted before the join, so that what is exchanged grows with the documents and not with the pairs
    terms = docs.select(F.col(f"`{text}`")).mapInArrow(_terms, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n_t"))
    told = F.log(F.lit(float(n_docs)) * F.col("n_et") / F.col("n_e") / F.col("n_t")) / F.log(F.lit(float(n_docs)) / F.col("n_e"))
    disclosing = pairs.join(entities, "e").join(terms, "t").select("e", "t", told.alias("share")).filter((F.col("share") >= generalise_at) & ~F.isnan("share"))
    disclosing = materialize(disclosing.withColumn("both", F.col("e").bitwiseXOR(F.col("t"))), "disclosing")
    marks = texts.mapInArrow(_marks(bit_table(disclosing, "both")), "rid bigint, e bigint, t bigint, start int, end int")
    added = marks.join(disclosing, ["e", "t"]).groupBy("rid", "start", "end").agg(F.max("share").alias("share"))
    spans = F.struct(F.lit(TERM).alias("kind"), "start", "end", "share", (F.col("share") >= remove_at).alias("drop"))
    added = added.groupBy("rid").agg(F.collect_list(spans).alias("added"))  # terms of one text
    base = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(None).cast("double").alias("share"), F.lit(False).alias("drop")))
    with_base = scanned.filter(F.size("base") > 0).join(added, "rid", "left")
    with_base = with_base.select("row", F.array_sort(F.concat(base, F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,end:int,share:double,drop:boolean>>")))).alias("spans"))
    return with_base.unionByName(scanned.filter(F.size("base") == 0).select("row", base.alias("spans")))


def _shape(word: str) -> str:
    kinds = ["9" if c.isdigit() else "X" if c.isupper() else "x" for c in word]
    return "[" + "".join(c for c, before in zip(kinds, ["", *kinds], strict=False) if c != before) + "]"


def _sanitise(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, found in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
        parts, at = [], 0
        for s in sorted(found or [], key=lambda s: (s["start"], -s["end"])):
            if s["end"] <= at:
                continue
            if s["start"] >= at:
                parts.append(text[at : s["start"]])
                word = text[s["start"] : s["end"]]
                parts.append(f"[{KINDS[s['kind']].upper()}]" if s["kind"] != TERM else "" if s["drop"] else _shape(word))
            at = s["end"]  # spans that overlap become one
        out.append("".join([*parts, text[at:]]) if parts else text)
    return pa.array(out, type=pa.string())


def sanitise(docs: DataFrame, text: str = "text", **thresholds) -> DataFrame:
    """Documents with personal data masked and disclosing terms removed or generalised; same columns.

    Documents without personal data keep their text, null included.
    """
    found = find_private(docs, text, None, **thresholds)
    clean = F.when(F.size("spans") == 0, F.col(f"row.`{text}`")).otherwise(F.arrow_udf(_sanitise, "string")(F.col(f"row.`{text}`"), F.col("spans")))
    cleaned = found.select("row", clean.alias("clean"))
    return cleaned.select(*[F.col("clean").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def of_kind(kind: int):
    return lambda s: s["kind"] == kind


def listed(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end``, comma-joined, of the given kinds."""
    names = F.array(*[F.lit(k) for k in KINDS])
    wanted = F.filter(spans, lambda s: F.array_contains(F.array(*[F.lit(KINDS.index(k)) for k in kinds]), s["kind"]))
    return F.array_join(F.transform(wanted, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
