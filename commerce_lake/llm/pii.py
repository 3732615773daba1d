"""Personal data in texts: patterns, and terms that give away a protected entity.

Patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers. Their values are
the protected entities. The corpus tells how strongly a term reveals one: the pointwise mutual
information of term and entity over the documents, as a share of the information content of the
entity. Joint counts are of whole documents, for each value and for the group it belongs to (the
e-mail domain, the IP network, the card issuer, the phone prefix), which judges values of one
text too. Terms that exceed the thresholds are generalised or removed in the documents of the entity.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.common import SLICE_ROWS, slices, stored, text_or_empty

KINDS = ("email", "ip", "card", "phone", "term")
MIN_SUPPORT = 3
GENERALISE = 0.8
REMOVE = 0.95

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: from each @ with a domain behind it back over the local part."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(d - 9 * (d > 9) for d in doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def find_base(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of each base match, by start and kind."""
    out = [(a, 0, b, text[a:b].lower()) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in m[0].split("."))):
                out.append((m.start(), 1, m.end(), m[0]))
        for m in _CARD.finditer(text):
            digits = _digits(m[0]) if m.end() - m.start() >= 12 else ""
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end(), digits))
        if "+" in text:
            for m in _PHONE.finditer(text):
                digits = _digits(m[0])
                if 9 <= len(digits) <= 15:
                    out.append((m.start(), 3, m.end(), digits))
    return sorted(out)


def _term(word: str) -> str:
    """The lower-case word without punctuation around it; empty if nothing is left or it is an address."""
    term = word.strip(_PUNCTUATION).lower()
    return "" if "@" in term else term


def _signed(value: str) -> int:
    n = xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"))
    return n - (1 << 64) if n >> 63 else n


def _entities(base: list[tuple[int, int, int, str]]) -> list[int]:
    """The distinct values of the matches, and their groups."""
    group = (lambda v: v.rpartition("@")[2], lambda v: v.rpartition(".")[0], lambda v: v[:6], lambda v: v[:4])
    names = {f"{KINDS[k]}|{v}" for _, k, _, v in base} | {f"{KINDS[k]} group|{group[k](v)}" for _, k, _, v in base}
    return sorted(_signed(n) for n in names)


def _occurrences(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int]]:
    """(term, start, end) of each term outside the matches."""
    words = [m.span() for m in _WORD.finditer(text)]
    ends = [b for _, b in words]
    starts = [a for a, _ in words]
    inside = set()
    for a, _, b, _ in base:
        inside.update(range(bisect_left(ends, a + 1), bisect_left(starts, b)))
    out = []
    for k, (a, b) in enumerate(words):
        word = text[a:b]
        if k not in inside and (term := _term(word)):
            at = a + len(word) - len(word.lstrip(_PUNCTUATION))
            out.append((_signed(term), at, at + len(word.strip(_PUNCTUATION))))
    return out


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_FOUND = (
    "id long, hash long, base array<struct<start:int,kind:int,end:int>>, "
    "entities array<long>, terms array<long>, starts array<int>, ends array<int>"
)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        bases, entities, places = [], [], []
        for text in batch.column(2).to_pylist():
            base = find_base(text)
            bases.append([{"start": a, "kind": k, "end": b} for a, k, b, _ in base])
            entities.append(_entities(base))
            places.append(_occurrences(text, base) if base else [])
        part = lambda k, kind: pa.array([[p[k] for p in x] for x in places], pa.list_(kind))  # noqa: B023, E731
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array(bases, pa.list_(_SPAN)), pa.array(entities, pa.list_(pa.int64())),
                part(0, pa.int64()), part(1, pa.int32()), part(2, pa.int32()),
            ],
            ["id", "hash", "base", "entities", "terms", "starts", "ends"],
        )


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term, counted per slice of the input."""
    for batch in slices(batches, 4 * SLICE_ROWS):
        words: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            words.update({_term(w) for w in set(_WORD.findall(text))})
        terms = [t for t in words if t]
        yield pa.RecordBatch.from_arrays(
            [pa.array([_signed(t) for t in terms], pa.int64()), pa.array([words[t] for t in terms], pa.int64())], ["term", "n"]
        )


def found_in(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A stored row for each row of `df`: id, hash of the text, base matches, entities and the places of terms."""
    text = text_or_empty(text_col)
    return stored(df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text")).mapInArrow(_find, _FOUND), "pii_found")


def disclosing_terms(
    df: DataFrame, found: DataFrame, text_col: str, support: int = MIN_SUPPORT, threshold: float = GENERALISE
) -> DataFrame:
    """entity, term, disclosure: the terms that reveal an entity, by counts over all documents.

    Disclosure is log(N n(e,t) / n(e) n(t)) / log(N / n(e)), at most 1; n counts documents. A pair
    must stand together in `support` different texts, or in all of the entity's where it has fewer,
    and in two at least, so that copies alone are no evidence.
    """
    docs = found.where(F.size("entities") > 0).dropDuplicates(["id", "hash"]).withColumn("doc", F.xxhash64("id", "hash"))
    entities = docs.select("doc", "hash", F.explode("entities").alias("entity"))
    counts = entities.groupBy("entity").agg(F.count("*").alias("n_entity"), F.count_distinct("hash").alias("n_texts")).where("n_texts > 1")
    held = entities.join(counts, "entity")
    terms = docs.select("doc", "hash", F.explode(F.array_distinct("terms")).alias("term"))
    shared = terms.groupBy("term").agg(F.min("hash").alias("a"), F.max("hash").alias("b")).where("a < b").select("term")
    words = df.select(text_or_empty(text_col).alias("text")).mapInArrow(_term_counts, "term long, n long")
    n_term = stored(words.join(shared, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n_term")), "pii_terms")
    total = F.lit(float(max(found.count(), 1)))
    content = F.log(total / F.col("n_entity"))
    # n(e,t) is n(e) and n(t) at most: pairs whose counts cannot reach the threshold are not made
    most = F.log(total * F.least("n_entity", "n_term") / (F.col("n_entity") * F.col("n_term")))
    can = (content > 0) & (most >= F.lit(threshold - 1e-9) * content)
    both = held.join(terms.join(n_term, "term").drop("hash"), "doc").where(can)
    key = ["entity", "term", "n_entity", "n_term", "n_texts"]
    pairs = both.groupBy(*key, "hash").agg(F.count("*").alias("docs")).groupBy(*key).agg(F.sum("docs").alias("joint"), F.count("*").alias("texts"))
    known = pairs.where(F.col("texts") >= F.least(F.lit(support), F.greatest(F.lit(2), F.col("n_texts"))))
    shown = F.log(total * F.col("joint") / (F.col("n_entity") * F.col("n_term"))) / content
    return stored(known.select("entity", "term", shown.alias("disclosure")).where(F.col("disclosure") >= threshold), "pii_pairs")


def _term_spans(found: DataFrame, terms: DataFrame) -> DataFrame:
    """id, hash, terms: for each text the places of terms that reveal an entity in it."""
    docs = found.where(F.size("entities") > 0).dropDuplicates(["id", "hash"])
    key = F.xxhash64("id", "hash").alias("doc")
    told = docs.select(key, F.explode("entities").alias("entity")).join(terms, "entity")
    told = told.groupBy("doc", "term").agg(F.max("disclosure").alias("disclosure"))
    places = docs.select("id", "hash", key, F.explode(F.arrays_zip("terms", "starts", "ends")).alias("c"))
    places = places.select("id", "hash", "doc", F.col("c.terms").alias("term"), F.col("c.starts").alias("start"), F.col("c.ends").alias("end"))
    hit = places.join(told, ["doc", "term"])
    return hit.groupBy("id", "hash").agg(F.collect_list(F.struct("start", "end", "disclosure")).alias("terms"))


def _joined(spans: Column) -> Column:
    """kind:start:end of each span, by start and kind."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _with_terms(rows: DataFrame, id_: Column, hash_: Column, terms: DataFrame) -> DataFrame:
    named = terms.select(F.col("id").alias("_id"), F.col("hash").alias("_hash"), F.col("terms").alias("_terms"))
    return rows.join(named, id_.eqNullSafe(named["_id"]) & (hash_ == named["_hash"]), "left")


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_term for each row of `df`.

    Places are in code points, ends exclusive. A missing text counts as empty: no spans. Repeated
    rows give repeated results.
    """
    found = found_in(df, id_col, text_col)
    terms = _term_spans(found, disclosing_terms(df, found, text_col, **limits))
    rows = _with_terms(found.select("id", "hash", "base"), F.col("id"), F.col("hash"), terms)
    extra = F.coalesce(
        F.transform("_terms", lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("term")).alias("kind"), t["end"].alias("end"))),
        F.array().cast("array<struct<start:int,kind:int,end:int>>"),
    )
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return rows.select(
        F.col("id").alias(id_col),
        *(count(k) for k in range(4)),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", extra)).alias("spans"),
        F.size(extra).cast("long").alias("n_term"),
    )


def _mask(text: str, terms: list[dict] | None) -> str:
    """The text with base matches and terms replaced; of overlapping places the first, then the longer."""
    places = [(a, -b, f"<{KINDS[k].upper()}>") for a, k, b, _ in find_base(text)]
    places += [(t["start"], -t["end"], "" if t["disclosure"] >= REMOVE else "<TERM>") for t in terms or ()]
    out, at = [], 0
    for start, end, tag in sorted(places):
        if start >= at:
            out += [text[at:start], tag]
            at = -end
        elif -end > at:
            at = -end
    return "".join([*out, text[at:]])


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """`df` with personal data in its texts replaced by the kind, and telling terms generalised or removed.

    Missing texts stay missing. All other columns stay as they are.
    """
    found = found_in(df, id_col, text_col)
    terms = _term_spans(found, disclosing_terms(df, found, text_col, **limits))
    rows = _with_terms(df, F.col(id_col), F.xxhash64(text_or_empty(text_col)), terms)

    @F.arrow_udf("string")
    def masked(text: pa.Array, terms: pa.Array) -> pa.Array:
        return pa.array([None if t is None else _mask(t, x) for t, x in zip(text.to_pylist(), terms.to_pylist())], pa.string())

    return rows.withColumn(text_col, masked(F.col(text_col), F.col("_terms"))).select(df.columns)
