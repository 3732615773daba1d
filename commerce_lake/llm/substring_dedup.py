"""Removal of long repeated substrings, judged on run-compressed suffix indexes.

A string of LENGTH bytes is known by its anchor: the smallest hash of the GRAM-byte strings in it.
Equal strings have equal anchors, so strings that could be equal meet under one key. Neighbouring
strings with one anchor form a segment. Segments that are equal as a whole leave only the first one;
anchors under which different segments remain go, with their text, to blocks of bounded size.

A block concatenates its segments in document order and builds the Burrows-Wheeler transform. Of it
only runs are kept, with the suffix positions sampled at their ends. Along the text the samples
give every position its match: the suffix next to it in sorted order and how long both agree. The
matches of LENGTH bytes or more chain equal strings together, and all but the first are removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.llm.common import slices, stored, text_or_empty

LENGTH = 100
GRAM = 32
LONGEST_SEGMENT = 128
CHUNK_BYTES = 1 << 18
BLOCK_BYTES = 1 << 19
SEGMENT_ROWS = 2048
TEXT_ROWS = 64
ROW_BYTES = 500  # about what Python needs for a row on its way to a block
HELD_BYTES = 1 << 24
HOT_ANCHOR = 4096  # different segments of an anchor, beyond which their strings go on one by one
_SEPARATOR, _END = b"\xff", b"\xfe"  # bytes that UTF-8 does not have
_U = np.uint64
_TABLE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACES = _U(127)  # more than the grams of one string
_PERIODIC = 1 << 20  # added to the count of a segment that may repeat a string itself


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the public finaliser of a multiplicative hash)."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _doubled(x: np.ndarray, size: int, join) -> np.ndarray:
    """`join` of `size` neighbouring values at each position, by doubling; ranges may overlap."""
    have = 1
    while 2 * have <= size:
        x = join(x[:-have], x[have:], have)
        have *= 2
    if have < size:
        x = join(x[: len(x) - (size - have)], x[size - have :], size - have)
    return x


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each string of LENGTH bytes in `data`, and whether it stands in it twice.

    The low bits of a gram's hash give way to its place, rising in one scan and falling in the
    other; both scans find the same place if the anchor stands there once.
    """
    grams = _mix(_doubled(_TABLE[data], GRAM, lambda a, b, n: a * _U(pow(_BASE, n, 1 << 64)) + b))
    width, least = LENGTH - GRAM + 1, lambda a, b, n: np.minimum(a, b)
    place = np.arange(len(grams), dtype=np.uint64) & _PLACES
    up = _doubled(grams & ~_PLACES | place, width, least)
    down = _doubled(grams & ~_PLACES | (_PLACES - place), width, least)
    return up & ~_PLACES, (up & _PLACES) != (_PLACES - (down & _PLACES))


def _segments_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, start, count, anchor, content hash) of the segments, a chunk at a time."""
    chunk: list[tuple[int, int, bytes]] = []
    size = 0

    def flush() -> tuple[np.ndarray, ...]:
        data = np.frombuffer(b"".join(p for _, _, p in chunk), np.uint8)
        sizes = np.array([len(p) for _, _, p in chunk])
        offsets = np.cumsum(sizes) - sizes
        anchor, twice = anchors(data)
        # strings inside one piece only
        counts = sizes - LENGTH + 1
        piece = np.repeat(np.arange(len(chunk)), counts)
        nth = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = offsets[piece] + nth
        anchor, twice = anchor[at], twice[at]
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
        # long runs, of periodic text, are cut
        first = np.flatnonzero(new)
        run = np.diff(np.append(first, len(at)))
        parts = -(-run // LONGEST_SEGMENT)
        first = np.repeat(first, parts) + LONGEST_SEGMENT * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        count = np.diff(np.append(first, len(at)))
        start, end = at[first], at[first] + count + LENGTH - 1
        upto = np.concatenate([[_U(0)], np.cumsum(_TABLE[data] * _powers(_BASE, len(data)), dtype=np.uint64)])
        content = (upto[end] - upto[start]) * _powers(pow(_BASE, -1, 1 << 64), len(data))[start]
        content = _mix(content + count.astype(np.uint64) * _U(_BASE))
        periodic = np.logical_or.reduceat(twice, first) | (count > LENGTH - GRAM + 1)
        owner = np.array([k for k, _, _ in chunk])[piece[first]]
        base = np.array([a for _, a, _ in chunk])[piece[first]]
        return owner, base + nth[first], count + _PERIODIC * periodic, anchor[first], content

    for k, text in enumerate(texts):
        for a in range(0, len(text) - LENGTH + 1, CHUNK_BYTES):
            part = text[a : a + CHUNK_BYTES + LENGTH - 1]
            chunk.append((k, a, part))
            size += len(part)
            if size >= CHUNK_BYTES:
                yield flush()
                chunk, size = [], 0
    if chunk:
        yield flush()


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Touching intervals of a document made one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    wide = int(end.max()) + 1
    reach = np.maximum.accumulate(doc * wide + end)
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] * wide + start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return doc[first], start[first], reach[np.append(first[1:], len(doc)) - 1] - doc[first] * wide


_SEG = "key long, content long, id long, tie long, start long, count long"
_SEG_NAMES = [x.split()[0] for x in _SEG.split(", ")]
_OUT = "kind int, id long, tie long, start long, count long, anchor long, members long"
_OUT_NAMES = [x.split()[0] for x in _OUT.split(", ")]


def _batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of the documents. Of those equal within a batch only the first goes on; the others
    are removed already, and travel as intervals with a negative count under a key of their own."""
    for batch in slices(batches, SEGMENT_ROWS):
        ids, ties = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("id", "tie"))
        found = list(_segments_of(batch.column("text").to_pylist()))
        if not found:
            continue
        doc, start, count, anchor, content = (np.concatenate(c) for c in zip(*found))
        key, content = anchor.view(np.int64), content.view(np.int64)
        order = np.lexsort((start, ties[doc], ids[doc], content, key))
        same = np.zeros(len(order), bool)
        same[1:] = (key[order][1:] == key[order][:-1]) & (content[order][1:] == content[order][:-1])
        go, gone = order[~same], order[same]
        yield _batch(_SEG_NAMES, key[go], content[go], ids[doc[go]], ties[doc[go]], start[go], count[go])
        rdoc, rstart, rend = _merged(doc[gone], start[gone], start[gone] + count[gone] % _PERIODIC + LENGTH - 1)
        if len(rdoc):
            spread = _mix((ids[rdoc] * 31 + rstart).astype(np.uint64)).view(np.int64)
            yield _batch(_SEG_NAMES, spread, np.zeros(len(rdoc), np.int64), ids[rdoc], ties[rdoc], rstart, rstart - rend)


def _compared(hot: int):
    """Segments by anchor, content and place -> removed intervals (kind 0) and segments to index (kind 1).

    Of an anchor only the first segment of each content is held, and at most `hot` of these: with
    more the anchor counts as one of `hot` + 1 members, and its segments go on at once.
    """

    def removed(*columns: np.ndarray) -> pa.RecordBatch:
        none = np.zeros(len(columns[0]), np.int64)
        return _batch(_OUT_NAMES, none.astype(np.int32), *columns, none, none)

    def opened(firsts: np.ndarray, crowded: int | None) -> pa.RecordBatch:
        key, ids, ties, start, count = firsts
        _, group, sizes = np.unique(key, return_inverse=True, return_counts=True)
        members = sizes[group]
        if crowded is not None:
            members[key == crowded] = hot + 1
        go = (members > 1) | (count > _PERIODIC)
        return _batch(_OUT_NAMES, np.ones(go.sum(), np.int32), ids[go], ties[go], start[go], count[go] % _PERIODIC, key[go], members[go])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, crowded = np.empty((5, 0), np.int64), None, None
        for batch in batches:
            key, content, ids, ties, start, count = (batch.column(n).to_numpy() for n in _SEG_NAMES)
            done = count < 0
            if done.any():
                yield removed(ids[done], ties[done], start[done], -count[done])
            live = ~done
            if not live.any():
                continue
            content = content[live]
            rows = np.stack([key[live], ids[live], ties[live], start[live], count[live]])
            first = np.ones(len(content), bool)
            first[1:] = (rows[0, 1:] != rows[0, :-1]) | (content[1:] != content[:-1])
            first[0] = (rows[0, 0], content[0]) != last
            last = rows[0, -1], content[-1]
            copies = rows[:, ~first]
            if copies.size:
                yield removed(*copies[1:4], copies[4] % _PERIODIC + LENGTH - 1)
            held = np.concatenate([held, rows[:, first]], axis=1)
            open_ = held[0] == last[0]  # the last anchor may go on in the next batch
            yield opened(held[:, ~open_], crowded)
            held = held[:, open_]
            if crowded == last[0] or held.shape[1] > hot:
                crowded = last[0]
                yield opened(held, crowded)
                held = held[:, :0]
        yield opened(held, crowded)

    return compare


_BLOCK = "block long, id long, tie long, start long, count long, bytes binary"
_BLOCK_NAMES = [x.split()[0] for x in _BLOCK.split(", ")]


def _texts_of_segments(blocks: int, hot: int):
    """Cuts the segments to index out of their documents.

    Where an anchor has very many different segments, their strings go on one by one, under a key
    made of the whole string; of equal ones at hand only the first. What is at hand is bounded in
    bytes, and so are the batches that go on.
    """

    def rows(out: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64()] * 5 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], _BLOCK_NAMES)

    def firsts(seen: dict[bytes, tuple]) -> Iterator[tuple]:
        for string, place in seen.items():
            yield int.from_bytes(sha256(string).digest()[:7], "big") % blocks, *place, 1, string

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TEXT_ROWS):
            out: list[tuple] = []
            seen: dict[bytes, tuple] = {}
            held = 0
            ids, ties = (batch.column(n).to_pylist() for n in ("id", "tie"))
            segments = batch.column("segments")
            ends = segments.offsets.to_numpy()
            fields = [segments.values.field(k).to_numpy(zero_copy_only=False) for k in range(4)]
            for r, (i, tie) in enumerate(zip(ids, ties)):
                text = batch.column("text")[r].as_py()
                for k in range(ends[r], ends[r + 1]):
                    a, n, key, members = (int(f[k]) for f in fields)
                    if members <= hot:
                        out.append((key % blocks, i, tie, a, n, text[a : a + n + LENGTH - 1]))
                        held += n + ROW_BYTES
                    else:
                        for b in range(a, a + n):
                            string, place = text[b : b + LENGTH], (i, tie, b)
                            earlier = seen.get(string)
                            if earlier is None or place < earlier:
                                seen[string], place = place, earlier
                            if place:
                                out.append((hash(place) % blocks, *place, -LENGTH, b""))
                        held += n * ROW_BYTES
                    if held > HELD_BYTES:
                        yield rows([*out, *firsts(seen)])
                        out, seen, held = [], {}, 0
            if out or seen:
                yield rows([*out, *firsts(seen)])

    return cut


def suffix_ranks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each suffix of `data`, which ends with a byte of its own, and its first eight bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.zeros(len(data), np.uint64)
    for k in range(8):
        words = words << _U(8) | padded[k : k + len(data)]
    _, rank = np.unique(words, return_inverse=True)
    rank = rank.astype(np.int64)
    have = 8
    while rank.max() < len(data) - 1:
        behind = np.zeros(len(data), np.int64)
        if have < len(data):
            behind[:-have] = rank[have:] + 1
        _, rank = np.unique(rank * (len(data) + 1) + behind, return_inverse=True)
        rank = rank.astype(np.int64)
        have *= 2
    return rank, words


class RunIndex:
    """Runs of the Burrows-Wheeler transform of a text, and suffix positions sampled at run ends.

    `heads` and `lengths` are the transform itself. `position` holds the text positions before the
    run starts, `match` the suffix sorted just before each of them, and `agree` how many bytes
    both have in common, counted up to `limit`.
    """

    def __init__(self, data: np.ndarray, limit: int):
        rank, words = suffix_ranks(data)
        sorted_ = np.empty(len(data), np.int64)
        sorted_[rank] = np.arange(len(data))
        transform = data[sorted_ - 1]
        first = np.flatnonzero(np.concatenate([[True], transform[1:] != transform[:-1]]))
        self.heads, self.lengths = transform[first], np.diff(np.append(first, len(data)))
        position = np.sort((sorted_[first] - 1) % len(data))
        row = rank[position]
        self.position, self.match = position, sorted_[np.maximum(row - 1, 0)]
        # the suffix that sorts first has none before it
        self.agree = np.where(row > 0, self._common(data, words, limit), -len(data))

    def _common(self, data: np.ndarray, words: np.ndarray, limit: int) -> np.ndarray:
        agree = np.zeros(len(self.position), np.int64)
        live = np.arange(len(agree))
        padded = np.concatenate([words, np.arange(limit + 8, dtype=np.uint64)])  # differ behind the end
        at = 0
        while at < limit and len(live):
            a, b = padded[self.position[live] + at], padded[self.match[live] + at]
            different = a ^ b
            same = different == 0
            # equal leading bytes of two words that differ
            lead = np.zeros(len(live), np.int64)
            for k in range(1, 8):
                lead += (different >> _U(64 - 8 * k)) == 0
            agree[live] += np.where(same, 8, lead)
            live, at = live[same], at + 8
        return np.minimum(agree, limit)

    def matches(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(suffix, bytes in common) of each position: those of the next sample, shifted."""
        k = np.searchsorted(self.position, at)
        known = k < len(self.position)
        k = np.minimum(k, max(len(self.position) - 1, 0))
        back = self.position[k] - at
        return np.where(known, self.match[k] - back, at), np.where(known, self.agree[k] + back, 0)


def repeated_strings(texts: list[bytes], counts: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For texts in order, the starts, among the first `counts` of each, of strings that stood before."""
    data = np.frombuffer(_SEPARATOR.join(texts) + _SEPARATOR + _END, np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    offsets = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = offsets[owner] + nth
    match, agree = RunIndex(data, length).matches(at)
    chain = np.arange(len(data))
    long_ = agree >= length
    chain[at[long_]] = match[long_]
    while True:
        further = chain[chain]
        if (further == chain).all():
            break
        chain = further
    root = chain[at]
    least = np.full(len(data), len(data))
    np.minimum.at(least, root, at)
    again = least[root] < at
    bounds = np.searchsorted(owner[again], np.arange(len(texts) + 1))
    starts = nth[again]
    return [starts[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _indexed(table: pa.Table) -> pa.Table:
    """The removed intervals of one block."""
    ids, ties, start, count = (table.column(n).to_numpy() for n in ("id", "tie", "start", "count"))
    done = np.flatnonzero(count < 0)
    out = [(ids[done], ties[done], start[done], start[done] - count[done])]
    live = np.flatnonzero(count > 0)
    live = live[np.lexsort((start[live], ties[live], ids[live]))]
    if len(live):
        column, known, again = table.column("bytes"), {}, []
        for k in live:
            if known.setdefault(column[int(k)].as_py(), k) != k:
                again.append(k)
        # a segment that stands here before is removed as a whole; the index holds the different ones
        out.append((ids[again], ties[again], start[again], start[again] + count[again] + LENGTH - 1))
        live = np.fromiter(known.values(), np.int64)
        found = repeated_strings(list(known), count[live])
        row = np.repeat(live, [len(x) for x in found])
        a = start[row] + np.concatenate(found)
        doc, a, b = _merged(row, a, a + LENGTH)
        out.append((ids[doc], ties[doc], a, b))
    return pa.table({n: np.concatenate(c).astype(np.int64) for n, c in zip(("id", "tie", "start", "end"), zip(*out))})


def _distinct_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, tie, text (UTF-8): rows told apart by a number where an id stands repeatedly."""
    last = (1 << 63) - 1
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(last)).alias("id"), text_or_empty(text_col).cast("binary").alias("text"))
    again = stored(rows.groupBy("id").count().where("count > 1").select("id"), "repeated_ids")
    nth = F.row_number().over(Window.partitionBy("id").orderBy(F.sha2("text", 256))).cast("long")
    one = rows.join(again, "id", "left_anti").select("id", F.lit(0).cast("long").alias("tie"), "text")
    return one.union(rows.join(again, "id", "left_semi").select("id", nth.alias("tie"), "text"))


def repeated_spans(rows: DataFrame) -> DataFrame:
    """id, tie, start, end: byte intervals to remove from `rows` (id, tie, text), not yet merged."""
    long_ = rows.where(F.octet_length("text") >= LENGTH)
    order = ["key", "content", "id", "tie", "start"]
    segments = long_.mapInArrow(_segments, _SEG).repartition("key").sortWithinPartitions(*order)
    # what is left is small for the tasks that find it: few files of full size
    compared = stored(segments.mapInArrow(_compared(HOT_ANCHOR), _OUT).hint("rebalance", "id"), "segments")
    copies = compared.where("kind = 0").select("id", "tie", "start", (F.col("start") + F.col("count")).alias("end"))
    open_ = compared.where("kind = 1")
    # strings of crowded anchors come one by one
    size = F.when(F.col("members") > HOT_ANCHOR, F.col("count") * (LENGTH + 1)).otherwise(F.col("count") + LENGTH)
    total = open_.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // BLOCK_BYTES))
    per_doc = open_.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "count", "anchor", "members")).alias("segments"))
    cut = long_.join(per_doc, ["id", "tie"]).mapInArrow(_texts_of_segments(blocks, HOT_ANCHOR), _BLOCK)
    indexed = cut.groupBy("block").applyInArrow(_indexed, "id long, tie long, start long, end long")
    return copies.union(stored(indexed.hint("rebalance", "id"), "block_spans"))


def _maximal(spans: DataFrame) -> DataFrame:
    """Touching intervals of a row made one."""
    by_start = Window.partitionBy("id", "tie").orderBy("start")
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("start") > F.col("before"), F.lit(True)).cast("long")
    nth = F.sum(new).over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    numbered = spans.withColumn("before", before).withColumn("nth", nth)
    return numbered.groupBy("id", "tie", "nth").agg(F.min("start").alias("start"), F.max("end").alias("end"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, spans (maximal removed intervals), kept (bytes left) for each row of `df`.

    A byte goes if a string of LENGTH bytes over it also starts earlier: in a row with a smaller
    id, or further to the front. Missing ids come last. Rows that share an id are told apart by
    the hash of their text, and are earlier or later by it. A missing text is empty.
    """
    rows = _distinct_rows(df, id_col, text_col)
    spans = _maximal(repeated_spans(rows)).groupBy("id", "tie").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    size, none = F.octet_length("text"), F.array().cast("array<struct<start:long,end:long>>")
    out = rows.join(spans, ["id", "tie"], "left").select("id", "text", size.cast("long").alias("n_bytes"), F.coalesce("spans", none).alias("spans"))
    # what lies between the spans, joined as strings: Latin-1 has one character for each byte
    begin, end = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["end"].cast("int"))), F.transform("spans", lambda s: s["start"].cast("int"))
    pieces = F.zip_with(begin, F.concat(end, F.array(size)), lambda a, b: F.decode(F.substr("text", a + 1, b - a), "ISO-8859-1"))
    kept = F.when(F.size("spans") == 0, F.col("text")).otherwise(F.encode(F.array_join(pieces, ""), "ISO-8859-1"))
    return out.select(F.nullif("id", F.lit((1 << 63) - 1)).alias(id_col), "n_bytes", "spans", kept.alias("kept"))
