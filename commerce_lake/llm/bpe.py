"""Byte-pair encoding and decoding with the vocabulary of a tokenizer file.

Texts are split at ASCII white space, which no token crosses, and each distinct chunk is encoded
once per worker, of plain text each distinct word. Long unsplit text goes another way: it is cut in pieces that different tasks
encode, and neighbouring pieces are concatenated up a tree. At each join a window around it is
encoded again and grows until its first and last tokens are those the two sides have there. As
every pair of neighbouring tokens is then one that BPE leaves alone, the joined tokens are the
encoding of the whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.common import SLICE_ROWS, slices, text_or_empty

PIECE_BYTES = 1024
CACHE_ENTRIES = 300_000  # words; of chunks, which only text that is not plain has, a third
CACHED_BYTES = 64  # longer chunks are rare, and would let the cache grow with their length

#: Text of this kind needs no normaliser but lower(): ASCII and composed Latin-1 letters.
_PLAIN = re.compile(r"[!-~À-ÿ]+").fullmatch
#: The same with the white space between chunks.
_PLAIN_TEXT = re.compile(r"[!-~À-ÿ\x20\x09-\x0D]*").fullmatch
#: The pre-tokens of such text, as the tokenizer file splits it. None holds white space.
_PARTS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\x20\x09-\x0D]+")
_BPE_KIND = {"type": "BPE", "end_of_word_suffix": "</w>"}


def public_vocabulary() -> str:
    """Path of the vocabulary file the queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_alphabet() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(others)}


class _Recent(dict):
    """A cache of bounded size: the newer half is kept when it is full."""

    def __init__(self, make: Callable, size: int):
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) > CACHED_BYTES:
            return value
        if len(self) >= self.size // 2:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Vocabulary:
    """Encoder and decoder of one tokenizer file, as the tokenizers library does it.

    Chunks are byte strings without ASCII white space; ids are little-endian unsigned 32-bit.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        # the chunk-wise way holds for files of this kind; others go through the library as a whole
        steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.by_chunk = steps == ["NFC", "Replace", "Lowercase"] and all(spec["model"].get(k) == v for k, v in _BPE_KIND.items())
        if not self.by_chunk:
            raise ValueError("the vocabulary is not a lower-casing word BPE")
        inner = spec | {"model": spec["model"] | {"end_of_word_suffix": None}}
        self.suffix = spec["model"]["end_of_word_suffix"]
        self._inner_spec = inner
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        alphabet = _byte_alphabet()
        self._letters = {c: "".join(alphabet[b] for b in chr(c).encode()) for c in range(256)}
        self.words = _Recent(self._word, CACHE_ENTRIES)
        self.chunks = _Recent(self._chunk, CACHE_ENTRIES // 3)

    @functools.cached_property
    def inner_model(self):
        """The model without word ends, for pieces that do not reach the end of a word."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(json.dumps(self._inner_spec)).model

    def _word(self, word: str) -> bytes:
        mapped = word if word.isascii() else word.translate(self._letters)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(mapped)]).tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8")
        if _PLAIN(text) and "<|" not in text:
            words = self.words
            return b"".join([words[w] for w in _PARTS.findall(text.lower())])
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text.

        Plain text goes word by word: it has far fewer different words than chunks, which are words
        with the marks around them.
        """
        if _PLAIN_TEXT(text) and "<|" not in text:
            words = self.words
            return b"".join([words[w] for w in _PARTS.findall(text.lower())])
        chunks = self.chunks
        return b"".join([chunks[c] for c in text.encode("utf-8").split()])

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by spaces, special tokens included: the file names no decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])

    # Long unsplit text

    def pieces(self, text: str, size: int) -> list[tuple[str, bool, bool]]:
        """A text as (piece, unsplit, last): ordinary text, or pieces of a long pre-token.

        Pieces of a long pre-token are in the byte alphabet of the vocabulary, at most `size` bytes
        each, cut in halves as often as needed; `last` marks the one that ends its pre-token.
        """
        out: list[tuple[str, bool, bool]] = []
        plain: list[str] = []

        def flush() -> None:
            if plain:
                out.append((" ".join(plain), False, False))
                plain.clear()

        def halve(part: str, last: bool) -> None:
            if len(part) <= size:
                out.append((part, True, last))
            else:
                middle = len(part) // 2
                halve(part[:middle], False)
                halve(part[middle:], last)

        for chunk in text.encode("utf-8").split():
            if len(chunk) <= size:
                plain.append(chunk.decode("utf-8"))
                continue
            for stretch in re.split("(" + "|".join(map(re.escape, self.special)) + ")", chunk.decode("utf-8")):
                if stretch in self.special or not stretch:
                    plain += [stretch] if stretch else []
                    continue
                normal = self.tokenizer.normalizer.normalize_str(stretch)
                for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                    if len(part) > size:
                        flush()
                        halve(part, True)
                    else:
                        flush()
                        out.append((part, True, True))
        flush()
        return out

    def encode_piece(self, piece: str, unsplit: bool, last: bool) -> bytes:
        if not unsplit:
            return self.encode(piece)
        model = self.tokenizer.model if last else self.inner_model
        return array("I", [t.id for t in model.tokenize(piece)]).tobytes()

    def _surface(self, ids: list[int], last: bool) -> str:
        text = "".join([self.tokens[i] for i in ids])
        return text.removesuffix(self.suffix) if last else text

    def concatenate(self, a: list[int], b: list[int], last: bool) -> list[int]:
        """Ids of the text of `a` followed by that of `b`; `last` if `b` ends its pre-token."""
        size = 2
        while True:
            left, right = a[-size:], b[:size]
            all_left, all_right = size >= len(a), size >= len(b)
            ends = last and all_right
            model = self.tokenizer.model if ends else self.inner_model
            window = [t.id for t in model.tokenize(self._surface(left, False) + self._surface(right, ends))]
            if (all_left or window[0] == left[0]) and (all_right or window[-1] == right[-1]):
                return a[: len(a) - len(left)] + window + b[len(right) :]
            size *= 2

    def tree(self, pieces: list[tuple[list[int], bool]]) -> list[int]:
        """Ids of the concatenation of (ids, last) pieces of one pre-token, joined pairwise."""
        while len(pieces) > 1:
            joined = [(self.concatenate(a, b, last), last) for (a, _), (b, last) in zip(pieces[::2], pieces[1::2])]
            pieces = joined + pieces[len(joined) * 2 :]
        return pieces[0][0]


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary, and its caches, for each worker process."""
    return Vocabulary(path)


def long_run(text: Column, size: int) -> Column:
    """Whether a text has more than `size` characters without white space between."""
    return text.rlike(rf"[^\x20\x09-\x0D]{{{size + 1},}}+")


def _encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Rows id, text to encode as they are, and id, ids of the texts with long unsplit runs."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    # a character has up to four bytes, and a run of few characters is short in any case
    unsplit = long_run(F.col("text"), piece // 4)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(path)
        for batch in slices(batches, 16):
            out = [
                (row, i, k, *p)
                for row, i, text in zip(*(batch.column(n).to_pylist() for n in ("row", "id", "text")))
                for k, p in enumerate(voc.pieces(text, piece) or [("", False, False)])
            ]
            yield pa.RecordBatch.from_pylist([dict(zip(("row", "id", "nth", "piece", "unsplit", "last"), o)) for o in out], schema=_pieces)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(path)
        for batch in slices(batches):
            ids = [voc.encode_piece(*p) for p in zip(*(batch.column(n).to_pylist() for n in ("piece", "unsplit", "last")))]
            kept = [batch.column(n) for n in ("row", "id", "nth", "unsplit", "last")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, pa.binary())], ["row", "id", "nth", "unsplit", "last", "ids"])

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        voc = vocabulary(path)
        out, open_ = [], []
        for ids, unsplit, last in rows.sort_values("nth")[["ids", "unsplit", "last"]].itertuples(index=False):
            if not unsplit:
                out.append(ids)
                continue
            open_.append((list(memoryview(ids).cast("I")), last))
            if last:
                out.append(array("I", voc.tree(open_)).tobytes())
                open_ = []
        return pd.DataFrame({"id": rows["id"].iloc[:1].astype("Int64"), "ids": [b"".join(out)]})

    _pieces = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("nth", pa.int64()), ("piece", pa.string()), ("unsplit", pa.bool_()), ("last", pa.bool_())])
    parts = rows.where(unsplit).withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        cut, "row long, id long, nth long, piece string, unsplit boolean, last boolean"
    )
    spread = parts.repartition("row", "nth").mapInArrow(encoded, "row long, id long, nth long, unsplit boolean, last boolean, ids binary")
    whole = spread.groupBy("row").applyInPandas(joined, "id long, ids binary")
    return rows.where(~unsplit), whole


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE_BYTES) -> DataFrame:
    """id and `ids` (little-endian unsigned 32-bit, binary) for each row of `df`.

    Whole texts, a missing one as empty. Texts with long unsplit runs have these cut, encoded by
    several tasks and joined up a tree; what is gathered for that is one text at a time.
    """
    short, long_ = _encode(df, path, id_col, text_col, piece)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(path)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([voc.encode(t) for t in batch.column(1).to_pylist()], pa.binary())], ["id", "ids"])

    return short.mapInArrow(plain, "id long, ids binary").union(long_).withColumnRenamed("id", id_col)


_DECODED = "id long, n_tokens long, ids_sha256 string, decoded string"


def _decoded(voc: Vocabulary, ids_of: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
    columns = [
        ids_of,
        pa.array([len(x) // 4 for x in ids], pa.int64()),
        pa.array([sha256(x).hexdigest() for x in ids], pa.string()),
        pa.array([voc.decode(memoryview(x).cast("I")) for x in ids], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids_sha256", "decoded"])


def encode_decode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE_BYTES) -> DataFrame:
    """`decode` of `encode`, in one pass where no text has to be cut, so that a core runs one worker."""
    short, long_ = _encode(df, path, id_col, text_col, piece)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(path)
        for batch in slices(batches, SLICE_ROWS // 4):
            yield _decoded(voc, batch.column(0), [voc.encode(t) for t in batch.column(1).to_pylist()])

    return short.mapInArrow(both, _DECODED).withColumnRenamed("id", id_col).union(decode(long_, path, "id").withColumnRenamed("id", id_col))


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, n_tokens, ids_sha256 and the decoded text of each row with `ids` as `encode` returns them."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(path)
        for batch in slices(batches):
            yield _decoded(voc, batch.column(0), [x or b"" for x in batch.column(1).to_pylist()])

    rows = df.select(F.col(id_col).cast("long").alias("id"), ids_col)
    return rows.mapInArrow(decoded, _DECODED).withColumnRenamed("id", id_col)
