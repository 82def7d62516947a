"""Packing along a space-filling curve: similar documents end up in the same or neighbouring sequences.

A document is tokenized; its ids are hashed into a vector of FEATURES counts, which fixed random directions project to
DIMS coordinates; their place on a Hilbert curve is the sort key. Documents are ranked by it with range
partitions and prefix sums of their lengths, and the stream of ids along the curve is cut every ``length`` ids. So no
sequence but the last has padding.

Cases: a null text is empty and gives its end id only; ties of the key are ordered by id and place; repeated rows are
packed each; a document longer than a sequence is cut; extra columns are left out; an empty table gives an empty one.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from functools import cache
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellgrain.llm.common import no_cycle_search, prefix_sums, table
from cellgrain.llm.media import pieces

LENGTH, END, FEATURES, DIMS, BITS = 2048, 1, 1024, 4, 12
#: Distinct words whose ids an encoder keeps, and rows of a hash table in pack().
MEMO, JOIN_ROWS = 300_000, 500_000


@cache
def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> str:
    """The character that stands for each byte in a byte-level model: its own if Latin-1 prints it, else the next one
    from 256 on."""
    own = {b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()}
    return "".join(chr(b) if b in own else chr(256 + sum(x not in own for x in range(b))) for b in range(256))


class Words(dict):
    """Ids of words, put together from their parts by the pattern; a new part is given to the library's model."""

    def __init__(self, model, pattern):
        super().__init__()
        self.tokenize, self.words, self.alphabet = model.tokenize, pattern.findall, byte_alphabet()

    def part(self, word: str) -> bytes:
        found = self.get(word)
        if found is None:
            found = self[word] = array("I", [t.id for t in self.tokenize(charmap_decode(word.encode(), "strict", self.alphabet)[0])]).tobytes()
        return found

    def __missing__(self, word: str) -> bytes:
        stem = word.rstrip(punctuation)
        if not stem[stem[:1] == " " :].isalpha():
            found = b"".join(map(self.part, self.words(word)))
        elif len(stem) == len(word):  # letters are one part, and signs behind them another
            return self.part(word)
        else:
            found = self.part(stem) + self.part(word[len(stem) :])
        self[word] = found
        return found

    def trim(self, size: int) -> None:
        """Keeps the first ``size`` words."""
        while len(self) > size:
            self.popitem()


class Encoder:
    """Ids of whole texts by the tokenizers library, without special tokens being added.

    A byte-level model merges inside of words only, so each distinct word is given to the library's model once and its
    ids are kept, those of the first MEMO words for good. A text is cut before its spaces and around single line ends,
    or by the model's published pattern if white space precedes a space; it goes to the library whole if it has an
    added token's string, or a character that the pattern and the library's own cutting put into different classes."""

    #: The byte-level pattern (fixed value).
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size()
        parts = json.loads(self.library.to_str())
        cutter = parts["pre_tokenizer"] or {}
        self.by_words = not parts["normalizer"] and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
        self.added = [x["content"] for x in parts["added_tokens"]]
        self.words, self.letter, self.space = regex.compile(self.PATTERN).findall, regex.compile(r"\p{L}").fullmatch, regex.compile(r"\s").fullmatch
        self.memo = Words(self.library.model, regex.compile(self.PATTERN))
        self.agreed: set[str] = set()
        self.spaces: set[str] = set()

    def agree(self, characters: set[str]) -> bool:
        """Whether both cut at these characters alike: after a letter, a digit and a sign, and before a word."""
        for c in characters - self.agreed:
            if c.isalpha() != bool(self.letter(c)):
                return False
            for probe in (f"a{c}a", f"1{c}1", f"!{c}!", f"{c}{c}a"):
                at = [0]
                for w in self.words(probe):
                    at.append(at[-1] + len(w))
                if [x[1][1] for x in self.library.pre_tokenizer.pre_tokenize_str(probe)] != at[1:]:
                    return False
            self.agreed.add(c)
            if self.space(c):
                self.spaces.add(c)
        return True

    def cut(self, text: str) -> list[str] | None:
        """Words, or None for a text that isn't to be cut."""
        characters = set(text)
        if not self.by_words or not self.agree(characters) or any(x in text for x in self.added):
            return None
        spaces = characters & self.spaces
        if "\0" in characters or any(c + " " in text for c in spaces):
            return self.words(text)
        if "\n" in spaces and spaces <= {" ", "\n"} and "\n\n" not in text and " \n" not in text:
            text = text.replace("\n", "\0\n\0")
        return text.replace(" ", "\0 ").split("\0")

    def ids(self, texts: list[str], end: int) -> list[np.ndarray]:
        last, ids_of, out = array("I", [end]).tobytes(), self.memo.__getitem__, []
        for text in texts:
            words = self.cut(text)
            some = map(ids_of, words) if words is not None else [array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()]
            out.append(np.frombuffer(b"".join(some) + last, "<u4"))
        self.memo.trim(MEMO)
        return out


@cache
def encoder(path: str) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(path)


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit integer mix: multiply and shift."""
    x = (x.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def directions(features: int = FEATURES, dims: int = DIMS) -> np.ndarray:
    """Fixed random directions with entries of +1 and -1."""
    bits = mix(np.arange(features * dims), 7) >> np.uint64(40) & np.uint64(1)
    return bits.astype(np.float64).reshape(features, dims) * 2 - 1


def coordinates(counts: np.ndarray, axes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Grid cells of count vectors (rows): their damped, scaled projections, mapped from [-1, 1] to the grid."""
    x = np.sqrt(counts) @ axes / np.sqrt(np.maximum(counts.sum(axis=1, keepdims=True), 1))
    # A random direction's projection is of order 1; tanh spreads the bulk over the grid and bounds the rest.
    return np.minimum((np.tanh(x / 2) + 1) / 2 * (1 << bits), (1 << bits) - 1).astype(np.int64)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of grid cells (rows) on the Hilbert curve, all rows at once: reflect and swap axes from the highest bit
    down, Gray-decode, and interleave the bits."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            on = (x[:, i] >> b & 1).astype(bool)
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] = np.where(on, x[:, 0] ^ low, x[:, 0] ^ swap)
            x[:, i] ^= swap
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, n - 1] >> b & 1, (1 << b) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[:, i] >> b & 1)
    return key


def tokenized(docs: DataFrame, path: str | None = None, end: int = END) -> DataFrame:
    """doc_id, curve key, n and ids (little-endian unsigned 32-bit) of every text with its end id."""
    path = path or public_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, axes = encoder(path), directions()
        feature = (mix(np.arange(of.size), 3) % np.uint64(FEATURES)).astype(np.int64)
        for whole in batches:
            for b in pieces(whole, "text", 4 << 20):
                with no_cycle_search():
                    ids = of.ids([t or "" for t in b.column("text").to_pylist()], end)
                counts = np.array([np.bincount(feature[x], minlength=FEATURES) for x in ids]).reshape(-1, FEATURES)
                cells = coordinates(counts, axes)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(hilbert_key(cells), pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())], names=["doc_id", "curve_key", "n", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, curve_key long, n long, ids binary")


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, with_ids: bool = True) -> DataFrame:
    """One row a piece: doc_id, start, length, doc_tokens, sequence_id, offset, curve_key, ids_crc32 and the ids."""
    ids = table(tokenized(docs, path, end).withColumn("_row", F.monotonically_increasing_id()))
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), ids.count() // JOIN_ROWS + 1)
    ranked, _ = prefix_sums(ids.select("_row", "doc_id", "curve_key", "n"), ["curve_key", "doc_id", "_row"], "n", "at")
    # A narrow side per partition, of JOIN_ROWS rows or so, as hash table; the wide one is neither sorted nor held.
    placed = ids.repartition(n, "_row").join(ranked.select("_row", "at").repartition(n, "_row").hint("shuffle_hash"), "_row").select("doc_id", "curve_key", "n", "ids", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, "ids", 4 << 20):
                src, out = [], []
                for i, (n, data, at) in enumerate(zip(b.column("n").to_pylist(), b.column("ids"), b.column("at").to_pylist(), strict=True)):
                    raw = data.as_buffer()
                    start = 0
                    while start < n:
                        size = min(n - start, length - (at + start) % length)
                        part = memoryview(raw)[4 * start : 4 * (start + size)]
                        src.append(i)
                        out.append((start, size, zlib.crc32(part), n, (at + start) // length, (at + start) % length, bytes(part) if with_ids else None))
                        start += size
                rows = b.select(["doc_id", "curve_key"]).take(pa.array(src, pa.int64()))
                cols = list(zip(*out, strict=True)) or [()] * 7
                yield pa.RecordBatch.from_arrays([*rows.columns, *(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.binary())], names=["doc_id", "curve_key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return placed.mapInArrow(run, f"doc_id {kind}, curve_key long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")


def packed_pieces(docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    return pack(docs, with_ids=False).drop("ids")
