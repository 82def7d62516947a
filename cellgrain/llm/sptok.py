"""SentencePiece encoding and decoding by a max-plus parallel scan.

Merges in this kind of model obey a local law: a sequence of pieces is the encoding of a text if and only if every two
neighbours are the encoding of their joint text. So encoding is a best path in max-plus algebra: an arc between
neighbouring pieces weighs 0 if they are compatible and minus infinity if not, and exactly one path has weight 0.

Every text is split into blocks of BLOCK characters anywhere, also inside words. The state at a boundary is the piece
that starts last before it. Each block yields, on its own, the matrix of its transfers from entry to exit states (its
finite entries are stored). Matrices are combined pairwise, in a tree of max-plus products; going down the tree again
leaves one state at each boundary, and every block traces its own pieces between its two states. A text of over CHUNK
characters is dealt out to tasks as chunks of so many; the roots of their trees meet in a tree of their own, and the
states at the chunks' ends go back to them. Where no piece can cross a place (before a space that follows a word), all
paths meet, so the words between such places are traced apart, and a worker keeps the ids of the words that it met.

The ids equal those of the sentencepiece library with the same model file. Cases: a null or empty text has no ids;
U+2581 in a text is decoded as a space, as in the library; text without any space is handled like other text; repeated
rows are encoded each; extra columns are left out; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellgrain.llm.common import table
from cellgrain.llm.media import pieces

CHUNK, BLOCK, MARK = 16_384, 2048, "▁"
#: Words, pairs of pieces and so on that a Python worker keeps of each kind.
MEMO = 300_000
#: The state at a boundary that no piece crosses.
CLEAN = 0
NEVER = float("-inf")
Matrix = set[tuple[int, int]]


@cache
def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def normalized(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


class Memo(dict):
    """What a function gave for its first MEMO arguments; it is called again for others."""

    def __init__(self, f):
        super().__init__()
        self.f = f

    def __missing__(self, key):
        x = self.f(key)
        if len(self) < MEMO:
            self[key] = x
        return x


class Pieces:
    """A model's pieces: which strings are pieces, which neighbours are compatible, and the ids of whole words."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.id = {model.id_to_piece(i): i for i in plain}
        self.raw = {p: np.array([i], "<u4").tobytes() for p, i in self.id.items()}
        self.byte = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.longest = max(map(len, self.id))
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.id):
            raise ValueError("pieces that cross the start of a word aren't supported")
        back = {i: bytes([b]) for b, i in self.byte.items()}
        known = set(plain)
        self.text = [model.id_to_piece(i).replace(MARK, " ").encode() if i in known else back.get(i, b"") for i in range(n)]
        self.inside = {p[k : k + 2] for p in self.id for k in range(len(p) - 1)}
        self.parts = Memo(lambda w: self.bytes_of(self.merged(w)))
        self.words = Memo(self.word)
        self.pairs = Memo(lambda p: self.merged(p[0] + p[1]) == [*p])
        self.heads, self.tails = Memo(lambda x: self.enter(*x)), Memo(lambda x: self.leave(*x))

    def bytes_of(self, parts: list[str]) -> bytes:
        """Ids (32-bit) of pieces; a character outside of the model has those of its bytes."""
        raw = self.raw
        return b"".join([raw[p] if p in raw else np.array([self.byte[b] for b in p.encode()], "<u4").tobytes() for p in parts])

    def merged(self, s: str) -> list[str]:
        """The encoding of a string inside a word: the best-scored neighbours merge first, leftmost on ties."""
        get, parts = self.score.get, list(s)
        scores = [get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) > NEVER:
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], NEVER)
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], NEVER)
        return parts

    def word(self, s: str) -> bytes:
        """Ids of a word. No piece crosses two characters that no piece has next to each other, so all paths meet there,
        too, and the parts between such places are merged apart."""
        inside, at, parts = self.inside, 0, []
        for k in range(1, len(s)):
            if s[k - 1 : k + 1] not in inside:
                parts.append(s[at:k])
                at = k
        return b"".join(map(self.parts.__getitem__, [*parts, s[at:]])) if parts else self.parts[s]

    def encode(self, text: str) -> bytes:
        """Ids of a normalized text that starts and ends between words."""
        if MARK * 2 in text or "\0" in text:
            words = re.findall(f"{MARK}+[^{MARK}]*", text)
        else:
            words = text.replace(MARK, "\0" + MARK).split("\0")[1:]
        return b"".join(map(self.words.__getitem__, words))

    def after(self, text: str, at: int) -> Iterator[str]:
        """Pieces that start at a place. A character outside of the model is one, too."""
        for n in range(1, min(self.longest, len(text) - at) + 1):
            p = text[at : at + n]
            if n == 1 or p in self.id:
                yield p

    def sweep(self, s: str, reach: dict[int, dict[str | None, int]], stop: int) -> dict[tuple[int, str], int]:
        """From places with the piece before them, each with a set of origins as bits: the pieces that come first to
        ``stop`` or beyond, by start, with the origins that a path leads from."""
        out: dict[tuple[int, str], int] = {}
        compatible = self.pairs.__getitem__
        for place in range(min(reach, default=stop), stop):
            for prev, origins in reach.pop(place, {}).items():
                for p in self.after(s, place):
                    if prev is None or compatible((prev, p)):
                        to = place + len(p)
                        if to >= stop:
                            out[place, p] = out.get((place, p), 0) | origins
                        else:
                            now = reach.setdefault(to, {})
                            now[p] = now.get(p, 0) | origins
        return out

    def path(self, s: str, at: int, prev: str | None, stop: int, last: tuple[int, int] | None) -> list[str]:
        """The pieces after ``prev`` up to ``stop``, or up to ``last`` (start, length), which reaches or passes it. From
        one origin at most one piece ends at each place, because an encoding is unique."""
        ends: dict[int, str | None] = {at: prev}
        for place in range(at, stop):
            if place not in ends:
                continue
            before = ends[place]
            for p in self.after(s, place):
                if (before is None or self.pairs[before, p]) and (place + len(p) <= stop or (place, len(p)) == last):
                    ends[place + len(p)] = p
        out: list[str] = []
        place = sum(last) if last else stop
        while place > at:
            p = s[last[0] : place] if last and not out else ends[place]
            out.append(p)
            place -= len(p)
        return out[::-1]

    def crossing(self, s: str, at: int) -> list[tuple[int, int]]:
        """(start, length) of all pieces of ``s`` that may start last before a place."""
        return [(a, len(p)) for a in range(max(0, at - self.longest), at) for p in self.after(s, a) if a + len(p) >= at]

    def enter(self, s: str, at: int) -> list[int]:
        """States at a place inside of a word's rest ``s`` from which a path leads to its end."""
        states = self.crossing(s, at)
        reach: dict[int, dict[str | None, int]] = {}
        ends = 0
        for k, (a, n) in enumerate(states):
            if a + n == len(s):
                ends |= 1 << k
            else:
                now = reach.setdefault(a + n, {})
                now[s[a : a + n]] = now.get(s[a : a + n], 0) | 1 << k
        for origins in self.sweep(s, reach, len(s)).values():
            ends |= origins
        return [code(a, n, at) for k, (a, n) in enumerate(states) if ends >> k & 1]

    def leave(self, s: str, at: int) -> list[int]:
        """States at a place to which a path leads from the start of ``s``, a word's."""
        return [code(a, len(p), at) for a, p in self.sweep(s, {0: {None: 1}}, at)]


@cache
def model_of(path: str) -> Pieces:
    """One for all tasks of a Python worker."""
    return Pieces(path)


def code(start: int, size: int, boundary: int) -> int:
    return (boundary - start) * 1024 + size


def barrier(text: str, at: int) -> bool:
    return at <= 0 or at >= len(text) or (text[at] == MARK and text[at - 1] != MARK)


class Block:
    """Places ``low`` to ``high`` of a text, which has as much around them as a piece is long."""

    def __init__(self, model: Pieces, text: str, low: int, high: int, first: bool, last: bool):
        self.m, self.text, self.low, self.high = model, text, low, high
        self.clean_in, self.clean_out = first or barrier(text, low), last or barrier(text, high)
        # The first and the last place inside at which all paths meet.
        self.first, self.last = (low if self.clean_in else None), (high if self.clean_out else None)
        if self.first is None:
            found = re.compile(f"(?<=[^{MARK}]){MARK}").search(text, low + 1, high)
            self.first = found.start() if found else self.last
        if self.last is None:
            at = high
            while self.first is not None and at > self.first and not barrier(text, at):
                at -= 1
            self.last = self.first if self.first is None or at <= self.first else at
        if not self.clean_in:
            self.begin = next((k for k in range(low, max(0, low - model.longest), -1) if barrier(text, k)), max(0, low - model.longest))
        self.end = high if self.clean_out else next((k for k in range(high + 1, len(text)) if barrier(text, k)), len(text))

    def transfers(self) -> Matrix:
        """The finite entries of the block's matrix."""
        if self.first is not None:
            ins = [CLEAN] if self.clean_in else self.m.heads[self.text[self.begin : self.first], self.low - self.begin]
            outs = [CLEAN] if self.clean_out else self.m.tails[self.text[self.last : self.end], self.high - self.last]
            return {(i, o) for i in ins for o in outs}
        # One word covers the block.
        s, at, stop = self.text[self.begin : self.end], self.low - self.begin, self.high - self.begin
        states = self.m.crossing(s, at)
        out: Matrix = set()
        reach: dict[int, dict[str | None, int]] = {}
        for k, (a, n) in enumerate(states):
            if a + n >= stop:  # a piece over the whole block is the exit state, too
                out.add((code(a, n, at), code(a, n, stop)))
            else:
                now = reach.setdefault(a + n, {})
                now[s[a : a + n]] = now.get(s[a : a + n], 0) | 1 << k
        for (a, p), origins in self.m.sweep(s, reach, stop).items():
            out |= {(code(*states[k], at), code(a, len(p), stop)) for k in range(len(states)) if origins >> k & 1}
        return out

    def trace(self, entry: int, exit_: int) -> bytes:
        """Ids of the pieces that start in the block."""
        start, size = self.low - entry // 1024, entry % 1024
        last = (self.high - exit_ // 1024, exit_ % 1024)
        piece = self.text[start : start + size]
        if self.first is None:
            if start + size >= self.high:
                return b""
            b = self.begin
            return self.m.bytes_of(self.m.path(self.text[b : self.end], start + size - b, piece, self.high - b, (last[0] - b, last[1])))
        head = tail = b""
        if entry != CLEAN:
            b = self.begin
            head = self.m.bytes_of(self.m.path(self.text[b : self.first], start + size - b, piece, self.first - b, None))
        if exit_ != CLEAN:
            b = self.last
            tail = self.m.bytes_of(self.m.path(self.text[b : self.end], 0, None, self.high - b, (last[0] - b, last[1])))
        return head + self.m.encode(self.text[self.first : self.last]) + tail


def combine(a: Matrix, b: Matrix) -> Matrix:
    """Max-plus product of two matrices whose entries are 0 (listed) or minus infinity. Associative."""
    by: dict[int, list[int]] = {}
    for i, o in b:
        by.setdefault(i, []).append(o)
    return {(i, o) for i, k in a for o in by.get(k, ())}


def tree(matrices: list[Matrix]) -> list[list[Matrix]]:
    """Levels of pairwise products, from the matrices themselves to their product."""
    levels = [matrices]
    while len(levels[-1]) > 1:
        m = levels[-1]
        levels.append([combine(m[k], m[k + 1]) if k + 1 < len(m) else m[k] for k in range(0, len(m), 2)])
    return levels


def boundary_states(levels: list[list[Matrix]], entry: int = CLEAN, exit_: int = CLEAN) -> list[tuple[int, int]]:
    """Entry and exit state of each of a tree's matrices, from those of its product downwards."""
    states = [(entry, exit_)]
    for m in levels[-2::-1]:
        down = []
        for k, (i, o) in enumerate(states):
            if 2 * k + 1 < len(m):
                mid = min({y for x, y in m[2 * k] if x == i} & {x for x, y in m[2 * k + 1] if y == o})
                down += [(i, mid), (mid, o)]
            else:
                down.append((i, o))
        states = down
    return states


def split(text: str, size: int, overlap: int) -> list[tuple[str, int, int, bool, bool]]:
    """Chunks of a text with ``overlap`` characters around them: text, low, high, first, last."""
    n = max(1, -(-len(text) // size))
    return [(text[max(0, k * size - overlap) : (k + 1) * size + overlap], min(overlap, k * size), min(overlap, k * size) + min(size, len(text) - k * size), k == 0, k == n - 1) for k in range(n)]


def blocks(m: Pieces, chunk: tuple[str, int, int, bool, bool], size: int) -> tuple[list[Block], list[list[Matrix]]]:
    """A chunk's blocks and the tree of their matrices."""
    text, low, high, first, last = chunk
    cuts = [*range(low, high, size), high] if high > low else [low, high]
    some = [Block(m, text, a, b, first and a == low, last and b == high) for a, b in zip(cuts, cuts[1:], strict=False)]
    return some, tree([b.transfers() for b in some])


def traced(m: Pieces, chunk: tuple[str, int, int, bool, bool], size: int, entry: int = CLEAN, exit_: int = CLEAN) -> tuple[bytes, int]:
    """Ids of the pieces that start in a chunk, between its two states, and the number of its blocks."""
    some, levels = blocks(m, chunk, size)
    return b"".join(b.trace(*s) for b, s in zip(some, boundary_states(levels, entry, exit_), strict=True)), len(some)


def encode(docs: DataFrame, path: str | None = None, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """doc_id, n_chunks (blocks) and ids (binary, little-endian unsigned 32-bit) of every text."""
    path = path or public_model()
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    giant = F.char_length("text") >= chunk
    fields = ("part", "low", "high", "first", "last")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model_of(path)
        for batch in batches:
            for b in pieces(batch, "text", 4 << 20):
                texts = map(normalized, b.column("text").to_pylist())
                found = [traced(m, (t, 0, len(t), True, True), block) for t in texts]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([n for _, n in found], pa.int64()), pa.array([x for x, _ in found], pa.binary())], names=["doc_id", "n_chunks", "ids"])

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        overlap = model_of(path).longest
        for b in batches:
            for i, t in enumerate(b.column("text")):
                parts = split(normalized(t.as_py()), chunk, overlap)
                for k in range(0, len(parts), 64):
                    some = parts[k : k + 64]
                    same = b.slice(i, 1).select(["_row", "doc_id"]).take(pa.array([0] * len(some)))
                    yield pa.RecordBatch.from_arrays([*same.columns, pa.array(range(k, k + len(some)), pa.int64()), *(pa.array(c) for c in zip(*some, strict=True))], names=["_row", "doc_id", "k", *fields])

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model_of(path)
        for b in batches:
            found = [sorted(blocks(m, x, block)[1][-1][0]) for x in zip(*(b.column(c).to_pylist() for c in fields), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("_row"), b.column("k"), *(pa.array([[p[j] for p in x] for x in found], pa.list_(pa.int64())) for j in (0, 1))], names=["_row", "k", "i", "o"])

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("k")
        states = boundary_states(tree([set(zip(map(int, i), map(int, o), strict=True)) for i, o in zip(pdf["i"], pdf["o"], strict=True)]))
        return pd.DataFrame({"_row": pdf["_row"].to_numpy(), "k": pdf["k"].to_numpy(), "entry": [s[0] for s in states], "exit": [s[1] for s in states]})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model_of(path)
        for b in batches:
            found = [traced(m, x[:5], block, *x[5:]) for x in zip(*(b.column(c).to_pylist() for c in (*fields, "entry", "exit")), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("_row"), b.column("doc_id"), b.column("k"), pa.array([n for _, n in found], pa.int64()), pa.array([x for x, _ in found], pa.binary())], names=["_row", "doc_id", "k", "n", "part_ids"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.slice(i, 1)
                parts = b.column("x")[0].as_py()
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([sum(p["n"] for p in parts)], pa.int64()), pa.array([b"".join(p["part_ids"] for p in parts)], pa.binary())], names=["doc_id", "n_chunks", "ids"])

    small = rows.where(~giant).mapInArrow(whole, f"doc_id {kind}, n_chunks long, ids binary")
    parts = rows.where(giant).withColumn("_row", F.monotonically_increasing_id()).mapInArrow(cut_up, f"_row long, doc_id {kind}, k long, part string, low long, high long, first boolean, last boolean")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = table(parts.repartition(n, "_row", "k"))
    # A chunk's matrix has a few hundred entries at most; the given number of partitions isn't merged into fewer.
    roots = parts.mapInArrow(transfer, "_row long, k long, i array<long>, o array<long>").repartition(n, "_row")
    states = roots.groupBy("_row").applyInPandas(scan, "_row long, k long, entry long, exit long")
    found = parts.join(states, ["_row", "k"]).mapInArrow(trace, f"_row long, doc_id {kind}, k long, n long, part_ids binary")
    joined = found.groupBy("_row").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("k", "n", "part_ids"))).alias("x"))
    return small.unionByName(joined.select("doc_id", "x").mapInArrow(join, f"doc_id {kind}, n_chunks long, ids binary"))


def decode(encoded: DataFrame, path: str | None = None, out: str = "text") -> DataFrame:
    """Adds the text of ``ids``."""
    path = path or public_model()
    names = [c for c in encoded.columns if c != out]
    schema = ", ".join(f"`{k}` {t}" for k, t in encoded.dtypes if k != out) + f", `{out}` string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model_of(path).text
        for batch in batches:
            for b in pieces(batch, "ids", 4 << 20):
                texts = [b"".join(map(of.__getitem__, np.frombuffer(x.as_py() or b"", "<u4").tolist()))[1:].decode("utf-8", "replace") for x in b.column("ids")]
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in names), pa.array(texts, pa.string())], names=[*names, out])

    return encoded.select(*names).mapInArrow(run, schema)


def encoded_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, n_chunks and the decoded text's length and checksum."""
    back = decode(encode(docs))
    return back.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"), "n_chunks", F.octet_length("text").cast("long").alias("decoded_bytes"), F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"))
