"""Packing of documents into fixed-length token sequences by vector bin packing.

Every item has a vector: tokens, segments (1) and loss-bearing tokens. A sequence has a limit for each. An open
sequence takes, of the waiting items that fit in every dimension, the one whose vector has the largest dot product
with the room left (both in shares of the limits). When none fits whole and room is left, an item is cut. Each task
packs the rows of its own partition while it tokenizes them: no row is shuffled, and a retried task repeats only
its own rows. Items wait in a window of bounded size, so memory does not grow with the partition.
"""

from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from pathlib import Path
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long"
)


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold. ``window``: items that wait at once in a task."""

    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048
    window: int = 1024


@cache
def _loaded(path: str):
    """The tokenizer in the file and its merges alone, once in a process."""
    import json

    from tokenizers import Tokenizer
    from tokenizers.models import BPE

    model = json.loads(Path(path).read_text())["model"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return Tokenizer.from_file(path), BPE(model["vocab"], pairs, cache_capacity=0)


class WordIds(dict):
    """Ids of pieces of text by piece, each with ``lead`` before it; a piece is encoded when first seen.

    A piece of letters alone is one token of the byte-level pattern, so the merges can be run on it directly. The
    number of pieces held is bounded.
    """

    ROOM = 1_000_000

    def __init__(self, path: str, lead: str = ""):
        self.lead = lead
        self.tokenizer, self.merges = _loaded(path)
        letters = [c for c in map(chr, range(0x250)) if c.isalpha()]
        spelled = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.table = {ord(c): spelled(c)[0][0] for c in [*letters, " "]}
        self.plain = re.compile(f"[{''.join(letters)}]+")

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.ROOM:
            self.clear()
        if self.plain.fullmatch(piece):
            ids = [t.id for t in self.merges.tokenize((self.lead + piece).translate(self.table))]
        elif piece[-1:] in ",." and self.plain.fullmatch(piece[:-1]):
            ids = self.tokenizer.encode(piece[-1], add_special_tokens=False).ids
            ids = np.frombuffer(self[piece[:-1]], np.uint32).tolist() + ids
        else:
            ids = self.tokenizer.encode(self.lead + piece, add_special_tokens=False).ids
        raw = array("I", ids).tobytes()
        if len(piece) <= 64:
            self[piece] = raw
        return raw


class TextIds:
    """Ids of whole texts. One space or line feed between other characters always ends a token of the byte-level
    pattern, so a text is cut there and its ids are those of the cuts end to end."""

    _CUT = re.compile(r"(?<=\S)(?= \S)")
    _DOUBLE = ("  ", " \n", "\n ", "\n\n")

    def __init__(self, path: str):
        self.bare, self.spaced = WordIds(path), WordIds(path, " ")

    def clear(self) -> None:
        """Drop the pieces held. A worker lives on after its task, and other work needs the memory."""
        self.bare.clear()
        self.spaced.clear()

    def __call__(self, text: str) -> bytes:
        ends = text[:1] + text[-1:]
        if any(x in text for x in self._DOUBLE) or " " in ends or "\n" in ends or not text.replace("\n", "").isprintable():
            return b"".join([self.bare[x] for x in self._CUT.split(text)])
        bare, spaced, feed = self.bare, self.spaced.__getitem__, self.bare["\n"]
        out = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(feed)
            out.append(bare[first])
            out.extend(map(spaced, rest))
        return b"".join(out[1:])


_TOKENIZERS: dict[str, TextIds] = {}


def text_ids(path: str) -> TextIds:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = TextIds(path)
    return _TOKENIZERS[path]


def encoded(text: str | None, known: TextIds, end_id: int) -> np.ndarray:
    """The ids of a whole text, and the end id after them."""
    return np.frombuffer((known(text) if text else b"") + np.uint32(end_id).tobytes(), np.uint32)


class Packer:
    """Bins of one task. Waiting items are rows of a matrix; ``place`` hands out (item, start, length, sequence, offset)."""

    def __init__(self, limits: Limits, first_sequence: int):
        self.limits = limits
        self.full = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.next_sequence = first_sequence
        self.room = self.full.copy()
        self.offset = 0
        self.sequence = None

    def open(self) -> None:
        self.sequence, self.offset, self.room = self.next_sequence, 0, self.full.copy()
        self.next_sequence += 1

    def put(self, item: int, start: int, tokens: int, loss: int) -> tuple[int, int, int, int, int]:
        if self.sequence is None:
            self.open()
        placed = (item, start, tokens, self.sequence, self.offset)
        self.offset += tokens
        self.room -= (tokens, 1, loss)
        if self.room[0] < 1 or self.room[1] < 1:
            self.sequence = None
        return placed

    def place(self, lengths: np.ndarray, loss: list[np.ndarray | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """``loss``: per item a mask of its loss-bearing tokens (None: all are)."""
        starts = np.zeros(len(lengths), np.int64)
        tokens = np.asarray(lengths, float).copy()
        cost = np.array([n if m is None else m.sum() for n, m in zip(lengths, loss)], float)
        waiting = int((tokens > 0).sum())
        tokens[tokens == 0] = np.inf  # placed

        def loss_of(i: int, start: int, length: int) -> int:
            return length if loss[i] is None else int(loss[i][start : start + length].sum())

        def longest(i: int) -> int:
            """The longest cut of item i that the open sequence has room for."""
            n = int(min(self.room[0], lengths[i] - starts[i]))
            if loss[i] is None:
                return int(min(n, self.room[2]))
            if loss_of(i, starts[i], n) <= self.room[2]:
                return n
            return int(np.searchsorted(np.cumsum(loss[i][starts[i] : starts[i] + n]), self.room[2], side="right"))

        while waiting:
            if self.sequence is None:
                self.open()
            a, _, c = self.room / self.full**2  # one segment counts the same for every item
            score = tokens * a + cost * c
            score[(tokens > self.room[0]) | (cost > self.room[2])] = -1
            i = int(np.argmax(score))
            if score[i] >= 0:
                n = int(tokens[i])
            else:
                i = int(np.argmax(np.where(tokens == np.inf, -1, tokens)))
                n = longest(i)
                if n < 1:
                    self.sequence = None  # no room for a loss-bearing token: close it
                    continue
            start, spent = int(starts[i]), loss_of(i, starts[i], n)
            yield self.put(i, start, n, spent)
            starts[i] += n
            tokens[i] -= n
            cost[i] -= spent
            if tokens[i] == 0:
                tokens[i] = np.inf
                waiting -= 1


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, limits: Limits = Limits(), keep_ids: bool = True) -> DataFrame:
    """One row per piece of a document: its ids, its place in the document and in its sequence.

    A null or empty text has the end id alone. A null doc_id stays null; repeated rows are packed each for itself.
    Ties go to the row that came first. An empty table gives no rows. Other columns are not read. ``keep_ids`` False
    leaves ``ids`` as the unsigned CRC-32 of the piece in four little-endian bytes, for callers that need no ids.
    Which documents share a sequence follows from how the input is split; every result obeys the limits.
    """
    return _packed(docs.select("doc_id", F.col("text")), tokenizer_path, end_id, limits, keep_ids, None)


def pack_conversations(turns: DataFrame, tokenizer_path: str, end_id: int = 1, limits: Limits = Limits()) -> DataFrame:
    """Turns (doc_id, text, bears_loss boolean) as items; tokens of rows without ``bears_loss`` cost no loss room."""
    return _packed(turns.select("doc_id", "text", "bears_loss"), tokenizer_path, end_id, limits, True, "bears_loss")


def _packed(rows, tokenizer_path, end_id, limits, keep_ids, loss_column):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = text_ids(tokenizer_path)
        packer = Packer(limits, TaskContext.get().partitionId() << 32)
        waiting, held = [], 0
        try:
            for batch in batches:
                marks = batch.column(2).to_pylist() if loss_column else None
                for k, doc_id in enumerate(batch.column(0).to_pylist()):
                    ids = encoded(batch.column(1)[k].as_py(), known, end_id)
                    waiting.append((doc_id, ids, None if marks is None or marks[k] else np.zeros(len(ids), bool)))
                    held += len(ids)
                    if len(waiting) >= limits.window or held >= 1000 * limits.tokens:
                        yield emitted(packer, waiting)
                        waiting, held = [], 0
            if waiting:
                yield emitted(packer, waiting)
        finally:
            known.clear()

    def emitted(packer, waiting):
        lengths = np.array([len(x[1]) for x in waiting], np.int64)
        out = list(packer.place(lengths, [x[2] for x in waiting]))
        cols = [[] for _ in range(8)]
        for i, start, n, sequence, offset in out:
            doc_id, ids, loss = waiting[i]
            raw = ids[start : start + n].tobytes()
            row = (
                doc_id,
                start,
                n,
                raw if keep_ids else zlib.crc32(raw).to_bytes(4, "little"),
                len(ids),
                n if loss is None else int(loss[start : start + n].sum()),
                sequence,
                offset,
            )
            for c, v in zip(cols, row):
                c.append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = [x.split()[0] for x in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return rows.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, PIECES)
