"""Packing documents into fixed windows: best-fit decreasing over a segment tree of remaining capacities.

Texts are tokenized in tasks. Documents longer than a window are cut into full windows first. What is
left has a length below the window, so the whole problem is a histogram of at most `window` counts: the
driver packs that histogram (its size does not depend on the corpus) and gets a table of moves, each
"items i..j of this length go to windows a.., so many to a window, from this offset on". Tasks number
their items within a length and look the move up.

Best-fit decreasing in runs: the tightest open window stays the tightest until no further item of the
same length fits, so a window takes floor(remaining / length) equal items at once.

Defined cases: a null or empty text is one piece holding the end id alone; repeated rows are packed
once each; a null doc_id is carried; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomdex.llm.common import keep

WINDOW = 4096
END_ID = 2
#: Items of one length that one task numbers; a commoner length is split by hash.
RANK_BLOCK = 2_000
#: Characters tokenized at a time, and pieces remembered; both only bound memory.
STRETCH = 1 << 20
REMEMBERED = 300_000
#: Lower-cased letters and digits that are plain: one lower case, and no composition with a neighbour.
_LETTERS = "a-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f\u0400-\u045f"
_DIGITS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
#: How the tokenizer cuts plain text.
PIECE = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_LETTERS}]+|[{_DIGITS}]|[^ \n\t{_LETTERS}{_DIGITS}]+")
#: A chunk with a character that is not plain, or with the mark of a special token.
_PLAIN = r"!-~\u00a1-\u012f\u0132-\u017f\u0400-\u045f"
NOT_PLAIN = re.compile(rf"[^ \n\t{_PLAIN}]")
HARD = re.compile(rf"([^ \n\t]*?(?:[^ \n\t{_PLAIN}]|<\|)[^ \n\t]*)")
#: Byte-level vocabularies write a byte as itself where that is a visible Latin-1 character, others as the letters from 256 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}

_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class PieceTokenizer:
    """Token ids of a text as little-endian unsigned 32-bit bytes.

    The tokenizer cuts a lower-cased text into pieces and merges within pieces only, and no piece crosses white
    space. Stretches of plain characters are therefore cut here, by the same pattern, and only pieces not
    seen before go through the merges. A white-space separated chunk with any other character, or with the mark of a special
    token, goes through the whole tokenizer. Ids are remembered in two generations, the older of which is
    dropped when the younger is full, so what is in use stays.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(BYTE_LETTERS)
        return array("I", [token.id for token in self.merges.tokenize(piece)]).tobytes()

    def _plain(self, text: str) -> bytes:
        pieces = PIECE.findall(text.lower())
        different = set(pieces)
        new = different.difference(self.known)
        if new:
            if len(self.known) + len(new) > self.remembered:
                self.older, self.known, new = self.known, {}, different
            for piece in new:
                ids = self.older.get(piece)
                self.known[piece] = self._ids(piece) if ids is None else ids
        return b"".join(map(self.known.__getitem__, pieces))

    def _whole(self, chunk: str) -> bytes:
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _stretch(self, text: str) -> bytes:
        if "<|" not in text and not NOT_PLAIN.search(text):
            return self._plain(text)
        parts = HARD.split(text)  # plain and hard parts in turn
        return b"".join(self._whole(x) if i % 2 else self._plain(x) for i, x in enumerate(parts))

    def encode(self, text: str) -> bytes:
        out, at = bytearray(), 0
        while at < len(text):
            end = text.find(" ", at + STRETCH)
            end = len(text) if end < 0 else end
            out += self._stretch(text[at:end])
            at = end
        return bytes(out)


_tokenizers: dict[str, PieceTokenizer] = {}


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """Pieces of at most `window` ids: full windows first, then the rest of each document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer_path not in _tokenizers:  # kept by the worker process
            _tokenizers[tokenizer_path] = PieceTokenizer(tokenizer_path)
        tokenizer = _tokenizers[tokenizer_path]
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memoryview(tokenizer.encode(text.as_py() or "") + end)
                total = len(ids) // 4
                for at in range(0, total, window):
                    part = ids[4 * at:4 * (at + window)]
                    rows.append((doc_id, at, len(part) // 4, zlib.crc32(part), total))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, _PIECES)


class CapacityTree:
    """Segment tree over remaining capacities: the smallest capacity of at least x that has open windows."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, capacity: int, windows: int) -> None:
        node = capacity + self.leaves
        while node:
            self.open[node] += windows
            node >>= 1

    def tightest(self, least: int) -> int | None:
        node = least + self.leaves
        if self.open[node]:
            return least
        while node > 1:  # climb until a right sibling holds something, then take its leftmost leaf
            if not node & 1 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


@dataclass(frozen=True)
class Move:
    """Items first .. first+count-1 of one length: `per_window` of them to each window from `window_id` on, at `offset`."""

    length: int
    first: int
    count: int
    window_id: int
    per_window: int
    offset: int


def best_fit_decreasing(counts: dict[int, int], window: int = WINDOW) -> list[Move]:
    tree, moves, opened = CapacityTree(window), [], 0
    classes: dict[int, deque[tuple[int, int]]] = {}

    def put(capacity: int, first: int, windows: int, front: bool = False) -> None:
        if capacity and windows:
            held = classes.setdefault(capacity, deque())
            held.appendleft((first, windows)) if front else held.append((first, windows))
            tree.add(capacity, windows)

    for length in sorted(counts, reverse=True):
        left, done = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                windows = -(-left // (window // length))
                put(window, opened, windows)
                opened += windows
                continue
            first, windows = classes[room].popleft()
            tree.add(room, -windows)
            fits = room // length
            full = min(windows, left // fits)
            for used, each in ((full, fits), (min(1, windows - full), left - full * fits)):
                if used and 0 < each <= fits:
                    moves.append(Move(length, done, used * each, first, each, window - room))
                    put(room - each * length, first, used)
                    first, windows, done, left = first + used, windows - used, done + used * each, left - used * each
            put(room, first, windows, front=True)
    return moves


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    spark = docs.sparkSession
    cut = keep(pieces(docs, tokenizer_path, window))
    counts = {r.length: r["count"] for r in cut.groupBy("length").count().collect()}  # at most `window` rows
    moves = best_fit_decreasing(counts, window)

    # Number the items of each length. A common length is dealt out by hash, so no task numbers more than a block.
    blocks = spark.createDataFrame(
        [(n, -(-c // RANK_BLOCK)) for n, c in counts.items()], "length bigint, blocks bigint"
    )
    dealt = cut.join(F.broadcast(blocks), "length").withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens"), F.col("blocks"))
    )
    sizes = dealt.groupBy("length", "block").count()
    before = sizes.select(
        "length", "block",
        (F.sum("count").over(Window.partitionBy("length").orderBy("block")) - F.col("count")).alias("before"),
    )
    inside = Window.partitionBy("length", "block").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = (
        dealt.withColumn("place", F.row_number().over(inside) - 1)
        .join(before, ["length", "block"])
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("place")).alias("place"))
    )

    table = np.array([(m.length, m.first, m.window_id, m.per_window, m.offset) for m in moves], np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # No length holds 2^50 items, so (length, place) is one sortable number.
        keys = (table[:, 0] << 50) + table[:, 1]
        for batch in batches:
            if batch.num_rows:
                length, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 5))
                move = table[np.searchsorted(keys, (length << 50) + place, side="right") - 1]
                nth = place - move[:, 1]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:5], pa.array(move[:, 2] + nth // move[:, 3]), pa.array(move[:, 4] + nth % move[:, 3] * length)],
                    [*batch.schema.names[:5], "sequence_id", "offset"],
                )

    return numbered.mapInArrow(assign, f"{_PIECES}, sequence_id bigint, offset bigint")
