"""Best-fit packing: token pieces into sequences of a fixed length.

Bounded-space online best-fit: a fixed number of bins is open, in a bitset keyed by free
space; a piece goes to the open bin with the least free space that still holds it, and where
one bin too many is open the fullest closes first. Pieces are dealt to chunks of a bounded
number of pieces, so that tasks pack side by side. A chunk's pieces arrive in waves, each the
longest first, and its bins stay open from wave to wave: the long pieces of a wave open bins
that its short ones fill, so few bins are open and those that close are nearly full.

Defined results: a null or empty text is the end id alone; a null doc_id stays null; repeated
rows are packed each on their own; an empty table gives no rows; other columns of the input
are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import ROWS, map_columns, staged
from footfall.llm.encoding import encoder

CAPACITY = 2048
#: Bins open at a time.
OPEN_BINS = 512
#: Pieces of a chunk and of a wave, on average.
CHUNK, WAVE = 16_000, 1000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Encode every text, append end_id, and cut what is longer than capacity.

    Of a document that is cut, the first piece takes what is left over after whole ones.
    """

    def cut(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        own, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = own.encode(text) + end
                n, start = len(ids) // 4, 0
                for piece in range(-(-n // capacity)):
                    stop = start + ((n % capacity or capacity) if piece == 0 else capacity)
                    for column, value in zip(out.values(), (doc_id, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])), strict=True):
                        column.append(value)
                    start = stop
            yield out
        own.forget()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_columns(texts, cut, PIECES, ROWS)


class Bins:
    """Open bins by free space; bit f of `free` is set where a bin with f tokens free is open."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.free, self.open, self.count, self.made = 0, [[] for _ in range(capacity + 1)], 0, 0

    def put(self, length: int) -> tuple[int, int]:
        """The bin of a piece and its place there."""
        fits = self.free >> length
        if fits and length < self.capacity:
            room = length + (fits & -fits).bit_length() - 1
            at = self._take(room)
        else:
            room, at = self.capacity, self.made
            self.made += 1
        if left := room - length:
            if self.count == self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
            self.open[left].append(at)
            self.free |= 1 << left
            self.count += 1
        return at, self.capacity - room

    def _take(self, room: int) -> int:
        at = self.open[room].pop()
        self.count -= 1
        if not self.open[room]:
            self.free &= ~(1 << room)
        return at


def best_fit(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, chunk: int = CHUNK) -> DataFrame:
    """Give each piece a sequence and a place there; a sequence is gapless from 0.

    `pieces` has a `length` of 1 to capacity and is read twice: stage it first. The columns
    sequence_id and offset are added.
    """
    count = pieces.count()
    chunks = max(1, round(count / chunk))
    waves = max(1, round(count / chunks / WAVE))

    def pack(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        now, bins = None, None
        for batch in batches:
            ids, offsets = [], []
            for c, length in zip(batch.pop("_chunk"), batch["length"], strict=True):
                if c != now:
                    now, bins = c, Bins(capacity, open_bins)
                at, offset = bins.put(length)
                ids.append((c << 40) + at)
                offsets.append(offset)
            del batch["_wave"]
            yield batch | {"sequence_id": ids, "offset": offsets}

    # A written table is read in the same order again, so a chunk is the same when a task is run anew.
    place = F.monotonically_increasing_id()
    wave = F.pmod(F.xxhash64(place, F.lit("wave")), F.lit(waves))
    dealt = pieces.withColumns({"_chunk": F.pmod(F.xxhash64(place), F.lit(chunks)), "_wave": wave})
    in_order = dealt.repartition(chunks, "_chunk").sortWithinPartitions("_chunk", "_wave", F.desc("length"), "doc_id", "piece", "ids_crc32")
    return map_columns(in_order, pack, PACKED)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Pieces of every document with their sequences: PACKED."""
    return best_fit(staged(token_pieces(docs, tokenizer_path, capacity), "pieces"), capacity, open_bins)
