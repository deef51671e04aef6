"""BPE encoding and decoding by a table of distinct words.

1. Texts are split into words (what stands between spaces and line breaks). Documents are
   taken in blocks; a block keeps its distinct words once and each text as places in them.
2. All blocks' words meet in buckets, where each distinct word is encoded once.
3. The ids go back to the blocks and are joined by position; ids are decoded by looking up
   each one's piece in the table of the vocabulary, whose size is fixed.

Only compressed word lists and places move, never a row per occurrence. A block holds whole
documents of about BLOCK characters, a bucket a share of the distinct words; more shuffle
partitions make more and smaller buckets.

Words end at spaces and line breaks only, where this kind of pre-tokenizer always ends a
token; any other white space, and special strings inside a word, are left to the tokenizer.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated
rows are encoded each; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import map_columns, ship, staged, tasks

#: Characters of a block, and of the texts that share a row of it, about.
BLOCK, ROW = 32_000_000, 1_000_000

_BLOCKS = "kind int, block string, bucket int, doc_ids array<long>, lengths array<int>, places binary, words binary"
_CODED = "kind int, block string, doc_ids array<long>, lengths array<int>, places binary, counts binary, ids binary"
ENCODED = "doc_id long, ids binary"


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, lowest bytes first: most high bytes are zero, and vanish."""
    raw = numbers.astype("<u4").view("u1").reshape(-1, 4)
    return zlib.compress(raw.T.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), "u1").reshape(4, -1).T).view("<u4").ravel()


class _Places(dict):
    """Number words by first use."""

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        return at


class _Block:
    """Documents read so far: their words' numbers, and each distinct word."""

    def __init__(self, name: str, buckets: int):
        self.name, self.buckets = name, buckets
        self.number, self.doc_ids, self.texts, self.sizes, self.chars = _Places(), [], [], [], 0

    def add(self, doc_id: int | None, text: str) -> None:
        words = [x for x in text.replace("\n", " ").split(" ") if x]
        self.doc_ids.append(doc_id)
        self.texts.append(np.array(list(map(self.number.__getitem__, words)), "<u4"))
        self.sizes.append(len(text))
        self.chars += len(text)

    def rows(self) -> Iterator[tuple]:
        """Rows of _BLOCKS. Frequent words get the low places."""
        if not self.doc_ids:
            return
        uses = np.bincount(np.concatenate(self.texts), minlength=len(self.number)) if self.number else np.zeros(0, "i8")
        order = np.argsort(-uses, kind="stable")
        place = np.empty(len(order), "<u4")
        place[order] = np.arange(len(order))
        # The name tells the content: another block under the same number has another name.
        name = f"{self.name}-{zlib.crc32(place.tobytes(), zlib.crc32(str((len(self.texts), *list(self.number)[-9:])).encode()))}"
        row = np.cumsum([0, *self.sizes[:-1]]) // ROW
        for part in np.split(np.arange(len(row)), np.flatnonzero(np.diff(row)) + 1):
            own = self.texts[part[0] : part[-1] + 1]
            yield 1, name, None, self.doc_ids[part[0] : part[-1] + 1], [len(x) for x in own], _pack(place[np.concatenate(own)]), None
        words = [x.encode() for x in self.number]
        bucket = np.array([zlib.crc32(x) % self.buckets for x in words], "i8")[order]
        for b in np.unique(bucket):
            at = np.flatnonzero(bucket == b)
            yield 0, name, int(b), None, None, _pack(np.diff(at, prepend=0)), zlib.compress(b"\n".join(words[i] for i in order[at]))


def _load(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _columns(rows: list[tuple], schema: str) -> dict[str, list]:
    return {x.split()[0]: [r[i] for r in rows] for i, x in enumerate(schema.split(", "))}


def _blocks(docs: DataFrame, buckets: int, size: int) -> DataFrame:
    """kind 1: places of the words of some documents; kind 0: the words of a block that fall into a bucket."""

    def split(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        part, number = TaskContext.get().partitionId(), 0
        block = _Block(f"{part}-0", buckets)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                block.add(doc_id, text)
                if block.chars >= size:
                    yield _columns([*block.rows()], _BLOCKS)
                    number += 1
                    block = _Block(f"{part}-{number}", buckets)
        yield _columns([*block.rows()], _BLOCKS)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_columns(texts, split, _BLOCKS)


def _encode_words(words: DataFrame, tokenizer_path: str) -> DataFrame:
    """Each distinct word of a bucket is encoded once; every block gets the ids of its words."""

    def encode(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        tokenizer, now, known = _load(tokenizer_path), None, {}
        for batch in batches:
            rows = []
            for block, bucket, places, packed in zip(batch["block"], batch["bucket"], batch["places"], batch["words"], strict=True):
                if bucket != now:
                    now, known = bucket, {}
                words = zlib.decompress(packed).split(b"\n")
                new = [x for x in words if x not in known]
                for word, e in zip(new, tokenizer.encode_batch_fast([x.decode() for x in new], add_special_tokens=False), strict=True):
                    known[word] = np.array(e.ids, "<u4").tobytes()
                ids = [known[x] for x in words]
                counts = np.array([len(x) // 4 for x in ids], "<u4")
                rows.append((0, block, None, None, places, _pack(counts), _pack(np.frombuffer(b"".join(ids), "<u4"))))
            yield _columns(rows, _CODED)

    by_bucket = words.repartition("bucket").sortWithinPartitions("bucket")
    return map_columns(by_bucket.select("block", "bucket", "places", "words"), encode, _CODED)


class _Table:
    """Ids of a block's words by place."""

    def __init__(self):
        self.at, self.counts, self.ids, self.starts = [], [], [], None

    def add(self, places: bytes, counts: bytes, ids: bytes) -> None:
        self.at.append(np.cumsum(_unpack(places), dtype="i8"))
        self.counts.append(_unpack(counts))
        self.ids.append(_unpack(ids))

    def full(self) -> bool:
        return self.starts is not None or bool(self.at)

    def of(self, places: np.ndarray) -> np.ndarray:
        if self.starts is None:
            at, counts = np.concatenate(self.at), np.concatenate(self.counts).astype("i8")
            ends = np.cumsum(counts)
            self.flat = np.concatenate(self.ids)
            self.starts, self.length = np.empty(len(at), "i8"), np.empty(len(at), "i8")
            self.starts[at], self.length[at] = ends - counts, counts
            self.at = self.counts = self.ids = None
        length = self.length[places]
        shift = self.starts[places] - (np.cumsum(length) - length)
        return self.flat[np.repeat(shift, length) + np.arange(length.sum())]


def _by_position(coded: DataFrame, finish, schema: str) -> DataFrame:
    """finish(ids) is what a document's row holds beside its doc_id."""

    def join(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        now, table, last = None, _Table(), finish()
        for batch in batches:
            rows = []
            for kind, block, doc_ids, lengths, places, counts, ids in zip(*(batch[x.split()[0]] for x in _CODED.split(", ")), strict=True):
                if block != now:
                    now, table = block, _Table()
                if kind == 0:
                    table.add(places, counts, ids)
                    continue
                if not table.full() and any(lengths):
                    raise RuntimeError(f"block {block} was read otherwise a second time; encode with reread=False")
                texts = np.split(_unpack(places), np.cumsum(lengths)[:-1])
                rows += [(doc_id, *last(table.of(at) if len(at) else at)) for doc_id, at in zip(doc_ids, texts, strict=True)]
            yield _columns(rows, schema)

    together = coded.repartition("block").sortWithinPartitions("block", "kind")
    return map_columns(together, join, schema)


def _coded(docs: DataFrame, tokenizer_path: str, block: int, reread: bool) -> DataFrame:
    """Texts as places, and the ids of each block's words.

    Both come from the same blocks. They are written once; with `reread` the texts are read
    and split a second time instead, which saves the disk. That is right for tables of files,
    which are read alike each time; a block that differs is an error, never a wrong result.
    """
    blocks = _blocks(docs, 4 * tasks(docs.sparkSession), block)
    if not reread:
        blocks = staged(blocks, "blocks")
    words = _encode_words(blocks.where("kind = 0"), tokenizer_path)
    empty = F.lit(None).cast("binary")
    texts = blocks.where("kind = 1").select("kind", "block", "doc_ids", "lengths", "places", empty.alias("counts"), empty.alias("ids"))
    return texts.unionByName(words)


def encode(docs: DataFrame, tokenizer_path: str, block: int = BLOCK, reread: bool = False) -> DataFrame:
    """doc_id and its ids, little-endian unsigned 32-bit integers."""
    return _by_position(_coded(docs, tokenizer_path, block, reread), lambda: lambda ids: (ids.tobytes(),), ENCODED)


def pieces(spark, tokenizer_path: str) -> DataFrame:
    """The vocabulary as a table: id, piece."""
    tokenizer = _load(tokenizer_path)
    return spark.createDataFrame([(i, w) for w, i in sorted(tokenizer.get_vocab(True).items(), key=lambda x: x[1])], "id int, piece string")


def decode(ids: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and text of each row of doc_id and ids array<int>: the ids' pieces, with spaces between.

    The table of pieces has as many rows as the vocabulary and is broadcast.
    """
    row = ids.select("doc_id", "ids", F.monotonically_increasing_id().alias("_row"))
    each = row.select("doc_id", "_row", F.posexplode_outer("ids").alias("_at", "id"))
    found = each.join(F.broadcast(pieces(ids.sparkSession, tokenizer_path)), "id", "left")
    lists = found.groupBy("_row").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("_at", "piece")))).alias("_p"))
    return lists.select("doc_id", F.array_join(F.col("_p.piece"), " ").alias("text"))


def digests(docs: DataFrame, tokenizer_path: str, block: int = BLOCK, reread: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, and SHA-256 of the ids and of the text decoded from them."""
    ship(docs.sparkSession)

    def finish():
        tokenizer = _load(tokenizer_path)
        piece = [tokenizer.id_to_token(i).encode() for i in range(tokenizer.get_vocab_size(True))]

        def row(ids: np.ndarray) -> tuple:
            text = b" ".join(map(piece.__getitem__, ids.tolist()))
            return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text).hexdigest()

        return row

    return _by_position(_coded(docs, tokenizer_path, block, reread), finish, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
