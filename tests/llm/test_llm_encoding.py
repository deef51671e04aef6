"""BPE and packing against the tokenizers library."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from corpora import PLAIN, documents, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from footfall.llm import bpe, encoding, packing
from footfall.llm.queries import tokenizer_file

WORDS, BYTES = tokenizer_file("word_bpe_49k.json"), tokenizer_file("byte_bpe_50k.json")
HARD = ["a  b\n\n c\x85d  e <|endoftext|>x<|startoftext|> É é ΣΑΣ İ ½² 12 it's don't \x1c z", "é \u0301a \\n\u0301", "\u3000<|\x00endoftext|>ﷺ"]


def rows_of(seed=0):
    return PLAIN + [(100 + i, t) for i, t in enumerate(HARD)] + [(200 + i, prose(seed + i, 1 + 700 * i)) for i in range(6)]


@pytest.mark.parametrize("reread", [False, True])
def test_bpe_equals_the_library(spark, tmp_path, reread):
    rows = rows_of()
    path = str(tmp_path / "docs")
    documents(spark, rows).write.parquet(path)
    library = Tokenizer.from_file(WORDS)
    expected = Counter()
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    found = bpe.digests(spark.read.parquet(path), WORDS, block=3000, reread=reread)
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_bpe_round_trip_and_empty_tables(spark):
    docs = documents(spark, [(1, "hello wörld <|endoftext|>"), (2, None)])
    ids = {r.doc_id: list(struct.unpack(f"<{len(r.ids) // 4}I", r.ids)) for r in bpe.encode(docs, WORDS).collect()}
    library = Tokenizer.from_file(WORDS)
    assert ids == {1: library.encode("hello wörld <|endoftext|>", add_special_tokens=False).ids, 2: []}
    back = bpe.decode(spark.createDataFrame(list(ids.items()), "doc_id long, ids array<int>"), WORDS)
    assert {r.doc_id: r.text for r in back.collect()} == {1: library.decode(ids[1], skip_special_tokens=False), 2: ""}
    assert bpe.digests(docs.limit(0), WORDS).count() == 0


def test_chunks_equal_whole_texts():
    own, library = encoding.ChunkEncoder(BYTES), Tokenizer.from_file(BYTES)
    assert own.ranks
    rng = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", " \n", "\t", "é", "'s", "'", "1", "²", "<|endoftext|>", "<|", "\u3000", "\x85", "x" * 60, "ﷺ", ".", "--"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids), repr(text)


def test_packing_is_whole_gapless_and_tight(spark):
    rows = rows_of(50) + [(500 + i, prose(i, 10 + 13 * i)) for i in range(120)]
    found = packing.pack_documents(documents(spark, rows), BYTES).collect()
    library = Tokenizer.from_file(BYTES)
    expected = Counter()
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        start, piece = 0, 0
        while start < len(ids):
            stop = start + (2048 if piece else len(ids) % 2048 or 2048)
            expected[doc_id, piece, start, stop - start, zlib.crc32(struct.pack(f"<{stop - start}I", *ids[start:stop]))] += 1
            start, piece = stop, piece + 1
    assert Counter(tuple(r)[:5] for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(r.length for r in found) // 2048) + 1


def test_large_ids_next_to_a_null_one_stay_whole(spark):
    rows = [(10**17 + 1, "a b"), (None, "c"), (2**53 + 1, "d"), (2**63 - 1, None)]
    found = packing.pack_documents(documents(spark, rows).coalesce(1), BYTES).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)


def test_a_fixed_number_of_open_bins_costs_little(spark):
    lengths = [1 + (i * 7919) % 2048 for i in range(20_000)]
    pieces = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], packing.PIECES)
    found = packing.best_fit(pieces).agg(F.countDistinct("sequence_id"), F.sum("length")).first()
    assert found[1] == sum(lengths)
    assert found[0] <= 1.01 * sum(lengths) / 2048
    bins, most = packing.Bins(2048, packing.OPEN_BINS), 0
    for length in sorted(lengths, reverse=True):
        bins.put(length)
        most = max(most, bins.count)
    assert most == packing.OPEN_BINS  # in one wave the bound binds


def test_bins_close_the_fullest_first():
    bins = packing.Bins(10, 2)
    assert [bins.put(n) for n in (6, 5)] == [(0, 0), (1, 0)]
    assert bins.put(8) == (2, 0)  # a third bin: number 0, with 4 free, was the fullest, and is closed
    assert bins.put(5) == (1, 5)
    assert bins.put(2) == (2, 8)


def test_packing_an_empty_table(spark):
    assert packing.pack_documents(documents(spark, PLAIN).limit(0), BYTES).count() == 0
