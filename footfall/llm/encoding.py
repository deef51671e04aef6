"""Encode text chunk by chunk: a chunk is what stands between two spaces, with the space before it.

Byte-level pre-tokenizers never let a token cross the border before a space, so the ids of a
text are those of its chunks, one after another. Only runs of two or more spaces break that
rule; a text that has one is encoded whole. A task keeps the chunks that it has encoded.
"""

from __future__ import annotations

import json
import os
import struct

_encoders: dict[str, ChunkEncoder] = {}


def _rank_encoding(path: str):
    """The same vocabulary for tiktoken, which is faster on short texts; None where it would not be the same.

    It is where the file is plain byte-level BPE and each merge makes a token of a higher id than
    the merge before.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import pre_tokenizers

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    merges = [x if isinstance(x, list) else x.split(" ") for x in model.get("merges", [])]
    made = [model["vocab"].get(a + b, -1) for a, b in merges]
    if not plain or model.get("end_of_word_suffix") or model.get("dropout") or any(a >= b for a, b in zip(made, made[1:], strict=False)):
        return None
    letters = sorted(pre_tokenizers.ByteLevel.alphabet())
    raw = {}
    for letter in letters:  # a byte that is not printable by itself is written as a letter from 256 on
        raw[letter] = ord(letter) if ord(letter) < 256 else None
    missing = [b for b in range(256) if b not in raw.values()]
    for letter, byte in zip((x for x in letters if raw[x] is None), missing, strict=True):
        raw[letter] = byte
    special = {x["content"] for x in spec.get("added_tokens", [])}
    ranks = {bytes(raw[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class _Known(dict):
    """Ids of a word with a space before it."""

    #: Entries of one task; beyond them all are let go.
    ENTRIES = 600_000
    #: Longer words are encoded without being kept.
    LONGEST = 48

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(" " + word)
        if len(word) <= self.LONGEST:
            if len(self) >= self.ENTRIES:
                self.clear()
            self[word] = ids
        return ids


class ChunkEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranks = _rank_encoding(path)
        self.known = _Known(self.whole)

    def whole(self, text: str) -> bytes:
        if self.ranks and not any(x in text for x in self.special):
            ids = self.ranks.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text or "  " in text:
            return self.whole(text)
        first, *rest = text.split(" ")
        return self.whole(first) + b"".join(map(self.known.__getitem__, rest))

    def forget(self) -> None:
        """Let go of the chunks kept: a worker lives on after its task, through the stages that follow."""
        self.known.clear()


def encoder(path: str) -> ChunkEncoder:
    """The encoder of this worker process."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]
