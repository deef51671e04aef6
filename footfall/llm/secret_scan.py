"""Secrets in texts: three patterns, and a character convolutional network over every candidate.

Candidates are all runs of 16 or more key-like characters, with digits or without, that no
pattern has found. The network sees a candidate with what stands around it. It is trained
on labelled findings: what the patterns found, some of it moved to other surroundings so
that the value itself must tell, against candidates and ordinary words that they did not
find. Since patterns find mostly hex values, each finding is also shown with its value drawn
anew from each of the ALPHABETS of keys. Probabilities are calibrated on findings held back,
and the threshold keeps a set recall on those of each alphabet. A key that no pattern knows
is labelled as no finding; lest the network learn it by heart, there are two networks, each
trained on one half of the windows (by a hash) and used for the other.

The networks are trained on every labelled window: distinct ones are dealt by a hash to shards of
about SHARD, each a row of a written table. In each of PASSES passes every shard trains the
networks' last state on its rows but every fifth, and the mean of all shards' states is the
next one. The rows held back, of all shards, set calibration and threshold, by counts of their
logits in steps of STEP. Only states and those counts are on the driver, and neither results
nor states depend on how rows are dealt to tasks. Beside findings and candidates the windows are
up to three words of each text with a finding and of one text in eight of the others. With
fewer than LEAST windows of a label there is no network, and the patterns stand alone.

Defined results: a null or empty text has no spans; repeated rows are scanned each; an empty
table gives no rows; `redacted` keeps all columns of its input, whatever their names.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.charnet import CharNet, balanced, codes, windows
from footfall.llm.common import ROWS, map_columns, staged, tasks, text_column

KINDS = ("assign", "access", "hex", "model")
LEAST, RECALL = 30, 0.98
SHARD, PASSES, STEP = 4096, 12, 0.002
MASK = "[SECRET]"
_BASE62 = string.digits + string.ascii_letters
#: Of the values that findings are shown with anew; their labels follow that of a finding as it stands, 1.
ALPHABETS = {"hex": "0123456789abcdef", "base62": _BASE62, "base64": _BASE62 + "+/", "letters": string.ascii_letters}

# The patterns of the contract, each with the length that a finding must have.
_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_WORD = re.compile(r"[A-Za-z0-9@.:/-]{6,}")

_FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base array<string>, starts array<int>, ends array<int>, windows array<string>, labels array<int>, samples array<string>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place in KINDS, end), in that order."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _apart(places: Iterable[re.Match], base: list[tuple[int, int, int]]) -> list[re.Match]:
    """Those of the places, in order of their start, that touch no span of the patterns; both lists are walked once."""
    out, at = [], 0
    for m in places:
        while at < len(base) and base[at][2] <= m.start():
            at += 1
        if at == len(base) or base[at][0] >= m.end():
            out.append(m)
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Places of key-like runs that touch no span of the patterns."""
    return [m.span() for m in _apart(_CANDIDATE.finditer(text), base)]


def redrawn(value: str) -> list[str]:
    """A new value of 16 to 40 characters from each of the alphabets; the same ones for the same value."""
    draw = random.Random(zlib.crc32(value.encode()))
    return ["".join(draw.choices(letters, k=draw.randint(16, 40))) for letters in ALPHABETS.values()]


def _samples(text: str, base: list, others: list) -> tuple[list[int], list[str]]:
    """Labelled windows of a text: findings as they stand, in other surroundings and with new values there, other
    candidates, now and then a word."""
    labels, shown = [], []
    for start, kind, end in base:
        value = _ASSIGN.match(text, start).start(2) if kind == 0 else start
        shown.append(windows(text, value, end))
        cut = (start * 7 + end) % max(1, len(text) - 80)
        before, after = text[cut : cut + 40] + " ", " " + text[cut + 40 : cut + 80]
        for other in (text[value:end], *redrawn(text[value:end])):
            shown.append(windows(before + other + after, len(before), len(before) + len(other)))
        labels += [1, 1, *range(2, 2 + len(ALPHABETS))]
    for start, end in others:
        shown.append(windows(text, start, end))
        labels.append(0)
    if zlib.crc32(text[:200].encode()) % 8 == 0 or base:
        free = _apart(_WORD.finditer(text), base)
        for m in free[:: max(1, len(free) // 3)][:3]:
            shown.append(windows(text, m.start(), m.end()))
            labels.append(0)
    return labels, shown


def _scanned(docs: DataFrame) -> DataFrame:
    """Per document: base spans, candidates with their windows, labelled windows."""
    names = [x.split()[0] for x in _FOUND.split(", ")]

    def scan(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                base = base_spans(text)
                others = candidates(text, base)
                counts = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((doc_id, *counts, [f"{KINDS[k]}:{s}:{e}" for s, k, e in base], [s for s, _ in others], [e for _, e in others], [windows(text, s, e) for s, e in others], *_samples(text, base, others)))
            yield {k: [r[i] for r in rows] for i, k in enumerate(names)}

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_columns(texts, scan, _FOUND, ROWS)


def _shards(each: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """half, shard, rows (labels, _place, samples; sorted) of all windows, written; sizes: how many windows a half has."""
    place, parts = F.xxhash64("samples"), [max(1, -(-sizes.get(i, 0) // SHARD)) for i in range(2)]
    dealt = each.withColumn("shard", F.pmod(F.xxhash64("samples", F.lit("shard")), F.when(F.col("half") == 0, parts[0]).otherwise(parts[1])))
    rows = dealt.groupBy("half", "shard").agg(F.array_sort(F.collect_list(F.struct("labels", place.alias("_place"), "samples"))).alias("rows"))
    return staged(rows.repartition(min(sum(parts), tasks(each.sparkSession)), "half", "shard"), "shards")


def _passed(shards: DataFrame, states: dict[int, np.ndarray], number: int, sizes: dict[int, tuple[int, int]]) -> dict[int, np.ndarray]:
    """The states of the halves' networks after one more pass: the mean of those of all shards; sizes: how many other
    windows and findings a half trains on."""

    def train(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for half, shard, rows in zip(batch["half"], batch["shard"], batch["rows"], strict=True):
                rows = [r for i, r in enumerate(rows) if i % 5]
                y = np.array([r["labels"] > 0 for r in rows], "i8")
                draw = np.random.default_rng(shard)
                order = [draw.permutation(len(rows)) for _ in range(number + 1)][-1]
                state = CharNet().resume(states[half]).train(codes([r["samples"] for r in rows]), y, balanced(y, *sizes[half]), order).state()
                yield {"half": [half] * len(state), "at": list(range(len(state))), "value": state.tolist()}

    each = map_columns(shards, train, "half int, at int, value double")
    # Decimals: their sum does not depend on the order.
    means = each.groupBy("half", "at").agg(F.avg(F.col("value").cast("decimal(30,18)")).cast("double").alias("value")).collect()
    out = {half: state.copy() for half, state in states.items()}
    for r in means:
        out[r.half][r.at] = r.value
    return out


def trained(scanned: DataFrame, recall: float = RECALL) -> list[CharNet | None]:
    """The calibrated networks, each trained on all windows of the half that the other judges; None where there are too
    few."""
    each = scanned.select(F.explode(F.arrays_zip("labels", "samples")).alias("x")).select("x.labels", "x.samples").distinct()
    # A network judges the half whose number it has, and learns from the other.
    each = each.withColumn("half", (1 - F.crc32(F.col("samples").cast("binary")) % 2).cast("int"))
    each = staged(each, "windows")
    counts = {tuple(r[:2]): r[2] for r in each.groupBy("half", F.col("labels") > 0).agg(F.count(F.lit(1))).collect()}
    sizes = {i: (counts.get((i, False), 0), counts.get((i, True), 0)) for i in range(2)}
    states = {i: CharNet().state() for i in range(2) if min(sizes[i]) >= LEAST}
    if not states:
        return [None, None]
    shards = _shards(each.where(F.col("half").isin(list(states))), {i: sum(sizes[i]) for i in states})
    trains = shards.select("half", F.posexplode("rows").alias("at", "x")).where("at % 5 <> 0").groupBy("half", F.col("x.labels") > 0).agg(F.count(F.lit(1)))
    counts = {tuple(r[:2]): r[2] for r in trains.collect()}
    for number in range(PASSES):
        states = _passed(shards, states, number, {i: (counts.get((i, False), 0), counts.get((i, True), 0)) for i in states})
    nets = {i: CharNet().resume(state) for i, state in states.items()}

    def judge(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for half, rows in zip(batch["half"], batch["rows"], strict=True):
                z = nets[half].logits(codes([r["samples"] for r in rows[::5]]))
                yield {"half": [half] * len(z), "label": [r["labels"] for r in rows[::5]], "step": np.floor(z / STEP).astype("i8").tolist()}

    held = map_columns(shards, judge, "half int, label int, step long").groupBy("half", "label", "step").agg(F.count(F.lit(1)).alias("n"))
    held = np.array(sorted(tuple(r) for r in held.collect()), "i8").reshape(-1, 4)
    for i, net in nets.items():
        _, label, step, n = held[held[:, 0] == i].T
        net.calibrate_counted(step * STEP, n, (label > 0).astype("i8"), recall, label, STEP)
    return [nets.get(i) for i in range(2)]


def _half(shown: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(w.encode()) % 2 for w in shown], "i8")


def _added(nets: list[CharNet | None], shown: list[str]) -> np.ndarray:
    """Which windows the network that was not trained on them takes for secrets."""
    x, half, found = codes(shown), _half(shown), np.zeros(len(shown), bool)
    for i, net in enumerate(nets):
        if net and (half == i).any():
            found[half == i] = net.score(x[half == i]) >= net.threshold
    return found


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans; spans are kind:start:end in code points."""
    scanned = staged(_scanned(docs), "secrets")
    nets = trained(scanned)

    def finish(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out = {k: batch[k] for k in ("doc_id", "n_assign", "n_access", "n_hex")} | {"base_sha256": [], "spans": []}
            keep = iter(_added(nets, [w for ws in batch["windows"] for w in ws]))
            for base, starts, ends in zip(batch["base"], batch["starts"], batch["ends"], strict=True):
                out["base_sha256"].append(hashlib.sha256(",".join(base).encode()).hexdigest())
                spans = base + [f"model:{s}:{e}" for s, e in zip(starts, ends, strict=True) if next(keep)]
                order = lambda x: (int(x.split(":")[1]), KINDS.index(x.split(":")[0]))
                out["spans"].append(",".join(sorted(spans, key=order)))
            yield out

    rows = scanned.select("doc_id", "n_assign", "n_access", "n_hex", "base", "starts", "ends", "windows")
    return map_columns(rows, finish, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def mask(text: str, nets: list[CharNet | None]) -> str:
    """The text with each secret, or run of overlapping ones, replaced by MASK."""
    base = base_spans(text)
    others = candidates(text, base)
    spans = sorted([(s, e) for s, _, e in base] + [x for x, keep in zip(others, _added(nets, [windows(text, *x) for x in others]), strict=True) if keep])
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every secret in `text` masked, and `n_chars`, where it is a column, counted anew for those."""
    nets = trained(staged(_scanned(docs).select("labels", "samples").where(F.size("labels") > 0), "secrets"))
    masked = text_column(docs.sparkSession, lambda x: None if x is None else mask(x, nets), "string")
    marked = docs.withColumn("__masked", masked("text"))
    if "n_chars" in docs.columns:
        changed = F.col("__masked") != F.col("text")
        marked = marked.withColumn("n_chars", F.when(changed, F.char_length("__masked")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return marked.withColumn("text", F.col("__masked")).select(docs.columns)
