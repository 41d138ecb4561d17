"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions, each with its own context tree over the bytes before it. A node
(the last d bytes, and the bits of the byte so far) estimates its bit with the Krichevsky-Trofimov
rule; a tree mixes the estimates of all depths from 0 to `DEPTH` with the weights that
context-tree weighting gives them: P_w = (P_e + product of the children's P_w) / 2 at inner nodes,
P_w = P_e at the deepest. The model is static: counts and weights come from the whole training part,
and the chance of a bit is the mixture along its context's path. A text is its bytes with A-Z in
lower case, then an end mark; before it stand end marks.

A window is a byte with its context in one integer, most recent byte first, so sorted windows are
the trie. The corpus is cut into blocks of documents by hash. A block sends its distinct windows
and words, with their training counts, split by the last two bytes of the context (words by hash)
into buckets. A bucket holds whole subtrees from depth 2 on: it adds up the counts of all blocks,
builds the trees bottom up and returns to each block the log chance of its windows; blocks add them
up per document. Depths 0 and 1, at most 257 contexts of 255 nodes, pass through the driver. The
base score takes the same way with words in place of windows.

What is exchanged grows with the distinct windows of each block. A block is about `BLOCK_BYTES` of
text; a task holds one block, or one bucket.

Nulls: a null text is an empty one: its only token is the end. A null id hashes as an empty text.
Without any training row all counts are 0 and every bit has chance 1/2. Repeated rows are scored and
counted each. An empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bumpwise.llm.common import fold, stored, table
from bumpwise.llm.texts import lowered_texts

DEPTH = 5
FOLDS, HELD_OUT = 5, 1
MARK = 0xFF  # no byte of UTF-8
BLOCK_BYTES = 24 << 20
BUCKET_BYTES = 16 << 20
_CHUNK = 1 << 16  # positions that are sorted together: 48 bits of window and 16 of place
_END = np.uint64(xxhash.xxh3_64_intdigest(b""))  # no word is empty
_SMALL = 1 << 12
_HALVES = np.concatenate(([0.0], np.cumsum(np.log(np.arange(_SMALL) + 0.5)))) + math.lgamma(0.5)
_WHOLES = np.concatenate(([0.0, 0.0], np.cumsum(np.log(np.arange(1, _SMALL)))))


def _log_gamma(count: np.ndarray, half: bool) -> np.ndarray:
    """log gamma(count + 1/2) or log gamma(count + 1), counts being whole numbers."""
    small = np.minimum(count, _SMALL - 1).astype(np.int64)
    listed = _HALVES[small] if half else _WHOLES[small + 1]
    x = np.maximum(count, _SMALL - 1) + (0.5 if half else 1.0)
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x)
    return np.where(count < _SMALL, listed, series)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_gamma(zeros, True) + _log_gamma(ones, True) - _log_gamma(zeros + ones, False) - math.log(math.pi)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys, and the sums of the values per key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    if not len(keys):
        return (keys, *values)
    return (keys[starts], *[np.add.reduceat(v[order], starts) for v in values])


@dataclass(frozen=True)
class Nodes:
    """The nodes of one depth and bit: sorted keys, counts, and the weight of their own estimate."""

    keys: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weight: np.ndarray


def _shorter(keys: np.ndarray) -> np.ndarray:
    """Keys (context, low byte) without the oldest byte of the context."""
    return ((keys >> np.uint64(16)) << np.uint64(8)) | (keys & np.uint64(255))


def _node_keys(windows: np.ndarray, bit: int) -> np.ndarray:
    byte = windows & np.uint64(255)
    return ((windows >> np.uint64(8)) << np.uint64(8)) | np.uint64(1 << bit) | (byte >> np.uint64(8 - bit))


def build_tree(
    windows: np.ndarray, counts: np.ndarray, depth: int, least: int
) -> tuple[dict[tuple[int, int], Nodes], list[tuple[np.ndarray, ...]]]:
    """Nodes by (depth, bit) from `depth` up to `least`, and what their parents need from them:
    per bit (parent keys, zeros, ones, sum of log P_w)."""
    nodes: dict[tuple[int, int], Nodes] = {}
    below: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(depth, least - 1, -1):
        if at < depth:
            windows, counts = _summed(_shorter(windows), counts)
        now = []
        for bit in range(8):
            ones = counts * ((windows >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.float64)
            keys, total, ones = _summed(_node_keys(windows, bit), counts, ones)
            own = log_estimate(total - ones, ones)
            if at == depth:
                weighted, weight = own, np.ones(len(keys))
            else:
                _, split = _summed(_shorter(below[bit][0]), below[bit][1])
                weighted = np.logaddexp(own, split) - math.log(2)
                weight = 1 / (1 + np.exp(np.clip(split - own, -700, 700)))
            nodes[at, bit] = Nodes(keys, total - ones, ones, weight)
            now.append((keys, weighted))
        below = now
    up = []
    for bit in range(8):
        level = nodes[least, bit]
        up.append(_summed(_shorter(level.keys), level.zeros, level.ones, below[bit][1]))
    return nodes, up


@dataclass(frozen=True)
class Top:
    """Depths 1 and 0 as arrays by key: chance of a one by the own estimate, and its weight."""

    chance: tuple[np.ndarray, np.ndarray]
    weight: tuple[np.ndarray, np.ndarray]


def build_top(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, split: np.ndarray) -> Top:
    """From the depth-1 nodes with the sums of their children's log P_w."""
    chances, weights = [], []
    for _ in range(2):
        own = log_estimate(zeros, ones)
        size = 1 << 16 if not chances else 1 << 8
        chance, weight = np.full(size, 0.5), np.ones(size)
        chance[keys] = (ones + 0.5) / (zeros + ones + 1)
        weight[keys] = 1 / (1 + np.exp(np.clip(split - own, -700, 700)))
        chances.append(chance)
        weights.append(weight)
        weighted = np.logaddexp(own, split) - math.log(2)
        keys, zeros, ones, split = _summed(keys & 255, zeros, ones, weighted)
    return Top((chances[1], chances[0]), (weights[1], weights[0]))


def log_chances(
    nodes: dict[tuple[int, int], Nodes], top: Top, windows: np.ndarray, depth: int, least: int
) -> np.ndarray:
    """log10 of the mixture's chance of each (sorted) window's byte in its context."""
    total = np.zeros(len(windows))
    for bit in range(8):
        one = ((windows >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        mixed, keys = np.full(len(windows), 0.5), _node_keys(windows, bit)
        for at in range(depth, least - 1, -1):
            if at < depth:
                keys = _shorter(keys)
            level = nodes[at, bit]
            if not len(level.keys):
                continue
            place = np.minimum(np.searchsorted(level.keys, keys), len(level.keys) - 1)
            seen = level.keys[place] == keys
            zeros, ones, weight = level.zeros[place], level.ones[place], level.weight[place]
            own = (ones + 0.5) / (zeros + ones + 1)
            mixed = np.where(seen, weight * own + (1 - weight) * mixed, 0.5)
        for at in (1, 0):
            keys = _shorter(keys)
            index = keys.astype(np.int64)
            own, weight = top.chance[at][index], top.weight[at][index]
            mixed = weight * own + (1 - weight) * mixed
        total += np.log10(np.where(one, mixed, 1 - mixed))
    return total


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers, compressed byte plane by byte plane; sorted ones as differences."""
    values = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


class _Texts:
    """The byte windows and the words of some texts, chunk by chunk."""

    def __init__(self, texts: pa.Array) -> None:
        self.lowered = lowered_texts(texts)

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(sorted distinct windows, start of each in `texts`, text of each position by window)."""
        lowered = self.lowered
        offsets = lowered.buffers()[1]
        at = np.frombuffer(offsets, np.int64)[lowered.offset : lowered.offset + len(lowered) + 1]
        data = np.frombuffer(lowered.buffers()[2], np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.empty(0, np.uint8)
        lengths = np.diff(at)
        # an end mark after each text, and as many before each as a context holds
        spaced = np.full(len(data) + (DEPTH + 1) * len(lengths), MARK, np.uint8)
        starts = np.cumsum(lengths + DEPTH + 1) - (lengths + DEPTH + 1) + DEPTH
        place = np.arange(len(data)) + np.repeat(starts - (at[:-1] - at[0]), lengths)
        spaced[place] = data
        owner = np.repeat(np.arange(len(lengths)), lengths + DEPTH + 1)
        inside = np.ones(len(spaced), bool)
        for step in range(DEPTH):
            inside[starts - 1 - step] = False
        scored = np.flatnonzero(inside)
        for first in range(0, len(scored), _CHUNK):
            some = scored[first : first + _CHUNK]
            window = np.zeros(len(some), np.uint64)
            for back in range(1, DEPTH + 1):
                window = (window << np.uint64(8)) | spaced[some - back]
            window = (window << np.uint64(8)) | spaced[some]
            packed = np.sort((window << np.uint64(16)) | np.arange(len(some), dtype=np.uint64))
            window, order = packed >> np.uint64(16), (packed & np.uint64(0xFFFF)).astype(np.int64)
            begin = np.flatnonzero(np.concatenate(([True], window[1:] != window[:-1])))
            yield window[begin], begin, owner[some[order]]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes of the distinct words, word of each token, text of each token)."""
        split = pc.ascii_split_whitespace(self.lowered)
        flat, offsets = split.flatten(), split.offsets.to_numpy()
        owner = np.repeat(np.arange(len(split)), np.diff(offsets))
        real = pc.not_equal(flat, "")
        owner, coded = owner[real.to_numpy(zero_copy_only=False)], flat.filter(real).dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        known = [xxhash.xxh3_64_intdigest(word) for word in coded.dictionary.to_pylist()]
        hashes = np.array([*known, int(_END)], np.uint64)
        tokens = np.concatenate((coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.full(len(split), len(known))))
        return hashes, tokens, np.concatenate((owner, np.arange(len(split))))


def _slices(texts: pa.ChunkedArray, most: int = 1 << 21) -> Iterator[tuple[int, pa.Array]]:
    """(first row, some whole texts) of at most about `most` bytes."""
    row = 0
    for chunk in texts.chunks:
        lengths = pc.fill_null(pc.binary_length(chunk), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(lengths) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(chunk)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if end > start:
                yield row + start, chunk.slice(start, end - start)
        row += len(chunk)


def _buckets(buckets: int) -> np.ndarray:
    """The bucket of each pair of last bytes."""
    pairs = np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((pairs >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _ask(buckets: int) -> Callable:
    """A block's distinct windows and words with their training counts, a row per bucket."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return _summed(*(np.concatenate(column) for column in zip(*parts, strict=True)))

    def work(block: pa.Table) -> pa.Table:
        windows: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.uint64), np.empty(0))]
        words: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.uint64), np.empty(0))]
        taught_all = block.column("_taught").to_numpy()
        for row, texts in _slices(block.column("_text")):
            taught = taught_all[row : row + len(texts)].astype(np.float64)
            some = _Texts(texts)
            for window, begin, owner in some.windows():
                windows.append((window, np.add.reduceat(taught[owner], begin)))
            hashes, tokens, owner = some.words()
            words.append((hashes, np.bincount(tokens, taught[owner], minlength=len(hashes))))
            if sum(len(part[0]) for part in windows) > 1 << 21:
                windows = [merged(windows)]
            if sum(len(part[0]) for part in words) > 1 << 20:
                words = [merged(words)]
        (window, times), (word, uses) = merged(windows), merged(words)
        of_window = _buckets(buckets)[(window >> np.uint64(8 * DEPTH - 8)).astype(np.int64)]
        of_word = (word % np.uint64(buckets)).astype(np.int64)
        rows = []
        for bucket in range(buckets):
            a, b = of_window == bucket, of_word == bucket
            if a.any() or b.any():
                rows.append((bucket, _pack(window[a]), _pack(np.cumsum(times[a])), _pack(word[b]), _pack(np.cumsum(uses[b]))))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.table(
            {
                "block": pa.array([block.column("_block")[0].as_py()] * len(rows), pa.int32()),
                "bucket": pa.array(columns[0], pa.int32()),
                "windows": pa.array(columns[1], pa.binary()),
                "times": pa.array(columns[2], pa.binary()),
                "words": pa.array(columns[3], pa.binary()),
                "uses": pa.array(columns[4], pa.binary()),
            }
        )

    return work


def _counts(blobs: list[bytes]) -> np.ndarray:
    """Counts, packed as their running sums."""
    return np.concatenate([np.diff(_unpack(b), prepend=np.uint64(0)) for b in blobs]).astype(np.float64)


def _gathered(bucket: pa.Table, keys: str, counts: str) -> tuple[np.ndarray, np.ndarray]:
    found = [_unpack(b) for b in bucket.column(keys).to_pylist()]
    return _summed(np.concatenate(found), _counts(bucket.column(counts).to_pylist()))


def _survey(bucket: pa.Table) -> pa.Table:
    """Rows for the driver: (0, depth-1 node, zeros, ones, sum) and (1, 0, tokens, vocabulary, 0)."""
    windows, times = _gathered(bucket, "windows", "times")
    seen = times > 0
    _, up = build_tree(windows[seen], times[seen], DEPTH, 2)
    _, uses = _gathered(bucket, "words", "uses")
    parts = [pd.DataFrame({"kind": 0, "key": k.astype(np.int64), "x": z, "y": o, "s": s}) for k, z, o, s in up]
    parts.append(pd.DataFrame({"kind": [1], "key": [0], "x": [uses.sum()], "y": [float((uses > 0).sum())], "s": [0.0]}))
    frame = pd.concat(parts, ignore_index=True).astype({"kind": "int32", "key": "int64"})
    return pa.Table.from_pandas(frame, preserve_index=False)


def _reply(top: Top, tokens: float, vocabulary: float) -> Callable:
    """The log chances of the windows and words that each block asked for."""

    def work(bucket: pa.Table) -> pa.Table:
        windows, times = _gathered(bucket, "windows", "times")
        seen = times > 0
        nodes, _ = build_tree(windows[seen], times[seen], DEPTH, 2)
        chances = log_chances(nodes, top, windows, DEPTH, 2).astype(np.float32)
        words, uses = _gathered(bucket, "words", "uses")
        rows = []
        for block, asked, spoken in zip(
            bucket.column("block").to_pylist(), bucket.column("windows").to_pylist(), bucket.column("words").to_pylist(), strict=True
        ):
            mine = np.searchsorted(windows, _unpack(asked))
            used = uses[np.searchsorted(words, _unpack(spoken))].astype(np.int64)
            rows.append((block, asked, chances[mine].tobytes(), spoken, used.tobytes()))
        columns = list(zip(*rows, strict=True))
        return pa.table(
            {
                "_block": pa.array(columns[0], pa.int32()),
                "windows": pa.array(columns[1], pa.binary()),
                "chances": pa.array(columns[2], pa.binary()),
                "words": pa.array(columns[3], pa.binary()),
                "uses": pa.array(columns[4], pa.binary()),
            }
        )

    return work


def _add_up(keep: list[str], total: float, vocabulary: float) -> Callable:
    """Scores of a block's documents from the replies of the buckets."""

    def work(block: pa.Table, replies: pa.Table) -> pa.Table:
        joined = lambda name, kind: np.frombuffer(b"".join(replies.column(name).to_pylist()), kind)
        unpacked = lambda name: np.concatenate([np.empty(0, np.uint64), *map(_unpack, replies.column(name).to_pylist())])
        window, chance = unpacked("windows"), joined("chances", np.float32)
        order = np.argsort(window)
        window, chance = window[order], chance[order].astype(np.float64)
        word, uses = unpacked("words"), joined("uses", np.int64)
        order = np.argsort(word)
        word, uses = word[order], uses[order]
        n = block.num_rows
        score, base = np.zeros(n), np.zeros(n)
        n_tokens, n_known, n_bytes = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for row, texts in _slices(block.column("_text")):
            some, here = _Texts(texts), slice(row, row + len(texts))
            for found, begin, owner in some.windows():
                each = np.repeat(chance[np.searchsorted(window, found)], np.diff(np.append(begin, len(owner))))
                score[here] += np.bincount(owner, each, minlength=len(texts))
                n_bytes[here] += np.bincount(owner, minlength=len(texts))
            hashes, tokens, owner = some.words()
            used = uses[np.searchsorted(word, hashes)]
            worth = np.log10((used + 0.5) / (total + 0.5 * (vocabulary + 1)))
            base[here] = np.bincount(owner, worth[tokens], minlength=len(texts))
            n_tokens[here] = np.bincount(owner, minlength=len(texts))
            n_known[here] = np.bincount(owner, used[tokens] > 0, minlength=len(texts)).astype(np.int64)
        columns = {name: block.column(name) for name in keep}
        columns |= {
            "n_tokens": pa.array(n_tokens), "n_known": pa.array(n_known),
            "train_tokens": pa.array(np.full(n, int(total))), "base_score": pa.array(base), "score": pa.array(score),
            "n_bytes": pa.array(n_bytes), "bits_per_byte": pa.array(-score * math.log2(10) / np.maximum(n_bytes, 1)),
        }
        return pa.table(columns)

    return work


def score(documents: DataFrame, taught: Column, keep: dict[str, Column]) -> DataFrame:
    """`keep` (name -> expression) with the counts and scores of each row's text.

    `bits_per_byte` is the code length per byte, over the text's bytes and its end mark (`n_bytes`).
    `taught` says which rows the model learns from.
    """
    size = documents.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    # fewer buckets than blocks at scale, so that what a block sends to a bucket stays worth a row
    buckets = max(8, math.ceil((size / BUCKET_BYTES) ** 0.75))
    # where a row lies in the input spreads rows that are equal in all columns
    spread = F.xxhash64("doc_id", "text", F.input_file_name(), F.input_file_block_start())
    rows = documents.select(
        F.coalesce("text", F.lit("")).alias("_text"),
        F.pmod(spread, F.lit(blocks)).cast("int").alias("_block"),
        F.coalesce(taught, F.lit(False)).alias("_taught"),
        *[c.alias(n) for n, c in keep.items()],
    )
    asked = stored(
        rows.select("_text", "_block", "_taught")
        .groupBy("_block")
        .applyInArrow(_ask(buckets), "block int, bucket int, windows binary, times binary, words binary, uses binary"),
        "ctw-asked",
    )
    survey = (
        asked.groupBy("bucket")
        .applyInArrow(_survey, "kind int, key long, x double, y double, s double")
        .groupBy("kind", "key")
        .agg(F.sum("x").alias("x"), F.sum("y").alias("y"), F.sum("s").alias("s"))
        .toPandas()
        .sort_values(["kind", "key"])
    )
    nodes, tokens = survey[survey["kind"] == 0], survey[survey["kind"] == 1]
    total, vocabulary = float(tokens["x"].sum()), float(tokens["y"].sum())
    top = build_top(*[nodes[c].to_numpy() for c in ("key", "x", "y", "s")])
    replies = asked.groupBy("bucket").applyInArrow(
        _reply(top, total, vocabulary), "_block int, windows binary, chances binary, words binary, uses binary"
    )
    shape = "".join(f"`{n}` {t}, " for n, t in rows.dtypes if n in keep)
    return (
        rows.groupBy("_block")
        .cogroup(replies.groupBy("_block"))
        .applyInArrow(
            _add_up(list(keep), total, vocabulary),
            f"{shape}n_tokens long, n_known long, train_tokens long, base_score double, score double, "
            "n_bytes long, bits_per_byte double",
        )
    )


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", FOLDS) == HELD_OUT
    return score(
        table(spark, sf_dir, "documents"), ~held_out, {"doc_id": F.col("doc_id"), "held_out": held_out}
    )
