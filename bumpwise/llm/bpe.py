"""Byte-level BPE with a segment tree over the byte positions.

A text is cut by the tokenizer's pattern; each piece is encoded by itself. A segment tree over the
piece's positions stores, at each node, the smallest pair rank below it and the leftmost position
that has it. A merge joins the pair at the root's position, takes the right-hand position out, and
updates three leaves: the merged one, its live left neighbour and the removed one, each in a
logarithmic number of steps. So a piece of n bytes takes O(n log n), however long it is.

Pieces repeat, so each task keeps a bounded table of the pieces it has met; short new pieces of a
batch are encoded together, the same tree steps done for all of them at once as array operations.
Ranks come from a file whose path is a parameter; the driver reads it once and ships the table,
whose size is that of the vocabulary. No table is trained here.

Nulls: a null text encodes as the empty text, to no ids. Characters that UTF-8 cannot hold are
replaced, as decoding would. Repeated rows are encoded each. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bumpwise.llm.common import table

NONE = np.int64(1) << 40  # no pair, or a pair without a rank
_TOGETHER_BYTES = 64  # pieces up to this length are encoded together
_KNOWN_PIECES = 200_000
_BATCH_ROWS = 512


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class Vocabulary:
    """Ranks by token, and by the pair of ids that makes a token.

    A pair of ids has the rank of the token that their bytes spell, so every split of a token into
    two tokens is listed, not only the one it was trained by.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.ranks = ranks
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        self.pairs = pairs
        self.size = max(self.tokens, default=0) + 1
        keys = np.array([a * self.size + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array(list(pairs.values()), np.int64)[order]
        missing = [byte for byte in range(256) if bytes([byte]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing[:10]}")
        self.bytes = np.array([ranks[bytes([byte])] for byte in range(256)], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where the pair makes no token or an id is -1."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, wanted), len(self.pair_keys) - 1)
        good = (left >= 0) & (right >= 0) & (self.pair_keys[at] == wanted)
        return np.where(good, self.pair_ranks[at], NONE)


def encode_piece(piece: bytes, vocabulary: Vocabulary) -> list[int]:
    """Ids of one piece, by a segment tree in a list: node i has the children 2i and 2i + 1."""
    whole = vocabulary.ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    ids: list[int] = vocabulary.bytes[np.frombuffer(piece, np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    width = 1 << max(0, n - 1).bit_length()
    none, shift = int(NONE), 32
    nothing = none << shift
    # a node is rank << 32 | position: the smaller number has the smaller rank, then is further left
    tree = [nothing] * (2 * width)
    pairs = vocabulary.pairs
    for i in range(n - 1):
        rank = pairs.get((ids[i], ids[i + 1]))
        if rank is not None:
            tree[width + i] = rank << shift | i
    for node in range(width - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left <= right else right
    while tree[1] < nothing:
        rank, at = tree[1] >> shift, tree[1] & 0xFFFFFFFF
        gone = after[at]
        ids[at], after[at] = rank, after[gone]
        if after[gone] < n:
            before[after[gone]] = at
        ids[gone] = -1
        for place in (gone, at, before[at]):
            if place < 0:
                continue
            value = nothing
            if place != gone and after[place] < n:
                rank = pairs.get((ids[place], ids[after[place]]))
                if rank is not None:
                    value = rank << shift | place
            node = width + place
            tree[node] = value
            node >>= 1
            while node:
                left, right = tree[2 * node], tree[2 * node + 1]
                best = left if left <= right else right
                if tree[node] == best:
                    break
                tree[node] = best
                node >>= 1
    return [token for token in ids if token >= 0]


def _encode_equal(pieces: list[bytes], width: int, vocabulary: Vocabulary) -> list[np.ndarray]:
    """Ids of pieces of at most `width` (a power of two) bytes; all their trees step together."""
    count = len(pieces)
    lengths = np.fromiter(map(len, pieces), np.int64, count)
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    row = np.repeat(np.arange(count), lengths)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    ids = np.full((count, width), -1, np.int64)
    ids[row, column] = vocabulary.bytes[flat]
    after = np.broadcast_to(np.arange(1, width + 1), (count, width)).copy()
    before = np.broadcast_to(np.arange(-1, width - 1), (count, width)).copy()
    tree = np.full((count, 2 * width), NONE * width, np.int64)  # rank * width + position
    ranks = vocabulary.rank(ids[:, :-1], ids[:, 1:])
    tree[:, width : 2 * width - 1] = ranks * width + np.arange(width - 1)
    half = width // 2
    while half:
        tree[:, half : 2 * half] = np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2])
        half //= 2
    live = np.flatnonzero(tree[:, 1] < NONE * width)
    while len(live):
        rank, at = np.divmod(tree[live, 1], width)
        gone = after[live, at]
        beyond = after[live, gone]
        ids[live, at], ids[live, gone] = rank, -1
        after[live, at] = beyond
        has = beyond < width
        before[live[has], beyond[has]] = at[has]
        left = before[live, at]
        following = np.where(has, ids[live, np.minimum(beyond, width - 1)], -1)
        leading = np.where(left >= 0, ids[live, np.maximum(left, 0)], -1)
        merged = vocabulary.rank(rank, following) * width + at
        earlier = vocabulary.rank(leading, rank) * width + left
        for place, value, which in (
            (gone, np.full(len(live), NONE * width), slice(None)),
            (at, merged, slice(None)),
            (left, earlier, left >= 0),
        ):
            rows, node = live[which], width + place[which]
            tree[rows, node] = value[which]
            step = width
            while step > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                step >>= 1
        live = live[tree[live, 1] < NONE * width]
    used = ids >= 0
    return np.split(ids[used], np.cumsum(used.sum(axis=1))[:-1])


def encode_pieces(pieces: list[bytes], vocabulary: Vocabulary) -> list[np.ndarray]:
    """Ids of each piece; pieces are grouped by the width of their tree."""
    results: list[np.ndarray] = [np.empty(0, np.int64)] * len(pieces)
    groups: dict[int, list[int]] = {}
    for place, piece in enumerate(pieces):
        whole = vocabulary.ranks.get(piece)
        if whole is not None:
            results[place] = np.array([whole], np.int64)
        elif len(piece) > _TOGETHER_BYTES:
            results[place] = np.array(encode_piece(piece, vocabulary), np.int64)
        elif piece:
            groups.setdefault(1 << (len(piece) - 1).bit_length(), []).append(place)
    for width, places in groups.items():
        for start in range(0, len(places), 20_000):
            some = places[start : start + 20_000]
            for place, ids in zip(some, _encode_equal([pieces[i] for i in some], width, vocabulary), strict=True):
                results[place] = ids
    return results


def encoder(ranks: dict[bytes, int], pattern: str) -> Callable[[list[str | None]], list[np.ndarray]]:
    """A function from texts to their ids (unsigned 32 bits); it keeps a bounded table of the pieces it has met."""
    vocabulary, cut = Vocabulary(ranks), regex.compile(pattern)
    known: dict[str, bytes] = {}  # ids as little-endian unsigned 32-bit integers

    def encode(texts: list[str | None]) -> list[np.ndarray]:
        pieces = [cut.findall(text) if text else [] for text in texts]
        missing = list(set().union(*pieces).difference(known))
        if len(known) + len(missing) > _KNOWN_PIECES:
            known.clear()
            missing = list(set().union(*pieces))
        new = encode_pieces([piece.encode("utf-8", "replace") for piece in missing], vocabulary)
        known.update((piece, ids.astype("<u4").tobytes()) for piece, ids in zip(missing, new, strict=True))
        return [np.frombuffer(b"".join(map(known.__getitem__, text)), "<u4") for text in pieces]

    return encode


def decoder(ranks: dict[bytes, int]) -> Callable[[np.ndarray], bytes]:
    """A function from ids to bytes."""
    size = max(ranks.values(), default=0) + 1
    tokens = [b""] * size
    for token, rank in ranks.items():
        tokens[rank] = token
    return lambda ids: b"".join(map(tokens.__getitem__, ids.tolist()))


def _work(ranks: dict[bytes, int], pattern: str, keep: list[str], texts_back: bool) -> Callable:
    made: list = []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.extend((encoder(ranks, pattern), decoder(ranks)))
        encode, decode = made
        for whole in batches:
            for start in range(0, whole.num_rows, _BATCH_ROWS):
                batch = whole.slice(start, _BATCH_ROWS)
                ids = encode(batch.column("_text").to_pylist())
                yield _answer(batch, ids, [decode(x) for x in ids], keep, texts_back)

    return work


def _answer(batch, ids, texts, keep, texts_back) -> pa.RecordBatch:
    columns = {name: batch.column(name) for name in keep}
    if texts_back:
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int64)
        values = pa.array(np.concatenate([np.empty(0, "<u4"), *ids]).astype(np.int64))
        columns["ids"] = pa.LargeListArray.from_arrays(pa.array(ends), values).cast(pa.list_(pa.int64()))
        columns["decoded"] = pa.array(texts, pa.binary())
    columns["n_tokens"] = pa.array(list(map(len, ids)), pa.int64())
    columns["ids_sha256"] = pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids])
    columns["decoded_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in texts])
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def encode_documents(
    documents: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    keep: dict[str, Column],
    texts_back: bool = False,
) -> DataFrame:
    """`keep` (name -> expression) with `n_tokens, ids_sha256, decoded_sha256` of each row's text.

    `texts_back` adds the `ids` themselves and the `decoded` bytes.
    """
    rows = documents.select(F.col("text").alias("_text"), *[c.alias(n) for n, c in keep.items()])
    shape = "".join(f"`{n}` {t}, " for n, t in rows.dtypes if n != "_text")
    if texts_back:
        shape += "ids array<long>, decoded binary, "
    return rows.mapInArrow(
        _work(ranks, pattern, list(keep), texts_back),
        f"{shape}n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[dict[bytes, int], str]:
    """(ranks, pattern) of one of the installed public tokenizers."""
    import public_tokenizers

    return read_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_vocabulary()
    return encode_documents(table(spark, sf_dir, "documents"), ranks, pattern, {"doc_id": F.col("doc_id")})
