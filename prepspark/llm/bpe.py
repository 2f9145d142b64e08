"""Byte-level BPE encoding and decoding on padded numpy matrices.

A text is split by the pattern; each piece is merged on its own.  A task merges only the
pieces that its worker has not seen yet (a bounded cache keeps the others), grouped by
length into padded matrices of token ids.  In each round every row merges its leftmost
pair of minimum rank, columns behind the merge move up by one, and rows that have no pair
left leave the matrix.  Ranks of pairs come from an open-addressing table in two numpy
arrays.  A piece of more than ``MATRIX_BYTES`` bytes (a long run of letters or blanks) is
merged in the same order with a heap, whose time grows with n log n instead of n^2.

There is no shuffle: rows are encoded where they are read.  The vocabulary (its size is
the model's, not the data's) is broadcast as the file's bytes.

Results for odd input: a null text is an empty one and has no tokens; null or repeated
ids are passed on row by row; extra columns are ignored; an empty table gives an empty
result.  Texts are encoded whole, and special tokens' strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fixed, query, slices, table

NONE = np.int32(2**31 - 1)
MATRIX_BYTES = 192
MATRIX_CELLS = 1 << 17
#: Pieces met lately; as many older ones are kept beside them.
CACHED_PIECES = 150_000
CHUNK_CHARS = 1 << 18


class PairTable:
    """(left id, right id) -> rank of the joined token, by linear probing."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [
            (ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        ]
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        keys = left << 32 | right
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        at, todo = self._home(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] < 0
            self.keys[at[todo[free]]] = keys[todo[free]]  # of keys that meet in a slot the last one stays
            placed = self.keys[at[todo]] == keys[todo]
            self.ranks[at[todo[placed]]] = rank[todo[placed]]
            todo = todo[~placed]
            at[todo] = at[todo] + 1 & (1 << self.bits) - 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = self._home(keys)
        found = self.keys[at]
        out = np.where((found == keys) & (right >= 0), self.ranks[at], NONE)
        todo = np.nonzero((found != keys) & (found >= 0) & (right >= 0))[0]
        while len(todo):
            at[todo] = at[todo] + 1 & (1 << self.bits) - 1
            found = self.keys[at[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.ranks[at[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out


def read_ranks(vocabulary: bytes) -> dict[bytes, int]:
    """Token bytes -> rank, from a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}


def decode(tokens: dict[int, bytes], ids: bytes) -> bytes:
    """The bytes that the ids stand for."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Bpe:
    """Encoder of one vocabulary, with a cache of pieces."""

    def __init__(self, vocabulary: bytes, pattern: str):
        self.ranks = read_ranks(vocabulary)
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(self.ranks)
        # \s of the rank files' library is the Unicode property, without the separators U+001C to U+001F
        self.pieces = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.forget()

    def forget(self) -> None:
        """Empty the cache of pieces: what was met lately, and before that."""
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge_matrix(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian uint32) of words of about one length."""
        width = max(map(len, words))
        flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        length = np.array([len(w) for w in words])
        ids = np.where(np.arange(width) < length[:, None], self.first[flat], -1)
        rank = self._ranks(ids)
        row, done = np.arange(len(words)), [b""] * len(words)
        while len(row):
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), np.int64)
            value = rank[np.arange(len(row)), best] if rank.shape[1] else np.full(len(row), NONE)
            out = value == NONE
            if out.any():
                blob, step = ids[out].astype("<u4").tobytes(), 4 * ids.shape[1]
                for i, (r, n) in enumerate(zip(row[out].tolist(), length[out].tolist())):
                    done[r] = blob[i * step : i * step + 4 * n]
                ids, rank, row, length, best, value = (x[~out] for x in (ids, rank, row, length, best, value))
                if not len(row):
                    break
            n, width = np.arange(len(row)), ids.shape[1]
            ids[n, best] = value
            columns = np.arange(width - 1)
            ids = np.take_along_axis(ids, columns + (columns > best[:, None]), axis=1)
            columns = np.arange(width - 2)
            rank = np.take_along_axis(rank, columns + (columns >= best[:, None]), axis=1)
            length = length - 1
            for side in (best - 1, best):  # only the merge's two neighbours changed
                near = (side >= 0) & (side < width - 2)
                if near.any():
                    rank[n[near], side[near]] = self.pairs.find(ids[n[near], side[near]], ids[n[near], side[near] + 1])
            keep = max(1, int(length.max()))
            ids, rank = ids[:, :keep], rank[:, : keep - 1]
        return done

    def _ranks(self, ids: np.ndarray) -> np.ndarray:
        return self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), ids.shape[1] - 1)

    def merge_long(self, word: bytes) -> bytes:
        """The same order of merges for one long word, by a heap of (rank, place)."""
        ids = self.first[np.frombuffer(word, np.uint8)]
        heap = [(int(r), i) for i, r in enumerate(self.pairs.find(ids[:-1], ids[1:])) if r != NONE]
        heapq.heapify(heap)
        ids, n = ids.tolist(), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        joined = self.pair_dict()
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or joined.get((ids[i], ids[j])) != r:
                continue  # one of the two was merged since
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (q := joined.get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (q, a))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def pair_dict(self) -> dict[tuple[int, int], int]:
        if not hasattr(self, "_pair_dict"):
            at = np.nonzero(self.pairs.keys >= 0)[0]
            keys = self.pairs.keys[at]
            self._pair_dict = dict(zip(zip((keys >> 32).tolist(), (keys & 0xFFFFFFFF).tolist()), self.pairs.ranks[at].tolist()))
        return self._pair_dict

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of new pieces into the cache."""
        if len(self.cache) + len(pieces) > CACHED_PIECES:
            self.cache, self.older = {}, self.cache
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            if (known := self.older.get(p)) is not None:
                self.cache[p] = known
                continue
            word = p.encode("utf-8", "surrogatepass")
            if (whole := self.ranks.get(word)) is not None:
                self.cache[p] = whole.to_bytes(4, "little")
            elif len(word) > MATRIX_BYTES:
                self.cache[p] = self.merge_long(word)
            else:
                groups.setdefault((len(word) + 3) // 4, []).append((p, word))
        for size, group in groups.items():
            step = max(1, MATRIX_CELLS // (4 * size))
            for i in range(0, len(group), step):
                part = group[i : i + step]
                self.cache.update(zip((p for p, _ in part), self.merge_matrix([w for _, w in part])))

    def encode_batch(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text; pieces of about ``CHUNK_CHARS`` characters are held at a time."""
        chunk, chars = [], 0
        for i, text in enumerate(texts):
            chunk.append(self.pieces.findall(text) if text else [])
            chars += len(text or "")
            if chars >= CHUNK_CHARS or i == len(texts) - 1:
                every = set().union(*chunk)
                for _ in range(2):  # once more if the cache was put aside for the new pieces
                    if new := every.difference(self.cache):
                        self.learn(new)
                for pieces in chunk:
                    yield b"".join(map(self.cache.__getitem__, pieces))
                chunk, chars = [], 0


def _bpe(vocabulary: bytes, pattern: str) -> Bpe:
    """The worker's encoder; its tables are kept between tasks, its cache of pieces is not."""
    return fixed(("bpe", hashlib.sha256(vocabulary + pattern.encode()).digest()), lambda: Bpe(vocabulary, pattern))


def _shipped(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_tokens``, ``ids`` (binary: little-endian unsigned 32-bit integers) of each row.

    ``vocabulary`` is the path of a rank file (base64 token and rank a line) on the driver.
    """
    file = _shipped(docs, vocabulary)
    source = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        bpe = _bpe(file.value, pattern)
        try:
            for part in slices(batches):
                ids = list(bpe.encode_batch(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    [id_col, "n_tokens", "ids"],
                )
        finally:
            bpe.forget()

    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids binary")


def decode_documents(encoded: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """``encoded`` (id, ``n_tokens``, ``ids``) with ``decoded``, the bytes that the ids stand for."""
    file = _shipped(encoded, vocabulary)
    source = encoded.select(id_col, "n_tokens", "ids")

    def run(batches):
        tokens = _bpe(file.value, pattern).tokens
        for part in slices(batches):
            out = [decode(tokens, x) for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], [id_col, "n_tokens", "ids", "decoded"])

    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids binary, decoded binary")


def token_digests(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode the ids, and return id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``."""
    if vocabulary is None or pattern is None:
        import public_tokenizers

        vocabulary = vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    file = _shipped(docs, vocabulary)
    source = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"))

    def run(batches):  # ids and bytes stay in the worker; only their digests leave it
        bpe = _bpe(file.value, pattern)
        try:
            for part in slices(batches):
                counts, ids_sha, decoded_sha = [], [], []
                for ids in bpe.encode_batch(part.column(1).to_pylist()):
                    counts.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    decoded_sha.append(hashlib.sha256(decode(bpe.tokens, ids)).hexdigest())
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            bpe.forget()

    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


@query("op6_byte_bpe")
def op6_byte_bpe(spark, sf_dir):
    return token_digests(table(spark, sf_dir, "documents"))
