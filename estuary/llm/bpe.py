"""Operator 2: BPE encoding and decoding in batched numpy merge rounds.

The symbols of many words lie in one flat array.  In each round every word
finds the lowest-rank pair among its neighbours (ranks come from a binary
search over the sorted pair keys) and merges all its occurrences from left to
right; words without a pair left leave the array.  Merging all occurrences at
once equals merging them one by one, since a pair made by a merge always has
a later rank.

Defined results: null and empty texts have no ids and decode to the empty
text; repeated rows are encoded as often as they occur; special tokens in a
text become their ids; only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.llm.common import list_column, slices, table, texts_of
from estuary.llm.encoding import PieceEncoder

NO_RANK = np.int32(2**31 - 1)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level files.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on, in ascending order.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


class ByteBpe:
    """A byte-level BPE vocabulary file of the tokenizers library's format."""

    def __init__(self, path: str):
        import public_tokenizers

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        vocab, merges = data["model"]["vocab"], data["model"]["merges"]
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(key)
        self.keys = key[order]
        self.ranks = order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)[order]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(public_tokenizers.PATTERN)

        back = {c: b for b, c in enumerate(symbols)}
        by_id = {i: bytes(back[c] for c in t) for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        size = max(by_id) + 1
        parts = [by_id.get(i, b"") for i in range(size)]
        self.token_bytes = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.token_len = np.array([len(p) for p in parts], dtype=np.int64)
        self.token_at = np.cumsum(self.token_len) - self.token_len

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, and its place among the sorted keys."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK), at.astype(np.int32)

    def merge_words(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as one flat byte array and their (positive) lengths.

        Returns the flat ids in word order and the number of ids of each word.
        """
        sym, sizes, words = self.first[data], lengths.astype(np.int64), np.arange(len(lengths))
        done_words, done_sizes, done_ids = [], [], []

        def rank_all() -> tuple[np.ndarray, np.ndarray]:
            rank, place = np.full(len(sym), NO_RANK), np.zeros(len(sym), dtype=np.int32)
            rank[:-1], place[:-1] = self._rank(sym[:-1], sym[1:])
            rank[np.cumsum(sizes) - 1] = NO_RANK
            return rank, place

        if len(sym):
            rank, place = rank_all()
        while len(sym):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(rank, starts)
            over = lowest == NO_RANK
            if over.any():
                gone = np.repeat(over, sizes)
                done_words.append(words[over])
                done_sizes.append(sizes[over])
                done_ids.append(sym[gone])
                left = ~gone
                sym, rank, place = sym[left], rank[left], place[left]
                words, sizes, lowest = words[~over], sizes[~over], lowest[~over]
                if not len(sym):
                    break
                starts = np.cumsum(sizes) - sizes
            hit = np.flatnonzero(rank == np.repeat(lowest, sizes))
            # a run of overlapping occurrences merges every other one
            fresh = np.ones(len(hit), dtype=bool)
            fresh[1:] = np.diff(hit) != 1
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
            sym[hit] = self.made[place[hit]]
            keep = np.ones(len(sym), dtype=bool)
            keep[hit + 1] = False
            sizes = np.add.reduceat(keep.astype(np.int64), starts)
            rank[hit] = rank[hit + 1]  # a word's last symbol keeps having no pair
            moved = np.cumsum(keep) - 1
            sym, rank, place = sym[keep], rank[keep], place[keep]
            last = np.zeros(len(sym), dtype=bool)
            last[np.cumsum(sizes) - 1] = True
            stale = np.zeros(len(sym), dtype=bool)
            stale[moved[hit]] = True
            stale[:-1] |= stale[1:]  # and the pair that ends in a merged symbol
            touched = np.flatnonzero(stale & ~last)
            rank[touched], place[touched] = self._rank(sym[touched], sym[touched + 1])
            rank[last] = NO_RANK
        if not done_words:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        words, sizes, ids = (np.concatenate(x) for x in (done_words, done_sizes, done_ids))
        counts = np.zeros(len(lengths), dtype=np.int64)
        counts[words] = sizes
        to = np.repeat((np.cumsum(counts) - counts)[words] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(ids))
        flat = np.empty(len(ids), dtype=np.uint32)
        flat[to] = ids
        return flat, counts

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each string as little-endian uint32 bytes."""
        parts, owner, fixed = [], [], {}
        for k, piece in enumerate(pieces):
            for x in self.split_special.split(piece) if self.split_special else [piece]:
                if x in self.special:
                    fixed[len(parts)] = self.special[x]
                    parts.append(b"\0")  # a placeholder word of one byte
                    owner.append(k)
                else:
                    for word in self.words.findall(x):
                        parts.append(word.encode("utf-8"))
                        owner.append(k)
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        ids, counts = self.merge_words(np.frombuffer(b"".join(parts), dtype=np.uint8), lengths)
        if fixed:
            at = np.cumsum(counts) - counts
            for k, token in fixed.items():
                ids[at[k]] = token
        per_piece = np.bincount(np.array(owner, dtype=np.int64), weights=counts, minlength=len(pieces)).astype(np.int64)
        raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(per_piece)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of a list of ids."""
        sizes = self.token_len[ids]
        at = np.repeat(self.token_at[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return self.token_bytes[at].tobytes()


_WORKERS: dict[str, tuple[ByteBpe, PieceEncoder]] = {}


def worker_bpe(path: str) -> tuple[ByteBpe, PieceEncoder]:
    if path not in _WORKERS:
        bpe = ByteBpe(path)
        _WORKERS[path] = bpe, PieceEncoder(bpe.encode_pieces, spaced=True)
    return _WORKERS[path]


def _lists(ids: list[bytes]) -> pa.ListArray:
    return list_column(np.frombuffer(b"".join(ids), dtype="<i4"), np.array([len(x) // 4 for x in ids], dtype=np.int64), pa.int32())


def coded(docs: DataFrame, vocabulary: str, outputs: dict[str, tuple[str, Callable]],
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, and for each output a column of its type made by its function.

    A function gets the vocabulary and the ids of each text as little-endian
    uint32 bytes, and returns an Arrow array; all run in one pass over the
    texts, so no token list crosses between processes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = worker_bpe(vocabulary)
        for batch in slices(batches, "text"):
            ids = encoder.encode(texts_of(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(make(bpe, ids) for _, make in outputs.values())],
                                             names=["doc_id", *outputs])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{name} {k}" for name, (k, _) in outputs.items()))


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, token_ids array<int>) of every whole text."""
    return coded(docs, vocabulary, {"token_ids": ("array<int>", lambda bpe, ids: _lists(ids))}, id_col, text_col)


def decode(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """The rows of ``encode`` with ``text``, decoded from their ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = worker_bpe(vocabulary)
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)).tolist()
            texts = [bpe.decode(flat[a:b]).decode("utf-8", errors="replace") for a, b in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, type=pa.string())],
                                             names=["doc_id", "token_ids", "text"])

    kind = dict(tokens.dtypes)["doc_id"]
    return tokens.mapInArrow(run, f"doc_id {kind}, token_ids array<int>, text string")


def _decoded_digest(bpe: ByteBpe, ids: list[bytes]) -> pa.Array:
    texts = (bpe.decode(np.frombuffer(x, dtype="<u4")).decode("utf-8", errors="replace") for x in ids)
    return pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in texts], type=pa.string())


#: Token count and SHA-256 digests of the ids and of the text decoded from them.
DIGESTS = {
    "n_tokens": ("bigint", lambda bpe, ids: pa.array([len(x) // 4 for x in ids], type=pa.int64())),
    "ids_sha256": ("string", lambda bpe, ids: pa.array([hashlib.sha256(x).hexdigest() for x in ids], type=pa.string())),
    "decoded_sha256": ("string", _decoded_digest),
}


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return coded(table(spark, sf_dir, "documents"), vocabulary, DIGESTS)
