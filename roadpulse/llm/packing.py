"""Harmonic packing of token sequences.

A piece of length r belongs to the reciprocal-capacity class k = capacity // r, and a bin of
class k takes exactly k pieces of it. Documents may be cut, so a rest that would waste much in
its class gives off a piece of the largest length of the next class, capacity // (k + 1), until
what is left fits well. Every worker fills the bins of each class on its own: nothing is
shuffled, and a lost task packs its rows again to the same bins. At its end a worker has at most
k - 1 open pieces per class; it puts these together first-fit by falling length, and cuts the
last sequence at powers of two, which need no padding.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text, with_row_key

CAPACITY = 2048
END_ID = 1
# Largest share of a piece's length that its class may waste on it.
SLACK = 0.005
# Texts are tokenized in slices of about so many characters, cut where no token crosses.
SLICE_CHARS = 1 << 18
# A worker hands on its pieces when they hold so many ids.
BATCH_IDS = 1 << 17
# Added tokens of the vocabulary, which the file of ranks does not hold. They hold no space, so that no slice ends inside one.
SPECIAL_TOKENS = {"<|endoftext|>": 50256}

SCHEMA = (
    "rid long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long, ids array<int>"
)
ARROW = pa.schema(
    [(n, pa.int64()) for n in ("rid", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length")]
    + [("ids", pa.list_(pa.int32()))]
)


_encoders: dict[str, object] = {}


def encoder(path: str):
    """Encoding of a file of byte-pair ranks and the added tokens, one per Python worker. Ids are those of the JSON form of the same vocabulary."""
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encoders.clear()
        _encoders[path] = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL_TOKENS)
    return _encoders[path]


def token_ids(text: str, path: str, special: bool = False) -> np.ndarray:
    """Ids of a whole text, slice by slice; names of added tokens are these with ``special``, else ordinary text."""
    encoding = encoder(path)
    encode = partial(encoding.encode, allowed_special="all") if special else encoding.encode_ordinary
    return np.concatenate([np.array(encode(s), np.int32) for s in slices(text)])


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """Slices cut before a single space between two characters that are no whitespace."""
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        while cut > 0 and (cut + 1 >= len(text) or text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut <= 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def cut_lengths(n: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[int]:
    """Lengths of the pieces of n tokens: full sequences, then what suits the classes."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if capacity - k * rest <= slack * capacity:
            out.append(rest)
            break
        piece = capacity // (k + 1)
        out.append(piece)
        rest -= piece
    return out


class Bins:
    """Sequences of one worker. Pieces are tuples (rid, doc_id, start, doc_tokens, ids)."""

    def __init__(self, worker: int, capacity: int):
        self.capacity, self.next = capacity, worker << 40
        self.open: dict[int, list] = {}

    def close(self, pieces: list) -> Iterator[tuple]:
        total = sum(len(p[-1]) for p in pieces)
        offset = 0
        for rid, doc_id, start, doc_tokens, ids in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            yield rid, doc_id, start, len(ids), crc, doc_tokens, self.next, offset, total, ids
            offset += len(ids)
        self.next += 1

    def add(self, piece: tuple) -> Iterator[tuple]:
        k = self.capacity // len(piece[-1])
        waiting = self.open.setdefault(k, [])
        waiting.append(piece)
        if len(waiting) == k:
            yield from self.close(self.open.pop(k))

    def finish(self) -> Iterator[tuple]:
        """Open pieces, at most k - 1 of class k: first-fit by falling length, then the last one by powers of two."""
        rest = sorted((p for c in self.open.values() for p in c), key=lambda p: (-len(p[-1]), p[:3]))
        bins: list[list] = []
        room: list[int] = []
        for piece in rest:
            n = len(piece[-1])
            at = next((i for i, r in enumerate(room) if r >= n), None)
            if at is None:
                bins.append([])
                room.append(self.capacity)
                at = len(bins) - 1
            bins[at].append(piece)
            room[at] -= n
        for pieces in bins[:-1]:
            yield from self.close(pieces)
        pieces = bins[-1] if bins else []
        left = sum(len(p[-1]) for p in pieces)
        while left:
            want = 1 << (left.bit_length() - 1)
            taken, size = [], 0
            while size < want:
                rid, doc_id, start, doc_tokens, ids = pieces.pop(0)
                fit = min(len(ids), want - size)
                taken.append((rid, doc_id, start, doc_tokens, ids[:fit]))
                if fit < len(ids):
                    pieces.insert(0, (rid, doc_id, start + fit, doc_tokens, ids[fit:]))
                size += fit
            yield from self.close(taken)
            left -= want


def packed(rows: Iterable[tuple], worker: int, path: str, capacity: int, end_id: int, special: bool = False) -> Iterator[tuple]:
    """Packed pieces of the rows (rid, doc_id, text) of one worker."""
    bins = Bins(worker, capacity)
    for rid, doc_id, text in rows:
        ids = np.concatenate([token_ids(text, path, special), np.array([end_id], np.int32)])
        start = 0
        for n in cut_lengths(len(ids), capacity):
            yield from bins.add((rid, doc_id, start, len(ids), ids[start : start + n]))
            start += n
    yield from bins.finish()


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True, special: bool = False
) -> DataFrame:
    """One row per piece: rid, doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length, ids.

    ``tokenizer`` is the path of a file of byte-pair ranks on every worker. Each document gets
    ``end_id`` after its ids; a null or empty text is that id alone. A sequence holds
    ``sequence_length`` ids and is padded to ``capacity`` unless that is a power of two.
    Documents of any length are tokenized in slices. Null or repeated doc_ids are packed like
    others, row by row; an empty table gives no rows; other columns are not read. Without
    ``keep_ids`` the column ids is null. With ``special`` the name of an added token in a text is
    that token, as in the JSON form's own default; without it, ordinary text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def rows():
            # Text by text: a batch as Python strings would stay in the worker's memory.
            for batch in batches:
                for row in zip(*(batch.column(c) for c in ("rid", "doc_id", "text"))):
                    yield tuple(v.as_py() for v in row)

        def out(waiting: list) -> pa.RecordBatch:
            *plain, ids = zip(*waiting)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in plain] + [pa.array(ids if keep_ids else [None] * len(ids), pa.list_(pa.int32()))],
                schema=ARROW,
            )

        waiting, held = [], 0
        for row in packed(rows(), TaskContext.get().partitionId(), tokenizer, capacity, end_id, special):
            waiting.append(row)
            held += len(row[-1])
            if held >= BATCH_IDS:
                yield out(waiting)
                waiting, held = [], 0
        if waiting:
            yield out(waiting)

    base = with_row_key(docs, F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return base.mapInArrow(run, SCHEMA)


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_harmonic_packing(spark, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, tokenizer_path(), keep_ids=False, special=True).drop("rid", "ids")
