"""Alignment of two tokenizers by diagonal run skipping, and links between their vocabularies.

Both tokenizers cut the bytes of a text; the places where a token of each ends cut it into groups.
Along a text most tokens agree one to one, so the arrays of ends are equal at some shift for long
stretches. Windows of doubling length are compared at the current shift, and the last one by
halves, which jumps a stretch in a logarithm of its length. Where the ends differ the group is
resolved by walking the side that is behind, and the shift is updated.

The tokens of a group are linked, each of one side with each of the other. The number of documents
that hold a pair linked is counted over the whole corpus without a row per link: a task gathers
documents to a chunk of about ``CHUNK_PAIRS`` distinct pairs of documents, sends one row per distinct
pair of the chunk, and keeps per document the places of its pairs in that list. Counts go back to
the chunks the same way, so shuffles carry pairs of chunks, and no table is broadcast.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import stored
from .packing import encoder, token_ids, tokenizer_path

CHUNK_PAIRS = 1 << 21
# Links of a group beyond which its ids are counted first, instead of listing the links.
LISTED = 4096
# Characters of texts that are handled at once, units whose ids a worker remembers, and their length.
TEXT_CHARS = 1 << 20
UNITS = 1 << 19
UNIT_CHARS = 64
CUT = re.compile(r"(?<=\S)(?= \S)")


class Lists:
    """Numbered lists of numbers, joined by number."""

    def __init__(self):
        self.flat, self.first, self.n = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.used = self.count = 0

    def __len__(self) -> int:
        return self.count

    def add(self, lists: list, kind=np.int64) -> None:
        n = np.fromiter(map(len, lists), np.int64, len(lists))
        self.put(np.fromiter(chain.from_iterable(lists), kind, n.sum()), n)

    def put(self, flat: np.ndarray, n: np.ndarray) -> None:
        """Lists that stand one after the other in ``flat``, of the lengths ``n``."""
        if self.flat.dtype != flat.dtype:
            self.flat = self.flat.astype(flat.dtype)
        self.flat = grown(self.flat, self.used + len(flat))
        self.first, self.n = (grown(x, self.count + len(n)) for x in (self.first, self.n))
        self.flat[self.used : self.used + len(flat)] = flat
        self.first[self.count : self.count + len(n)] = self.used + np.cumsum(n) - n
        self.n[self.count : self.count + len(n)] = n
        self.used, self.count = self.used + len(flat), self.count + len(n)

    def of(self, found: np.ndarray) -> np.ndarray:
        first, n = self.first[found], self.n[found]
        return self.flat[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array, at least twice as long if it is shorter than ``size``."""
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


class Tokens:
    """Both tokenizers of one worker with the bytes of every token."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.path_a, self.paths = path_a, (path_a, path_b)
        encoding = encoder(path_a)
        self.plain = encoding.encode_ordinary
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [encoding.decode_single_token_bytes(i) if i < encoding.max_token_value else b"" for i in range(encoding.n_vocab)]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(map(self.pieces.id_to_piece, range(self.pieces.get_piece_size())))
        ]
        # A piece with a space behind another character would cross units.
        self.by_unit = not any(b" " in p.lstrip(b" ") for p in self.bytes_b)
        self.forget()
        self.size_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.size_b = np.array(list(map(len, self.bytes_b)), np.int64)
        # Ids as text with what may follow them: A then B, each before a comma, at the end of its side.
        n, m = len(self.bytes_a), len(self.bytes_b)
        words = [f"{i},".encode() for i in range(n)] + [f"{i}|".encode() for i in range(n)] + [f"{i},".encode() for i in range(m)] + [f"{i};".encode() for i in range(m)]
        self.words = Lists()
        self.words.add(words, np.uint8)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of all texts, one after the other, and how many each has, on both sides; none where a side does not give back a space and the text."""
        split = [self.units(t) if t else [] for t in texts]
        if len(self.known) > UNITS:
            self.forget()
        found = list(map(self.known.get, chain.from_iterable(split)))
        long = []
        if None in found:
            new = list(dict.fromkeys(u for u, k in zip(chain.from_iterable(split), found) if k is None))
            self.learn(new)
            found = [self.known[u] if k is None else k for u, k in zip(chain.from_iterable(split), found)]
            long = [u for u in new if len(u) >= UNIT_CHARS]
        text = np.repeat(np.arange(len(texts)), list(map(len, split)))
        found = np.array(found, np.int64)
        if (found < 0).any():
            whole = ~np.isin(text, text[found < 0])
            found, text = found[whole], text[whole]
        ids, sizes = [], []
        for lists in self.ids:
            ids.append(lists.of(found))
            sizes.append(np.bincount(text, lists.n[found], len(texts)).astype(np.int64))
        for unit in long:
            del self.known[unit]
        return ids, sizes

    def forget(self) -> None:
        self.known, self.ids = {}, (Lists(), Lists())

    def learn(self, units: list[str]) -> None:
        """Numbers of new units, and the ids of both sides under them; -1 where a side does not give back the bytes.

        Units that stand between plain spaces are encoded as one text, which is cut again at their ends.
        """
        plain = [u for u in units if len(u) < UNIT_CHARS and not u[1:2].isspace() and not u[-1].isspace()] if self.by_unit else []
        if plain:
            text = "".join(plain)
            sides = [np.array(x, np.int64) for x in (self.plain(text), self.pieces.encode(text[1:], num_threads=1))]
            ends = np.cumsum([len(u.encode("utf-8", "surrogatepass")) for u in plain])
            cuts = [np.searchsorted(np.cumsum(size[ids]), ends) for ids, size in zip(sides, (self.size_a, self.size_b))]
            whole = text.encode("utf-8", "surrogatepass")
            joined = all(b"".join(map(token.__getitem__, ids.tolist())) == whole for ids, token in zip(sides, (self.bytes_a, self.bytes_b)))
            if joined and all((np.cumsum(size[ids])[cut] == ends).all() for ids, size, cut in zip(sides, (self.size_a, self.size_b), cuts)):
                self.known |= zip(plain, range(len(self.ids[0]), len(self.ids[0]) + len(plain)))
                for lists, ids, cut in zip(self.ids, sides, cuts):
                    lists.put(ids, np.diff(cut + 1, prepend=0))
                units = [u for u in units if u not in self.known]
        known = []
        for unit, ids_b in zip(units, self.pieces.encode([u[1:] for u in units], num_threads=1)):
            ids_a = token_ids(unit, self.path_a).tolist()
            whole = unit.encode("utf-8", "surrogatepass")
            if b"".join([self.bytes_a[i] for i in ids_a]) == whole == b"".join([self.bytes_b[i] for i in ids_b]):
                self.known[unit] = len(known) + len(self.ids[0])
                known.append((ids_a, ids_b))
            else:
                self.known[unit] = -1
        for side, lists in enumerate(self.ids):
            lists.add([k[side] for k in known])

    def units(self, text: str) -> list[str]:
        """A space and the text, cut before single spaces between characters that are none: no token of either side crosses these."""
        return CUT.split(" " + text) if self.by_unit else [" " + text]


_tokens: list[Tokens] = []


def tokens(path_a: str, path_b: str) -> Tokens:
    if not _tokens or _tokens[0].paths != (path_a, path_b):
        _tokens[:] = [Tokens(path_a, path_b)]
    return _tokens[0]


def group_sizes(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of tokens of either side in each group. Ends rise and have the same last value."""
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    a, b = ends_a.astype("<u8").tobytes(), ends_b.astype("<u8").tobytes()
    n, m = len(a), len(b)
    # Places in bytes of the arrays, eight to an end: equal windows are compared at once.
    uneven = []
    i = j = 0
    while i < n:
        size = 32
        while size:
            size = min(size, n - i, m - j)
            if size and a[i : i + size] == b[j : j + size]:
                i, j, size = i + size, j + size, 2 * size
            else:
                break
        while size > 8:
            size = size // 16 * 8
            if a[i : i + size] == b[j : j + size]:
                i, j = i + size, j + size
        if i < n:
            x, y = i // 8, j // 8
            uneven += x, y
            while (p := list_a[x]) != (q := list_b[y]):
                if p < q:
                    x += 1
                else:
                    y += 1
            x, y = x + 1, y + 1
            uneven += x, y
            i, j = 8 * x, 8 * y
    x, y, x_end, y_end = np.array(uneven, np.int64).reshape(-1, 4).T
    more = x_end - x - 1
    sizes_a = np.ones(len(list_a) - more.sum(), np.int64)
    sizes_b = sizes_a.copy()
    at = x - (np.cumsum(more) - more)
    sizes_a[at], sizes_b[at] = x_end - x, y_end - y
    return sizes_a, sizes_b


def linked_pairs(ids_a: np.ndarray, ids_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct linked pairs of each text: the text, the pair (a << 32 | b) and how many links it has, in order. ``text`` is that of each group."""
    first_a, first_b = np.cumsum(sizes_a) - sizes_a, np.cumsum(sizes_b) - sizes_b
    links = sizes_a * sizes_b
    few = np.flatnonzero(links <= LISTED)
    group = np.repeat(few, links[few])
    within = np.arange(len(group)) - np.repeat(np.cumsum(links[few]) - links[few], links[few])
    wide = int(ids_b.max(initial=0)) + 1
    high = (int(ids_a.max(initial=0)) + 1) * wide
    codes = [text[group] * high + ids_a[first_a[group] + within // sizes_b[group]] * wide + ids_b[first_b[group] + within % sizes_b[group]]]
    times = [np.ones(len(group), np.int64)]
    for g in np.flatnonzero(links > LISTED):
        a, n = np.unique(ids_a[first_a[g] : first_a[g] + sizes_a[g]], return_counts=True)
        b, m = np.unique(ids_b[first_b[g] : first_b[g] + sizes_b[g]], return_counts=True)
        codes.append((text[g] * high + a[:, None] * wide + b).ravel())
        times.append((n[:, None] * m).ravel())
    found, place = np.unique(np.concatenate(codes), return_inverse=True)
    counted = np.bincount(place, np.concatenate(times), len(found)).astype(np.int64)
    return found // high, found % high // wide << 32 | found % wide, counted


def groups_bytes(t: Tokens, ids_a: np.ndarray, ids_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All groups as ``a1,a2|b1;a3|b2,b3;`` and where each ends."""
    n, both = len(t.bytes_a), sizes_a + sizes_b
    out = np.empty(len(ids_a) + len(ids_b), np.int64)
    first = np.cumsum(both) - both
    is_b = np.ones(len(out), bool)
    is_b[np.arange(len(ids_a)) + np.repeat(first - (np.cumsum(sizes_a) - sizes_a), sizes_a)] = False
    out[~is_b], out[is_b] = ids_a, ids_b + 2 * n
    out[first + sizes_a - 1] += n
    out[first + both - 1] += len(t.bytes_b)
    ends = np.cumsum(t.words.n[out])
    return t.words.of(out).tobytes(), ends[first + both - 1]


def packed_pairs(at: np.ndarray, times: np.ndarray) -> bytes:
    """Rising places and their numbers, as compressed planes of bytes."""
    import zstandard

    both = np.stack([np.diff(at, prepend=0), times]).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(both.view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1).tobytes())


def unpacked_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(2, 4, -1)
    steps, times = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4").reshape(2, -1).astype(np.int64)
    return np.cumsum(steps), times


FIELDS = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
CHUNKS = pa.schema([("chunk", pa.int64()), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32())), *FIELDS, ("found", pa.binary())])
CHUNK_COLUMNS = "chunk long, pairs array<long>, docs array<int>, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, found binary"
COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """doc_ids and texts in parts of about TEXT_CHARS, a longer text alone."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = text.as_py()
            if texts and size + len(text) > TEXT_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
        if texts:
            yield ids, texts


def aligned_texts(both: Tokens, doc_ids: list, texts: list[str]) -> Iterator[tuple[tuple, tuple[np.ndarray, np.ndarray]]]:
    """Row and linked pairs of every text. The texts are aligned as one: the end of each is a common end."""
    (a, b), (n_a, n_b) = both.encode(texts)
    m, k = group_sizes(np.cumsum(both.size_a[a]), np.cumsum(both.size_b[b]))
    text = np.repeat(np.arange(len(texts)), n_a)[np.cumsum(m) - m]
    n_groups = np.bincount(text, minlength=len(texts))
    n_links = np.bincount(text, m * k, len(texts)).astype(np.int64)
    written, ends = groups_bytes(both, a, b, m, k)
    last = np.r_[0, ends][np.cumsum(n_groups)]
    of, pairs, times = linked_pairs(a, b, m, k, text)
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    for i, doc_id in enumerate(doc_ids):
        start = int(last[i - 1]) if i else 0
        digest = hashlib.sha256(written[start : int(last[i]) - 1]).hexdigest() if n_a[i] else ""
        row = doc_id, int(n_a[i]), int(n_b[i]), int(n_groups[i]), int(n_links[i]), digest
        yield row, (pairs[cuts[i] : cuts[i + 1]], times[cuts[i] : cuts[i + 1]])


def aligned_chunks(docs: DataFrame, path_a: str, path_b: str, chunk_pairs: int = CHUNK_PAIRS) -> DataFrame:
    """Per chunk a row of its distinct pairs (chunk, pairs, docs: how many of its documents hold each), and a row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        both, chunk = tokens(path_a, path_b), TaskContext.get().partitionId() << 32
        rows, held, size = [], [], 0
        for ids, texts in parts(batches):
            for row, pairs in aligned_texts(both, ids, texts):
                rows.append(row)
                held.append(pairs)
                size += len(pairs[0])
                if size >= chunk_pairs:
                    yield from chunk_of(chunk, rows, held)
                    rows, held, size, chunk = [], [], 0, chunk + 1
        if rows:
            yield from chunk_of(chunk, rows, held)

    def chunk_of(chunk: int, rows: list, held: list) -> Iterator[pa.RecordBatch]:
        pairs, place, docs = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True, return_counts=True)
        ends = np.cumsum([len(p) for p, _ in held])
        head = [[chunk], [pairs], [docs.astype(np.int32)], *([None] for _ in FIELDS), [None]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(head, CHUNKS.types)], schema=CHUNKS)
        for at in range(0, len(rows), 1024):
            found = [packed_pairs(place[e - len(p) : e], t) for e, (p, t) in zip(ends[at : at + 1024].tolist(), held[at : at + 1024])]
            k = len(found)
            body = [[chunk] * k, [None] * k, [None] * k, *zip(*rows[at : at + 1024]), found]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(body, CHUNKS.types)], schema=CHUNKS)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, CHUNK_COLUMNS)


def summed_chunk(rows: pa.Table, looked: pa.Table) -> pa.Table:
    """The documents of a chunk with the sums over their links; ``looked`` holds place, n and best of each pair of the chunk."""
    size = looked.num_rows
    count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    place = looked.column("place").to_numpy()
    count[place], best[place] = looked.column("n").to_numpy(), looked.column("best").to_numpy()
    n_best, count_sum = [], []
    for data in rows.column("found").to_pylist():
        at, times = unpacked_pairs(data)
        n_best.append(int(times @ best[at]))
        count_sum.append(int(times @ count[at]))
    plain = {name: rows.column(name) for name, _ in FIELDS}
    plain |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
    return pa.table({name: plain[name] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")})


def pair_counts(chunks: DataFrame) -> DataFrame:
    """a, b, pair, n: how many documents hold the tokens a and b linked; most: the largest n of a."""
    pairs = chunks.filter("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counts = pairs.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("n"))
    counts = cut_lineage(counts.withColumns({"a": F.shiftright("pair", 32), "b": F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))}))
    return counts.join(cut_lineage(counts.groupBy("a").agg(F.max("n").alias("most"))), "a")


def translations(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The vocabulary map: of every token a the tokens b with the highest count, with n. Ties stay."""
    chunks = stored(aligned_chunks(docs, path_a, path_b), "aligned")
    return pair_counts(chunks).filter("n = most").select(F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"), "n")


def aligned(docs: DataFrame, path_a: str, path_b: str, chunk_pairs: int = CHUNK_PAIRS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``path_a`` is a file of byte-pair ranks, ``path_b`` a model of pieces, on every worker. Names of
    special tokens in a text are ordinary text. A null or empty text, and one whose bytes a
    tokenizer does not give back behind a space, has no tokens: zeros and an empty groups_sha256.
    Repeated rows repeat and count as documents of their own; null doc_ids stay null; an empty table
    gives no rows; other columns are not read. Pairs of one document are held by one task.
    """
    chunks = stored(aligned_chunks(docs, path_a, path_b, chunk_pairs), "aligned")
    known = pair_counts(chunks).select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))
    # An alias of its own: both sides of the grouping come from one table.
    places = chunks.filter("pairs IS NOT NULL").select(F.col("chunk").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    looked = places.join(known, "pair").select("of", "place", "n", "best")
    rows = chunks.filter("pairs IS NULL").drop("pairs", "docs")
    return rows.groupBy("chunk").cogroup(looked.groupBy("of")).applyInArrow(summed_chunk, COLUMNS)


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Groups and links of both tokenizers in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return aligned(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
