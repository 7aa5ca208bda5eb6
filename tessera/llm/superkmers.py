"""Super-k-mers: windows of words that share a minimiser, packed into one string and sent to its bucket.

A window is ``length`` consecutive words; its minimiser is the least hash of the runs of ``gram`` words in it. Equal windows have
equal minimisers, so they meet in one bucket. Consecutive windows with one minimiser travel as the one string of the words that they cover.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint, partitions

#: Bytes of text that are packed at once, and words of a long text in one piece.
CHUNK_BYTES = 4_000_000
PIECE_WORDS = 400_000
#: Bytes that are hashed at once.
HASH_BYTES = 1_000_000
#: Bytes of text in a bucket's super-k-mers, about.
BUCKET_BYTES = 6 << 20
LEVEL = 3
#: Tasks that the buckets are dealt to, at most; a task holds one bucket at a time.
MOST_TASKS = 20_000
#: Pieces of a hot bucket, at least.
PIECES = 16
#: A bucket of more bytes than this is hot.
HOT_BYTES = 6 * BUCKET_BYTES

#: Stands for a null doc_id, together with this bit of ``th``, which sets it apart from a row of that number.
LAST = (1 << 63) - 1
NULL_BIT = 30

U = np.uint64
_C1, _C2 = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(32))
    x = x * _C2
    x = x ^ (x >> U(29))
    x = x * _C1
    return x ^ (x >> U(32))


@lru_cache(2)
def _letters(which: int) -> np.ndarray:
    """Random 64-bit values of the 256 bytes."""
    return np.random.default_rng([77, which]).integers(1, 1 << 64, 256, dtype=U, endpoint=False)


@lru_cache(4)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    forward = np.full(n, U(base))
    forward[0] = 1
    back = np.full(n, U(pow(base, -1, 1 << 64)))
    back[0] = 1
    return np.multiply.accumulate(forward), np.multiply.accumulate(back)


_BASES = (0x5851F42D4C957F2D, 0x14057B7EF767814F)


def _range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """A hash of ``values[start:end]`` for each range, by prefix sums of a polynomial."""
    size = 1 << max(12, int(len(values) + 1).bit_length())
    forward, back = _powers(size, _BASES[which])
    sums = np.zeros(len(values) + 1, U)
    np.cumsum(values * forward[: len(values)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(U) * _C1)


class Words:
    """The words of ``text``, bytes in which single spaces separate words: where they are, and two hashes of each."""

    def __init__(self, text: bytes, hashes: int = 1):
        raw = np.frombuffer(text, np.uint8)
        gaps = np.flatnonzero(raw == 32)
        self.starts = np.concatenate(([0], gaps + 1)).astype(np.int64)
        self.ends = np.concatenate((gaps, [len(raw)])).astype(np.int64)
        self.hashes = [self._hash(raw, k) for k in range(hashes)]

    def _hash(self, raw: np.ndarray, which: int) -> np.ndarray:
        out = np.empty(len(self.starts), U)
        k = 0
        while k < len(out):  # in pieces, as each byte takes 24 bytes here
            base = self.starts[k]
            to = max(k + 1, int(np.searchsorted(self.ends, base + HASH_BYTES, "right")))
            piece = _letters(which)[raw[base : self.ends[to - 1]]]
            out[k:to] = _range_hashes(piece, self.starts[k:to] - base, self.ends[k:to] - base, which)
            k = to
        return out

    def windows(self, starts: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        """Hashes of the windows of ``length`` words that begin at ``starts``."""
        return _range_hashes(self.hashes[which], starts, starts + length, which)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def cut(words: Words, sizes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, minimiser) of each super-k-mer; ``sizes`` are the words of each text in a row."""
    n = len(words.starts)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none.astype(U)
    grams = _mix(words.windows(np.arange(n - gram + 1), gram))
    least = sliding_min(grams, length - gram + 1)
    ends = np.repeat(np.cumsum(sizes), sizes)
    at = np.flatnonzero(np.arange(len(least)) + length <= ends[: len(least)])
    if not len(at):
        return none, none, none.astype(U)
    own = least[at]
    new = np.flatnonzero((np.diff(at) != 1) | (own[1:] != own[:-1])) + 1
    first = np.concatenate(([0], new))
    return at[first], np.diff(np.concatenate((first, [len(at)]))), own[first]


class Deal:
    """Where super-k-mers go: to the bucket of their minimiser, or window by window to a bucket of the window, if that one is hot.

    A hot bucket's windows are cut apart and dealt by their own hash to ``extra`` buckets behind the others. Equal windows still meet, and different
    ones around a frequent minimiser spread over many tasks.
    """

    def __init__(self, length: int, gram: int, buckets: int, hot: tuple[int, ...] = (), extra: int = 0):
        self.length, self.gram, self.buckets, self.hot, self.extra = length, gram, buckets, np.array(hot, np.int64), extra

    def cut(self, words: Words, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first window, number of windows, bucket) of all that travels of the texts."""
        first, count, least = cut(words, sizes, self.length, self.gram)
        bucket = (_mix(least) % U(self.buckets)).astype(np.int64)
        apart = np.isin(bucket, self.hot)
        if not apart.any():
            return first, count, bucket
        n = count[apart]
        each = np.repeat(first[apart] - np.cumsum(n) + n, n) + np.arange(n.sum())
        own = self.buckets + (_mix(words.windows(each, self.length)) % U(self.extra)).astype(np.int64)
        join = lambda x, y: np.concatenate((x[~apart], y))
        return join(first, each), join(count, np.ones_like(each)), join(bucket, own)


def chunks(b: pa.RecordBatch, length: int) -> Iterator[list[tuple[int, int, int, list[bytes]]]]:
    """The texts of a batch, some megabytes at a time, as (doc, th, first word, words); long texts in overlapping pieces."""
    held: list[tuple[int, int, int, list[bytes]]] = []
    size = 0
    for doc, th, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
        own = (text or b"").split()
        for k in range(0, max(1, len(own) - length + 1), PIECE_WORDS):
            piece = own if len(own) <= PIECE_WORDS else own[k : k + PIECE_WORDS + length - 1]
            if len(piece) < length:
                continue
            held.append((doc, th, k, piece))
            size += len(text)
            if size >= CHUNK_BYTES or len(own) > PIECE_WORDS:
                yield held
                held, size = [], 0
    if held:
        yield held


def joined(held: list[tuple[int, int, int, list[bytes]]]) -> tuple[bytes, Words, np.ndarray]:
    text = b" ".join([b" ".join(x[3]) for x in held])
    return text, Words(text), np.fromiter((len(x[3]) for x in held), np.int64, len(held))


def plan(rows: DataFrame, length: int, gram: int, buckets: int, hot_bytes: int = HOT_BYTES) -> Deal:
    """The deal for all of ``rows``, a result of ``keyed``: a first pass adds up the bytes of every bucket.

    The driver gets the numbers of the buckets that hold more than ``hot_bytes``, of which there are few beside all buckets.
    """
    deal = Deal(length, gram, buckets)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = np.zeros(buckets, np.int64) if buckets <= 1 << 20 else None
            for held in chunks(b, length):
                _, words, sizes = joined(held)
                first, count, bucket = deal.cut(words, sizes)
                size = words.ends[first + count + length - 2] - words.starts[first]
                if sums is not None:
                    sums += np.bincount(bucket, weights=size, minlength=buckets).astype(np.int64)
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(size)], ["bucket", "bytes"])
            if sums is not None:
                own = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[own])], ["bucket", "bytes"])

    loads = rows.mapInArrow(of, "bucket bigint, bytes bigint").groupBy("bucket").agg(F.sum("bytes").alias("bytes"))
    hot = loads.where(F.col("bytes") > hot_bytes).collect()
    extra = max(1, 7 * sum(r["bytes"] for r in hot) // BUCKET_BYTES)
    return Deal(length, gram, buckets, tuple(sorted(r.bucket for r in hot)), extra)


def pack(rows: DataFrame, deal: Deal) -> DataFrame:
    """(bucket, blob) from ``rows``, a result of ``keyed``.

    A blob holds one bucket's super-k-mers of some megabytes of text, each distinct string once with all its places, in zstd. So copies
    within those texts travel as places only.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for held in chunks(b, deal.length):
                yield from blobs(held, deal)

    return rows.mapInArrow(of, "bucket bigint, blob binary")


def blobs(held: list[tuple[int, int, int, list[bytes]]], deal: Deal) -> Iterator[pa.RecordBatch]:
    text, words, sizes = joined(held)
    first, count, bucket = deal.cut(words, sizes)
    if not len(first):
        return
    offsets = np.cumsum(sizes) - sizes
    which = np.searchsorted(offsets, first, "right") - 1
    docs, tags, bases = (np.array([x[k] for x in held], np.int64) for k in range(3))
    place = first - offsets[which] + bases[which]
    order = np.lexsort((place, docs[which], bucket))
    a, z = words.starts[first].tolist(), words.ends[first + count + deal.length - 2].tolist()
    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    keys, out = [], []
    for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        strings: dict[bytes, int] = {}
        index = np.array([strings.setdefault(text[a[k] : z[k]], len(strings)) for k in own.tolist()], np.int32)
        w = which[own]
        keys.append(int(bucket[own[0]]))
        out.append(squeeze(body_of(docs[w], place[own], tags[w], index, strings)))
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(out, pa.binary())], ["bucket", "blob"])


def body_of(doc: np.ndarray, start: np.ndarray, th: np.ndarray, string: np.ndarray, strings) -> bytes:
    """The bytes of a blob: places (doc, start, th, number of the string), then the distinct strings."""
    places = (np.diff(doc, prepend=0), start, th.astype(np.int32), np.diff(string.astype(np.int32), prepend=np.int32(0)))
    return b"".join((np.array([len(doc)], np.int64).tobytes(), *(x.tobytes() for x in places), b"\n".join(strings)))


class Bucket:
    """The super-k-mers of one bucket: distinct strings, and the places (doc, th, start, string) of each.

    ``text`` is the strings joined by spaces; ``first`` and ``size`` are each string's first word there and its number of words.
    """

    def __init__(self, packed: list[bytes]):
        spread = zstandard.ZstdDecompressor().decompress
        strings: dict[bytes, int] = {}
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for blob in packed:
            body = spread(blob)
            n = int(np.frombuffer(body, np.int64, 1)[0])
            doc = np.cumsum(np.frombuffer(body, np.int64, n, 8))
            start = np.frombuffer(body, np.int64, n, 8 + 8 * n)
            th, index = (np.frombuffer(body, np.int32, n, 8 + k * n).astype(np.int64) for k in (16, 20))
            ids = np.array([strings.setdefault(s, len(strings)) for s in body[8 + 24 * n :].split(b"\n")], np.int64)
            for c, x in zip(columns, (doc, th, start, ids[np.cumsum(index)]), strict=True):
                c.append(x)
        self.doc, self.th, self.start, self.string = map(np.concatenate, columns)
        self.strings = strings
        self.text = b" ".join(strings)
        self.words = Words(self.text, hashes=2)
        self.size = np.fromiter((s.count(b" ") + 1 for s in strings), np.int64, len(strings))
        self.first = np.cumsum(self.size) - self.size
        #: The earliest place of each string.
        self.null = self.th >> NULL_BIT  # after every number
        order = np.lexsort((self.start, self.null, self.doc, self.string))
        lead = np.flatnonzero(np.concatenate(([True], np.diff(self.string[order]) != 0)))
        self.least = order[lead]

    def leads(self) -> np.ndarray:
        """Whether each place is the earliest of its string, or as early."""
        least = self.least[self.string]
        return (self.doc == self.doc[least]) & (self.null == self.null[least]) & (self.start == self.start[least])

    def thinned(self) -> bytes:
        """A blob of the strings at their earliest places only, each row once."""
        own = np.flatnonzero(self.leads())
        _, once = np.unique(np.stack([self.string[own], self.doc[own], self.th[own]]), axis=1, return_index=True)
        own = own[once]
        return zstandard.ZstdCompressor(level=LEVEL).compress(body_of(self.doc[own], self.start[own], self.th[own], self.string[own], self.strings))

    def window_groups(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(string, offset, group) of every window of the strings; windows of equal words have one group, and no others have.

        Two 64-bit hashes bring equal windows together. The words of each are then compared with those of the group's first, and a group in
        which hashes have met by chance is dealt again by its words.
        """
        counts = self.size - length + 1
        string = np.repeat(np.arange(len(self.size)), counts)
        offset = np.arange(len(string)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = self.first[string] + offset
        h, g = self.words.windows(at, length, 0), self.words.windows(at, length, 1)
        order = np.argsort(h, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
        ids = np.cumsum(new) - 1
        group = np.empty(len(order), np.int64)
        group[order] = ids
        lead = order[np.flatnonzero(new)]
        again = order[~new]
        text = self.text
        a, z = self.words.starts[at], self.words.ends[at + length - 1]
        pairs = zip(a[again].tolist(), z[again].tolist(), a[lead[group[again]]].tolist(), z[lead[group[again]]].tolist(), strict=True)
        wrong = [k for k, (i, j, x, y) in enumerate(pairs) if text[i:j] != text[x:y]]
        if wrong:
            mixed = np.flatnonzero(np.isin(group, np.unique(group[again[wrong]])))
            names: dict[tuple[int, bytes], int] = {}
            top = len(lead)
            for k, own in zip(mixed.tolist(), group[mixed].tolist(), strict=True):
                group[k] = top + names.setdefault((own, text[a[k] : z[k]]), len(names))
        return string, offset, group


def spans_of(bucket: Bucket, flags: np.ndarray, string: np.ndarray, offset: np.ndarray, which: np.ndarray) -> list[np.ndarray]:
    """(doc, th, start, windows) of each run of flagged windows, at the places ``which``; flags are by string and offset, in order."""
    at = np.flatnonzero(flags)
    if not len(at) or not len(which):
        return [np.zeros(0, np.int64)] * 4
    cuts = np.flatnonzero((np.diff(at) != 1) | (np.diff(string[at]) != 0)) + 1
    head = at[np.concatenate(([0], cuts))]
    runs = np.diff(np.concatenate(([0], cuts, [len(at)])))
    own = string[head]
    lo, hi = np.searchsorted(own, bucket.string[which], "left"), np.searchsorted(own, bucket.string[which], "right")
    n = hi - lo
    place = np.repeat(which, n)
    run = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return [bucket.doc[place], bucket.th[place], bucket.start[place] + offset[head[run]], runs[run]]


Rows = list[list[np.ndarray]]


def reduce(packed: DataFrame, deal: Deal, of: Callable[[Bucket], Rows], thin: Callable[[Bucket], Rows], schema: str) -> DataFrame:
    """``of`` applied to each bucket, one bucket at a time; it returns columns of bigints that ``schema`` names.

    Windows of hot buckets are strings by themselves, and one of them can have places in a large share of all documents. So those buckets are cut into
    pieces by the tasks that packed them. ``thin`` returns what a piece alone can tell of its places, and only each string's earliest
    place goes on from there: no task meets more places of a window than one piece has, or than there are pieces.
    """
    names = [x.split()[0] for x in schema.split(",")]
    n = min(MOST_TASKS, max(partitions(packed.sparkSession), deal.buckets // 8))  # a task takes its buckets one by one, however many they are

    def run(batches: Iterator[pa.RecordBatch], pieces: bool) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        fields = [*names, "bucket", "blob"] if pieces else names

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                bucket, apart = Bucket(held), pieces and key[0] >= deal.buckets
                for columns in (thin if apart else of)(bucket):
                    for k in range(0, len(columns[0]), 1 << 18):
                        part = [pa.array(c[k : k + (1 << 18)]) for c in columns]
                        none = [pa.nulls(len(part[0]), t) for t in (pa.int64(), pa.binary())] if pieces else []
                        yield pa.RecordBatch.from_arrays([*part, *none], fields)
                if apart:
                    own = [pa.nulls(1, pa.int64())] * len(names)
                    yield pa.RecordBatch.from_arrays([*own, pa.array([key[0]], pa.int64()), pa.array([bucket.thinned()], pa.binary())], fields)
                held.clear()

        for b in batches:
            for k, piece, blob in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                if (k, piece) != key:
                    yield from out()
                key = (k, piece)
                held.append(blob)
        yield from out()

    def rounds(rows: DataFrame, pieces: bool, out: str) -> DataFrame:
        return rows.repartition(n, "bucket", "piece").sortWithinPartitions("bucket", "piece").mapInArrow(lambda it: run(it, pieces), out)

    whole = F.lit(0)
    if not len(deal.hot):
        return rounds(packed.select("bucket", whole.alias("piece"), "blob"), False, schema)
    piece = F.when(F.col("bucket") >= deal.buckets, F.spark_partition_id() % max(PIECES, n // 8)).otherwise(whole)
    first = checkpoint(rounds(packed.select("bucket", piece.alias("piece"), "blob"), True, f"{schema}, bucket bigint, blob binary"))
    left = first.where("blob IS NOT NULL").select("bucket", whole.alias("piece"), "blob")
    return first.where("blob IS NULL").select(*names).unionByName(rounds(left, False, schema))


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def bucket_count(total: int) -> int:
    """Buckets for so many bytes of text: super-k-mers hold about three times the text."""
    return max(8, 3 * total // BUCKET_BYTES)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, th, text): doc_id as a bigint, the greatest if null; 30 hash bits that tell rows of one doc_id apart and one that marks a null; the text's bytes."""
    text, doc = F.coalesce("text", F.lit("")), F.col("doc_id").cast("bigint")
    tag = F.xxhash64("doc_id", text).bitwiseAND(F.lit((1 << NULL_BIT) - 1).cast("bigint"))
    return docs.select(
        F.coalesce(doc, F.lit(LAST)).alias("doc"), (tag + F.when(doc.isNull(), 1 << NULL_BIT).otherwise(0)).alias("th"), text.cast("binary").alias("text")
    )
