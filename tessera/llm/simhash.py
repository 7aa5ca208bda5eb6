"""SimHash near-duplicates: fingerprints, pigeonhole blocks and components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint, partitions, set_aside, small, spread_join, stored
from tessera.llm.components import connected_components

WIDTH = 3
SEED = 42
DISTANCE = 3
#: Bits of the six blocks, lowest first. Two fingerprints that differ in three bits at most agree on three blocks at least.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: In a bucket of more fingerprints, the bits that vary are cut into blocks again, and so on until buckets are as small as this.
DIRECT = 2048

#: Buckets up to this size are compared many at a time, and up to the next as a matrix; links of larger ones are found from one fingerprint at a time.
FEW, MATRIX = 16, 512

#: The wide form: shingles of five words, fingerprints of 256 bits, and the distance that goes with a similarity of 0.8. Fingerprints measure the angle between texts'
#: sets of shingles as vectors, so their similarity is its cosine: 0.8 stands for 52 differing bits of 256. Two sets of n shingles with that cosine share 0.8 n,
#: a Jaccard similarity of 0.67, so all pairs that are 0.8 alike by Jaccard are well within.
WIDE_WIDTH = 5
WIDE_WORDS = 4
WIDE_DISTANCE = 52
#: Each of the splits cuts another permutation of the bits into 16 blocks of 16 bits: pairs that differ in 15 bits or fewer share a block for certain, pairs
#: that differ in 38 (a Jaccard similarity of 0.8) with probability 0.999, in 46 with 0.97, in 52 with 0.91. Over some 100 million distinct texts, buckets of 16 bits
#: grow large: then blocks should have more bits, and there should be more splits.
WIDE_SPLITS = 6
WIDE_BITS = 16

U = np.uint64


def _words_of(hashes: np.ndarray, words: int) -> np.ndarray:
    """(n, words): each hash, followed by words that are mixed from it."""
    out = np.empty((len(hashes), words), "<u8")
    out[:, 0] = hashes
    for k in range(1, words):
        x = hashes + U(0x9E3779B97F4A7C15 * k & (1 << 64) - 1)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        out[:, k] = x ^ (x >> U(31))
    return out


def fingerprint(text: bytes, width: int = WIDTH, words: int = 1) -> bytes:
    """The SimHash of one text, ``8 * words`` bytes, lowest bits first: A-Z in lower case; zero without words.

    One word is made of shingles with their repeats, several of distinct shingles, so that a text full of repeats is like others by what it says.
    """
    tokens = text.lower().split()  # for bytes: A-Z only, and exactly the space and U+0009 to U+000D
    if not tokens:
        return bytes(8 * words)
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= width:
        return _words_of(np.array([digest(joined, SEED)], "<u8"), words).tobytes()
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = [0, *(ends[:-width] + 1).tolist()]
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)], dtype="<u8")
    if words > 1:
        hashes = np.unique(hashes)
    ones = np.zeros(64 * words, np.int64)
    for k in range(0, len(hashes), 255):  # sums of 255 bits fit a byte
        part = _words_of(hashes[k : k + 255], words) if words > 1 else hashes[k : k + 255]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8 * words), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little").tobytes()


def fingerprints(docs: DataFrame, width: int = WIDTH, words: int = 1) -> DataFrame:
    """``docs`` with ``fp`` instead of ``text``: a bigint of the fingerprint's bits, or its bytes if it has more words; a null text counts as empty."""
    others = [f for f in docs.schema.fields if f.name != "text"]
    names = [f.name for f in others]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fingerprint(t or b"", width, words) for t in b.column(len(names)).to_pylist()]
            fps = pa.array(np.frombuffer(b"".join(found), "<i8")) if words == 1 else pa.array(found, pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], fps], [*names, "fp"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), f"fp {'bigint' if words == 1 else 'binary'}"])
    return docs.select(*names, F.col("text").cast("binary").alias("text")).mapInArrow(of, schema)


def block_keys(fp: Column) -> Column:
    """For each choice of three blocks, a bigint of the choice's number and these blocks' bits."""
    starts = [sum(BLOCKS[:k]) for k in range(len(BLOCKS))]

    def key(n: int, chosen: tuple[int, ...]) -> Column:
        out = F.lit(n).cast("bigint")
        for k in chosen:
            bits = F.shiftrightunsigned(fp, starts[k]).bitwiseAND(F.lit((1 << BLOCKS[k]) - 1).cast("bigint"))
            out = F.shiftleft(out, BLOCKS[k]).bitwiseOR(bits)
        return out

    return F.array(*(key(n, c) for n, c in enumerate(combinations(range(len(BLOCKS)), 3))))


def close_links(fps: np.ndarray, direct: int = DIRECT, distance: int = DISTANCE) -> Iterator[tuple[int, int]]:
    """Pairs that connect exactly those of the distinct ``fps`` which chains of close ones connect.

    A bucket of k fingerprints gives fewer than k pairs. In a large bucket the bits that vary are cut into twice as many blocks as may differ, and
    buckets on half of them are linked in turn, by the same rule: the fingerprints of such a bucket agree on half of the bits, so fewer
    vary each time, and no step compares all with all.
    """
    varying = int(np.bitwise_or.reduce(fps ^ fps[0]))
    places = [k for k in range(64) if varying >> k & 1]
    n = 2 * distance
    if len(fps) <= direct or len(places) < n:
        yield from ((int(a[0]), int(b[0])) for a, b in _direct(fps[:, None], distance))
        return
    parts = [places[k::n] for k in range(n)]
    for chosen in combinations(range(n), distance):
        mask = U(sum(1 << p for k in chosen for p in parts[k]))
        order = np.argsort(fps & mask, kind="stable")
        cuts = np.flatnonzero(np.diff(fps[order] & mask)) + 1
        for group in np.split(fps[order], cuts):
            if len(group) > 1:
                yield from close_links(group, direct, distance)


def _direct(fps: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The links of a spanning forest of the close ones among ``fps``, a row of words each."""
    left = fps
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            near = _apart(left, queue.pop()) <= distance
            if near.any():
                found, left = left[near], left[~near]
                for x in found:
                    yield root, x
                queue.extend(found)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bits rows of words differ in."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.uint16)


def _few(fps: np.ndarray, starts: np.ndarray, sizes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of all close pairs in buckets of few rows, each from its start on."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for size in np.unique(sizes).tolist():
        i, j = np.triu_indices(size, 1)
        first = starts[sizes == size]
        for k in range(0, len(first), max(1, (1 << 18) // len(i))):
            at = first[k : k + max(1, (1 << 18) // len(i)), None]
            a, b = (at + i).ravel(), (at + j).ravel()
            near = _apart(fps[a], fps[b]) <= distance
            found.append((a[near], b[near]))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none)


def _matrix(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the first row of each component of close rows, with those of its other rows."""
    near = _apart(fps[:, None], fps[None]) <= distance
    label = np.arange(len(fps))
    if near.sum() > len(fps):
        while True:
            new = np.where(near, label, len(fps)).min(axis=1)
            if (new == label).all():
                break
            label = new
    own = np.flatnonzero(label != np.arange(len(fps)))
    return label[own], own


def linked(keyed: DataFrame, kind: str, distance: int, large) -> DataFrame:
    """(src, dst), distinct, from rows (key, fp): links that connect what chains of close fingerprints of a bucket connect.

    Rows of a bucket arrive sorted and are linked bucket by bucket, so a task holds one bucket of distinct short values. A bucket gives links in proportion to its
    size. ``large`` gives those of a large one, as pairs of rows.
    """
    wide = kind == "binary"

    def read(column: pa.Array) -> np.ndarray:
        if wide:
            return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(len(column), -1)
        return column.to_numpy().view(np.uint64)[:, None]

    def named(rows: np.ndarray) -> pa.Array:
        return pa.array([r.tobytes() for r in rows], pa.binary()) if wide else pa.array(np.ascontiguousarray(rows[:, 0]).view(np.int64))

    def out(src: np.ndarray, dst: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(src):
            yield pa.RecordBatch.from_arrays([named(src), named(dst)], ["src", "dst"])

    def one(fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(fps) <= MATRIX:
            a, b = _matrix(fps, distance)
            yield from out(fps[a], fps[b])
        elif pairs := list(large(fps)):
            src, dst = (np.stack(x) for x in zip(*pairs, strict=True))
            yield from out(src, dst)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []
        for b in batches:
            if not b.num_rows:
                continue
            keys, fps = b.column(0).to_numpy(), read(b.column(1))
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
            if held_key == keys[0]:
                held.append(fps[: cuts[1]])
                if len(cuts) == 2:
                    continue
                cuts = cuts[1:]
            if sum(map(len, held)) > 1:
                yield from one(np.concatenate(held))
            sizes, starts = np.diff(cuts)[:-1], cuts[:-2]
            few = (sizes > 1) & (sizes <= FEW)
            i, j = _few(fps, starts[few], sizes[few], distance)
            yield from out(fps[i], fps[j])
            for k in np.flatnonzero(sizes > FEW).tolist():
                yield from one(fps[cuts[k] : cuts[k + 1]])
            held_key, held = keys[cuts[-2]], [fps[cuts[-2] :]]
        if sum(map(len, held)) > 1:
            yield from one(np.concatenate(held))

    n = partitions(keyed.sparkSession)
    return keyed.repartition(n, "key").sortWithinPartitions("key").mapInArrow(of, f"src {kind}, dst {kind}").distinct()


def links(distinct: DataFrame, direct: int = DIRECT) -> DataFrame:
    """(src, dst) among the distinct fingerprints ``fp``, bigints: pairs that connect all that close pairs connect."""
    keyed = distinct.select(F.explode(block_keys(F.col("fp"))).alias("key"), "fp")
    return linked(keyed, "bigint", DISTANCE, lambda fps: ((np.array([a], U), np.array([b], U)) for a, b in close_links(fps[:, 0], direct)))


def wide_places(splits: int = WIDE_SPLITS, bits: int = WIDE_BITS, words: int = WIDE_WORDS) -> np.ndarray:
    """(keys, bits): the bits of each block; each split cuts another permutation of the fingerprint's bits into blocks."""
    per = 64 * words // bits
    return np.concatenate([np.random.default_rng([SEED, k]).permutation(64 * words)[: per * bits].reshape(per, bits) for k in range(splits)])


def wide_links(distinct: DataFrame, splits: int = WIDE_SPLITS, bits: int = WIDE_BITS, words: int = WIDE_WORDS, distance: int = WIDE_DISTANCE) -> DataFrame:
    """(src, dst) among the distinct fingerprints ``fp``, binaries: pairs within ``distance`` that share a block, as forests."""
    places = wide_places(splits, bits, words)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for b in batches:
            for k in range(0, b.num_rows, 2048):
                fps = b.column(0).slice(k, 2048)
                set_bits = np.unpackbits(np.frombuffer(b"".join(fps.to_pylist()), np.uint8).reshape(len(fps), -1), axis=1, bitorder="little")
                own = [set_bits[:, p] @ weights + (j << bits) for j, p in enumerate(places)]
                rows = pa.array(np.tile(np.arange(len(fps)), len(places)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own)), fps.take(rows)], ["key", "fp"])

    return linked(distinct.select("fp").mapInArrow(keys, "key bigint, fp binary"), "binary", distance, lambda fps: _direct(fps, distance))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``: 16 hex digits, and the smallest doc_id reachable.

    Fingerprints link at 3 or fewer differing bits, and components follow chains of links. Null and empty texts have fingerprint
    zero, which links like any other. Equal fingerprints are one vertex, so copies add no links. A row without doc_id joins its
    component but never names it, unless all are without: then component_id is null. Repeated rows stay repeated; an empty table gives
    an empty result; columns other than doc_id and text are not read.
    """
    prints = checkpoint(fingerprints(docs.select("doc_id", "text")))
    distinct = checkpoint(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    parts = checkpoint(connected_components(links(distinct)))
    names_of = parts.join(distinct, parts["id"] == distinct["fp"])
    names = names_of.groupBy("component").agg(F.min("least").alias("component_id"))
    named = names_of.join(names, "component").select(F.col("fp").alias("id"), "component_id")
    of = distinct.join(named, distinct["fp"] == named["id"], "left").select("fp", F.coalesce("component_id", "least").alias("component_id"), "n")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return spread_join(prints, checkpoint(of), "fp", "n", prints.count()).select("doc_id", digits.alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, width: int = WIDE_WIDTH, distance: int = WIDE_DISTANCE, splits: int = WIDE_SPLITS, bits: int = WIDE_BITS) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, in the wide form: shingles of five words, similarity 0.8 or more.

    Similarity is the cosine of the texts' sets of shingles, read from fingerprints of 256 bits with a standard error of 0.05 at 0.8, and groups follow chains of similar texts. The row that
    stays is that of the smallest doc_id; of several with that id, the one whose columns hash lowest, so reruns agree (rows that are
    equal in every column are interchangeable). Each row is judged by its own text: two texts under one doc_id that aren't alike both stay.
    Rows without doc_id come after all others. Null and empty texts are one group. An empty table stays empty. Columns are those of ``docs``.

    Rows are numbered in a written copy, and all the rest works on numbers and fingerprints. The numbers of the rows to go are broadcast if a count shows
    that they are few; otherwise the last join shuffles.
    """
    inner = set_aside(docs, "doc_id", "text")
    plain = [f.name for f in inner.schema.fields if "map" not in f.dataType.simpleString()]
    kept = stored(inner.withColumns({"s_tie": F.xxhash64(*plain), "s_row": F.monotonically_increasing_id()}))
    rows = checkpoint(fingerprints(kept.select("s_row", "s_tie", "doc_id", "text"), width, WIDE_WORDS))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "s_tie", "s_row")).alias("best")
    distinct = checkpoint(rows.groupBy("fp").agg(best))
    parts = connected_components(wide_links(distinct, splits, bits, WIDE_WORDS, distance))
    group = F.coalesce("component", "fp").alias("group")
    ahead = distinct.join(parts, distinct["fp"] == parts["id"], "left").select(group, "best").groupBy("group").agg(F.min("best").alias("best"))
    gone = checkpoint(rows.select("s_row").join(ahead.select(F.col("best.s_row").alias("s_row")), "s_row", "left_anti"))
    return kept.join(small(gone), "s_row", "left_anti").select(*inner.columns).toDF(*docs.columns)
