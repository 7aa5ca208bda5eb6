"""Repeated passages by sparse suffix arrays: suffixes at minimisers, sorted, compared with neighbours and extended to both sides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import superkmers
from tessera.llm.superkmers import Bucket, _mix

LENGTH = 50
GRAM = 8
#: Anchors whose words around them are gathered at once.
GATHER = 1 << 14


def anchors(bucket: Bucket, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, string) of every anchor: the places of the least run of ``gram`` words of each string, all of them if it occurs again.

    Anchors whose run occurs nowhere else are left out, as no window around one repeats.
    """
    n = len(bucket.words.starts)
    grams = _mix(bucket.words.windows(np.arange(max(0, n - gram + 1)), gram))
    count = bucket.size - gram + 1
    at = np.repeat(bucket.first - np.cumsum(count) + count, count) + np.arange(count.sum())
    least = np.minimum.reduceat(grams[at], np.cumsum(count) - count)
    hits = np.flatnonzero(grams[at] == np.repeat(least, count))
    string = np.repeat(np.arange(len(count)), count)[hits]
    places = np.bincount(bucket.string, minlength=len(count))
    _, which = np.unique(least[string], return_inverse=True)
    kept = np.bincount(which, weights=places[string])[which] > 1
    return at[hits][kept], string[kept]


def contexts(bucket: Bucket, word: np.ndarray, string: np.ndarray, left: int, right: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``left`` words before each anchor, nearest first, and the ``right`` words from it on, as numbers above 0; 0 beyond the string.

    Words get numbers from a dictionary, so equal numbers are equal words.
    """
    own = np.unique(string)
    size = bucket.size[own]
    begin = np.cumsum(size) - size
    names: dict[bytes, int] = {}
    starts, ends, text = bucket.words.starts, bucket.words.ends, bucket.text
    first = bucket.first[own]
    parts = [text[a:z] for a, z in zip(starts[first].tolist(), ends[first + size - 1].tolist(), strict=True)]
    numbers = np.fromiter((names.setdefault(w, len(names) + 1) for p in parts for w in p.split(b" ")), ">u4", int(size.sum()))
    at = np.searchsorted(own, string)
    place = begin[at] + word - bucket.first[string]
    low, high = begin[at], begin[at] + size[at]
    out = np.empty((len(word), left), ">u4"), np.empty((len(word), right), ">u4")
    for k in range(0, len(word), GATHER):
        z = slice(k, k + GATHER)
        for side, steps in zip(out, (-1 - np.arange(left), np.arange(right)), strict=True):
            i = place[z, None] + steps
            inside = (i >= low[z, None]) & (i < high[z, None])
            side[z] = np.where(inside, numbers[np.clip(i, 0, len(numbers) - 1)], 0)
    return out


def sorted_array(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows and how many words each has in common, from the first on, with the one before it in that order."""
    order = np.argsort(side.view(f"S{4 * side.shape[1]}").ravel(), kind="stable")
    alike = np.zeros(len(order), np.int64)
    for k in range(1, len(order), GATHER):
        a, b = side[order[k - 1 : k + GATHER - 1]], side[order[k : k + GATHER]]
        n = min(len(a), len(b))
        alike[k : k + n] = np.logical_and.accumulate((a[:n] == b[:n]) & (b[:n] != 0), axis=1).sum(axis=1)
    return order, alike


def runs_at(order: np.ndarray, alike: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The run of each row in the sorted array in which neighbours share ``depth`` words, and whether it has two rows or more."""
    run = np.empty(len(order), np.int64)
    near = alike >= depth
    near[0] = False
    run[order] = np.cumsum(~near)
    company = near.copy()
    company[:-1] |= near[1:]
    out = np.empty(len(order), bool)
    out[order] = company
    return run, out


def repeats(bucket: Bucket, length: int, gram: int) -> list[list[np.ndarray]]:
    """Runs (doc, th, start, windows, later) of windows whose words occur at two places; with ``later`` 1, of those that occur earlier.

    The suffixes at the anchors are sorted, and what neighbours share gives the runs of suffixes that agree on any number of words to
    the right; so do the words before the anchors, sorted nearest first, to the left. A window with its anchor after ``o`` words
    repeats if another anchor is with it in both the run of ``length - o`` words to the right and that of ``o`` words to the left. All windows of an
    anchor contain it, so those that repeat make one stretch, from the farthest to the left to the farthest to the right.
    """
    word, string = anchors(bucket, gram)
    if not len(word):
        return []
    reach = length - gram
    left, right = contexts(bucket, word, string, reach, length)
    n_left, n_right = (left != 0).sum(axis=1), (right != 0).sum(axis=1)
    by_right, by_left = sorted_array(right), sorted_array(left)

    # the places of each anchor, with ranks by document and word; equal rows are one place
    order = np.argsort(bucket.string, kind="stable")
    n = np.bincount(bucket.string, minlength=len(bucket.size))
    begin = np.cumsum(n) - n
    anchor = np.repeat(np.arange(len(word)), n[string])
    of = order[np.repeat(begin[string] - np.cumsum(n[string]) + n[string], n[string]) + np.arange(len(anchor))]
    doc, null, start = bucket.doc[of], bucket.null[of], bucket.start[of] + (word - bucket.first[string])[anchor]
    ranked = np.lexsort((start, null, doc))
    step = np.ones(len(ranked), np.int64)
    step[1:] = (np.diff(doc[ranked]) != 0) | (np.diff(null[ranked]) != 0) | (np.diff(start[ranked]) != 0)
    rank = np.empty(len(ranked), np.int64)
    rank[ranked] = np.cumsum(step)
    heads = np.cumsum(n[string]) - n[string]
    least, most = np.minimum.reduceat(rank, heads), np.maximum.reduceat(rank, heads)

    none = length + 1
    far, near = np.full(len(word), -1), np.full(len(word), none)  # the greatest and the least o of a window that repeats
    later_far, later_near = np.full(len(rank), -1), np.full(len(rank), none)
    for o in range(reach + 1):
        fits = (n_left >= o) & (n_right >= length - o)
        run_right, more_right = runs_at(*by_right, length - o)
        run_left, more_left = runs_at(*by_left, o)
        both = np.flatnonzero(fits & more_right & more_left)
        low, high = least.copy(), most.copy()
        if len(both):
            pair = run_right[both] * (len(word) + 1) + run_left[both]
            own = np.argsort(pair, kind="stable")
            edges = np.flatnonzero(np.concatenate(([True], np.diff(pair[own]) != 0)))
            size = np.diff(np.concatenate((edges, [len(own)])))
            low[both[own]] = np.repeat(np.minimum.reduceat(least[both[own]], edges), size)
            high[both[own]] = np.repeat(np.maximum.reduceat(most[both[own]], edges), size)
        again = fits & (low != high)
        far[again] = o
        near[again & (near == none)] = o
        behind = (fits & (low != high))[anchor] & (low[anchor] < rank)
        later_far[behind] = o
        later_near[behind & (later_near == none)] = o

    def found(last: np.ndarray, first: np.ndarray, flag: int) -> list[np.ndarray]:
        own = np.flatnonzero(last >= 0)
        return [doc[own], bucket.th[of[own]], start[own] - last[own], last[own] - first[own] + 1, np.full(len(own), flag, np.int64)]

    return [found(far[anchor], near[anchor], 0), found(later_far, later_near, 1)]


def copies(bucket: Bucket) -> list[list[np.ndarray]]:
    """What ``repeats`` returns for windows, one a string, that have two places: all of these, and all but the earliest as later ones."""
    lead = bucket.leads()
    twice = np.bincount(bucket.string[~lead], minlength=len(bucket.size)) > 0
    runs = lambda own, flag: [bucket.doc[own], bucket.th[own], bucket.start[own], np.ones(len(own), np.int64), np.full(len(own), flag, np.int64)]
    return [runs(np.flatnonzero(twice[bucket.string]), 0), runs(np.flatnonzero(~lead), 1)]


def repeated_passages(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, buckets: int | None = None, hot_bytes: int = superkmers.HOT_BYTES
) -> DataFrame:
    """(doc_id, start_word, n_words, n_later): the longest stretches of words that windows which occur elsewhere cover.

    A window is ``length`` consecutive words of one text, and it repeats if its words also occur at another place, in any document or
    in the same one. Windows that overlap or touch make one stretch; ``n_later`` counts those of its words that are covered by
    windows which also start earlier (smaller doc_id, or before in the document), the words that dedup removes.

    Null and empty texts and texts under ``length`` words have no rows. A null doc_id comes after all others. Rows with equal doc_id and
    text are one place, and give one set of rows. An empty table gives an empty result; other columns are not read. Words are compared as
    they are. The suffixes kept are those at minimisers, about one of 22; each travels with the words around it that windows need, and
    all that is found comes from comparing neighbours among them (``repeats``). Copies among some megabytes of text travel once, so a hot passage costs a place for each copy. Around an anchor that is very frequent
    windows travel one by one, dealt by their own hash and then in pieces.
    """
    rows = superkmers.keyed(docs)
    n = buckets or superkmers.bucket_count(superkmers.text_bytes(rows))
    deal = superkmers.plan(rows, length, gram, n, hot_bytes)
    packed = superkmers.pack(rows, deal)
    schema = "doc bigint, th bigint, start bigint, windows bigint, later bigint"
    runs = superkmers.reduce(packed, deal, lambda b: repeats(b, length, gram), copies, schema)
    per_doc = (
        runs.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "windows", "later")).alias("x"))
        .select("doc", "th", "x.start", "x.windows", "x.later")
    )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs_, starts, sizes, laters = [], [], [], []
            for doc, th, a, w, k in zip(*(b.column(c).to_pylist() for c in range(5)), strict=True):
                a, z, k = np.array(a), np.array(a) + np.array(w) + (length - 1), np.array(k, bool)
                lo, hi = merged(a, z)
                low, high = merged(a[k], z[k])
                inside = np.searchsorted(lo, low, "right") - 1
                docs_ += [None if th >> superkmers.NULL_BIT else doc] * len(lo)
                starts += lo.tolist()
                sizes += (hi - lo).tolist()
                laters += np.bincount(inside, weights=high - low, minlength=len(lo)).astype(np.int64).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (docs_, starts, sizes, laters)], names)

    names = ["doc_id", "start_word", "n_words", "n_later"]
    return per_doc.mapInArrow(of, ", ".join(f"{x} bigint" for x in names))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans, as spans that neither overlap nor touch."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    a, z = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], a[1:] > z[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(a) - 1]))
    return a[new], z[last]


#: DuckDB SQL for ``repeated_passages``.
ORACLE = f"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + {LENGTH - 1}], ' ') AS w FROM (
SELECT doc_id, ws, unnest(range(1, CAST(len(ws) - {LENGTH - 2} AS BIGINT))) AS i FROM d WHERE len(ws) >= {LENGTH})),
rep AS (SELECT doc_id, i, k > 1 AS later FROM (
SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k, count(*) OVER (PARTITION BY w) AS n FROM win) WHERE n > 1),
covered AS (SELECT doc_id, i + j AS i, bool_or(later) AS later FROM rep, (SELECT unnest(range(0, {LENGTH})) AS j) GROUP BY ALL),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g FROM covered)
SELECT doc_id, CAST(min(i) - 1 AS BIGINT) AS start_word, CAST(count(*) AS BIGINT) AS n_words, CAST(count(*) FILTER (later) AS BIGINT) AS n_later
FROM islands GROUP BY doc_id, g"""
