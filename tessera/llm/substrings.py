"""Exact substring dedup: repeated windows of words, by super-k-mer partitioning."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import superkmers
from tessera.llm.common import partitions
from tessera.llm.superkmers import Bucket

LENGTH = 20
GRAM = 3
#: Bytes of text that meet their spans at once, about.
PART_BYTES = 6 << 20


def later(bucket: Bucket, length: int = LENGTH) -> list[list[np.ndarray]]:
    """Runs of windows in the bucket whose words also start earlier: at a smaller doc_id, or before in the document."""
    string, offset, group = bucket.window_groups(length)
    own = bucket.least[string]
    doc, null, start = bucket.doc[own], bucket.null[own], bucket.start[own] + offset
    order = np.lexsort((start, null, doc, group))
    new = np.concatenate(([True], np.diff(group[order]) != 0))
    lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    flags = np.zeros(len(order), bool)
    flags[order] = (doc[order] != doc[lead]) | (null[order] != null[lead]) | (start[order] != start[lead])
    first = bucket.leads()
    copies = np.flatnonzero(~first)
    whole = bucket.size[bucket.string[copies]] - length + 1
    return [
        superkmers.spans_of(bucket, flags, string, offset, np.flatnonzero(first)),
        [bucket.doc[copies], bucket.th[copies], bucket.start[copies], whole],
    ]


def copies(bucket: Bucket) -> list[list[np.ndarray]]:
    """Runs of the windows, one a string, at all but their earliest places."""
    own = np.flatnonzero(~bucket.leads())
    return [[bucket.doc[own], bucket.th[own], bucket.start[own], np.ones(len(own), np.int64)]]


def repeated_spans(rows: DataFrame, length: int, gram: int, buckets: int, hot_bytes: int = superkmers.HOT_BYTES) -> DataFrame:
    """(doc, th, start, windows): runs of windows that also start earlier, in ``rows``, a result of ``superkmers.keyed``."""
    deal = superkmers.plan(rows, length, gram, buckets, hot_bytes)
    packed = superkmers.pack(rows, deal)
    return superkmers.reduce(packed, deal, lambda b: later(b, length), copies, "doc bigint, th bigint, start bigint, windows bigint")


def text_blobs(rows: DataFrame) -> DataFrame:
    """(part, blob): the texts of a batch that go to one part, compressed together, which halves what the shuffle moves."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=superkmers.LEVEL).compress
        for b in batches:
            if not b.num_rows:
                continue
            doc, th, part = (b.column(k).to_numpy() for k in (0, 1, 3))
            texts = b.column(2).to_pylist()
            order = np.argsort(part, kind="stable")
            keys, blobs = [], []
            for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                held = [texts[k] for k in own.tolist()]
                sizes = np.fromiter(map(len, held), np.int64, len(held))
                keys.append(part[own[0]])
                blobs.append(squeeze(b"".join((np.array([len(own)]).tobytes(), doc[own].tobytes(), th[own].tobytes(), sizes.tobytes(), *held))))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], ["part", "blob"])

    return rows.mapInArrow(of, "part bigint, blob binary")


def deduplicate(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, buckets: int | None = None, texts: bool = False, hot_bytes: int = superkmers.HOT_BYTES
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) for each row of ``docs``, whose doc_id is an integer.

    A window is ``length`` consecutive words of one text. Every word that is covered by a window whose words also start
    earlier, at a smaller doc_id or before in the same document, is removed; windows are judged on the input. The words kept, joined by
    spaces, have the sha256 given. Nothing is sampled or capped: each bucket's windows are sorted by
    hash and those that meet are compared word by word, so no word goes because of a hash.

    Null and empty texts have no words, and texts of fewer words than a window lose none. A null doc_id comes after all others. Rows with
    equal doc_id and text are one place and don't remove each other; rows with equal doc_id and different
    texts are parts of one document that start at the same words. An empty table gives an empty result; other columns are not
    read. A long text is cut into overlapping pieces, so memory follows the bucket and not the text's repeats.

    Texts and spans meet by part, some megabytes of texts, and texts travel compressed. A bucket over ``hot_bytes``, that of a very frequent
    minimiser, is dealt again by the windows' own hashes.
    """
    rows = superkmers.keyed(docs)
    total = superkmers.text_bytes(rows)
    spans = repeated_spans(rows, length, gram, buckets or superkmers.bucket_count(total), hot_bytes)
    parts = max(partitions(docs.sparkSession), total // PART_BYTES)
    part = F.pmod(F.xxhash64("doc", "th"), F.lit(parts)).cast("bigint").alias("part")
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    fields += [("kept_text", pa.string())] * texts
    result = pa.schema(fields)

    def of(key: tuple, blobs: pa.Table, spans: pa.Table) -> pa.Table:
        doc, th, start, size = (spans.column(c).to_numpy() for c in ("doc", "th", "start", "windows"))
        order = np.lexsort((start, th, doc))
        doc, th, start, size = doc[order], th[order], start[order], size[order]
        cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(th) != 0)) + 1
        edges = [0, *cuts.tolist(), len(doc)] if len(doc) else [0]
        runs = {(int(doc[a]), int(th[a])): (a, z) for a, z in zip(edges, edges[1:], strict=False)}
        out: list[list] = [[] for _ in fields]
        spread = zstandard.ZstdDecompressor().decompress
        for blob in blobs.column("blob").to_pylist():
            body = spread(blob)
            n = int(np.frombuffer(body, np.int64, 1)[0])
            ids, tags, sizes = np.frombuffer(body, np.int64, 3 * n, 8).reshape(3, n).tolist()
            at = 8 + 24 * n
            for i, t, s in zip(ids, tags, sizes, strict=True):
                own = body[at : at + s].split()
                at += s
                total = len(own)
                if run := runs.get((i, t)):
                    a, z = run
                    change = np.zeros(total + 1, np.int64)
                    np.add.at(change, start[a:z], 1)
                    np.add.at(change, start[a:z] + size[a:z] + (length - 1), -1)
                    own = [own[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
                kept = b" ".join(own)
                row = [None if t >> superkmers.NULL_BIT else i, total, total - len(own), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if texts else None]
                for c, x in zip(out, row, strict=False):
                    c.append(x)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, result, strict=True)], schema=result)

    left = text_blobs(rows.select("doc", "th", "text", part))
    right = spans.withColumn("part", F.pmod(F.xxhash64("doc", "th"), F.lit(parts)).cast("bigint"))
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * texts
    found = left.groupBy("part").cogroup(right.groupBy("part")).applyInArrow(of, schema)
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


#: DuckDB SQL for ``deduplicate``.
ORACLE = f"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + {LENGTH - 1}], ' ') AS w FROM (
SELECT doc_id, ws, unnest(range(1, CAST(len(ws) - {LENGTH - 2} AS BIGINT))) AS i FROM d WHERE len(ws) >= {LENGTH})),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, (SELECT unnest(range(0, {LENGTH})) AS k)),
each_word AS (SELECT doc_id, i, ws[i] AS w FROM (SELECT doc_id, ws, unnest(range(1, CAST(len(ws) + 1 AS BIGINT))) AS i FROM d)),
kept AS (SELECT e.doc_id, string_agg(w, ' ' ORDER BY e.i) AS t, count(*) AS n FROM each_word e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""
