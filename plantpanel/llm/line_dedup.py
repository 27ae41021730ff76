"""Line dedup: passages of several lines that an earlier place of the corpus has.

Texts are cut into content-defined chunks: a rolling hash over the hashes of
neighbouring lines chooses the boundaries, so they depend on nearby lines only
and survive insertions elsewhere.  Chunks of several lines meet by their hash
over the whole corpus, and those that repeat go after a comparison of their
bytes.

``dedup_lines`` does that and no more; what a passage has before its first and
after its last boundary stays.  ``dedup_passages`` takes the seams along: next
to the chunks, the least windows from and up to every line, hashed the same way,
meet in the same join, so a repeated passage goes whole wherever it begins and
ends, short ones without a boundary too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk
from .common import settled, unused

#: Lines that the rolling hash sees at a time.
WINDOW_LINES = 2
#: One boundary in so many lines, on average.
MEAN_LINES = 4
#: Chunks and passages of fewer lines with a word, or of fewer bytes, stay where they are.
MIN_LINES = 2
MIN_BYTES = 40
#: Repeated hashes with their first places are broadcast up to this many (some 100 bytes each in memory); beyond it they are joined by shuffling.
BROADCAST_HASHES = 500_000
WHITE = b" \t\n\v\f\r"


def _cuts(h: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether a chunk ends with each line, from the hashes and texts of the lines with a word."""
    rolling = np.zeros(len(h), dtype=np.uint64)
    for k in range(WINDOW_LINES):
        part = np.zeros(len(h), dtype=np.uint64)
        same = np.arange(len(h)) >= k
        part[k:] = h[: len(h) - k]
        same[k:] &= docs[k:] == docs[: len(h) - k]
        rolling = rolling * np.uint64(0x9E3779B97F4A7C15) + np.where(same, part, 0).astype(np.uint64)
    return (tk.mix(rolling) >> np.uint64(32)) % np.uint64(MEAN_LINES) == 0


def chunk_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of packed texts: text, start, end (newline included), lines, hash.

    A boundary follows a line whose rolling hash over the last ``WINDOW_LINES``
    lines with a word falls into one residue of ``MEAN_LINES``; a text's end is
    one too.  Blank lines belong to the chunk of the line before them.
    """
    starts, ends, docs = tk.lines(data, offsets)
    sums = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(tk.WORD_BYTE[data], out=sums[1:])
    full = sums[ends] > sums[starts]
    hasher = tk.Hasher(data)
    f = np.flatnonzero(full)
    h, d = hasher.spans(starts[f], ends[f]), docs[f]
    cut = _cuts(h, d)
    # A chunk begins with the first full line of a text and with a full line after a cut.
    begin = np.ones(len(f), dtype=bool)
    begin[1:] = cut[:-1] | (d[1:] != d[:-1])
    first = np.flatnonzero(begin)
    c_docs = d[first]
    last = np.ones(len(first), dtype=bool)
    last[:-1] = c_docs[1:] != c_docs[:-1]
    lead = np.ones(len(first), dtype=bool)
    lead[1:] = c_docs[1:] != c_docs[:-1]
    c_starts = np.where(lead, offsets[c_docs], starts[f[first]])
    c_ends = np.append(c_starts[1:], 0)
    c_ends[last] = offsets[c_docs[last] + 1]
    n_lines = np.diff(first, append=len(f))
    # The hash and the comparison leave out the white space after the last word.
    stops = ends[f[np.append(first[1:], len(f)) - 1]] if len(first) else c_ends
    begins = starts[f[first]] if len(first) else c_starts
    return c_docs, c_starts, c_ends, n_lines, hasher.spans(begins, stops)


def chunk_table(docs: DataFrame, with_bytes: bool) -> DataFrame:
    """(h, doc_id, at[, body]) of every chunk that could go."""
    names = ["h", "doc_id", "at"] + ["body"] * with_bytes

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = np.asarray(batch.column(0).is_valid().to_numpy(zero_copy_only=False))
            data, offsets = tk.packed(batch.column(1))
            for i, _, part, at in tk.chunks(data, offsets):
                doc, start, end, n_lines, h = chunk_lines(part, at)
                h = h.view(np.int64)
                keep = (n_lines >= MIN_LINES) & (end - start >= MIN_BYTES) & known[i + doc]
                arrays = [pa.array(h[keep]), batch.column(0).take(pa.array(i + doc[keep])), pa.array((start - at[doc])[keep])]
                if with_bytes:
                    raw = part.tobytes()
                    arrays.append(pa.array([raw[a:b].strip(WHITE) for a, b in zip(start[keep].tolist(), end[keep].tolist())], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(find, f"h long, doc_id {kind}, at long" + ", body binary" * with_bytes)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove multi-line chunks that an earlier place of the corpus has.

    Places are ordered by id, then position; the earliest one of a chunk stays.
    Returns the input rows with the text shortened, and with the columns
    ``n_lines_removed``, ``n_chunks_removed`` and ``n_bytes_removed`` (columns of
    these names are replaced).  Null, empty and one-line texts come back as they
    are; rows with a null id keep all and make nothing go; rows repeated under
    one id keep the same places.  A text may become empty.  White space around
    a chunk's words does not count in the comparison.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # Repeated hashes: narrow rows with map-side minima, whatever the chunk's size or number.
    place = F.struct("doc_id", "at")
    seen = chunk_table(slim, False).groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = settled(seen.where("first <> last").select("h", F.col("first.doc_id").alias("first_doc"), F.col("first.at").alias("first_at")))
    # While they are few, chunks meet them before any shuffle.
    known = F.broadcast(repeated) if repeated.count() <= BROADCAST_HASHES else repeated
    again = chunk_table(slim, True).join(known, "h").withColumn("is_first", F.expr("doc_id = first_doc AND at = first_at"))
    firsts = again.where("is_first").select("h", F.col("body").alias("first_body")).dropDuplicates(["h"])
    going, going_id = unused(docs.columns, "_gone", "_gone_id")
    gone = again.where("NOT is_first").join(firsts, "h").where("body = first_body").groupBy("doc_id").agg(F.sort_array(F.collect_set("at")).alias(going))
    gone = gone.withColumnRenamed("doc_id", going_id)

    counters = ["n_lines_removed", "n_chunks_removed", "n_bytes_removed"]
    kept = docs.drop(*counters)
    joined = kept.join(gone.hint("shuffle_hash"), F.col(id_col) == F.col(going_id), "left").drop(going_id)
    text_at, gone_at = joined.columns.index(text_col), len(joined.columns) - 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, gone = batch.column(text_at), batch.column(gone_at)
            data, offsets = tk.packed(column)
            touched = np.flatnonzero(np.asarray(gone.is_valid().to_numpy(zero_copy_only=False)))
            n_lines, n_chunks, n_bytes = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            keep = np.ones(len(data), dtype=bool)
            for d in touched.tolist():
                part = data[offsets[d] : offsets[d + 1]]
                _, starts, ends, lines, _ = chunk_lines(part, np.array([0, len(part)]))
                going = np.isin(starts, np.array(gone[d].as_py()))
                for a, b in zip(starts[going], ends[going]):
                    keep[offsets[d] + a : offsets[d] + b] = False
                n_lines[d], n_chunks[d], n_bytes[d] = lines[going].sum(), going.sum(), (ends - starts)[going].sum()
            if len(touched):
                left = np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int64)
                text = pa.LargeStringArray.from_buffers(batch.num_rows, pa.py_buffer(left.tobytes()), pa.py_buffer(data[keep].tobytes())).cast(pa.string())
                column = pc.if_else(column.is_valid(), text, pa.scalar(None, pa.string()))
            columns = list(batch.columns[:gone_at])
            columns[text_at] = column
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, (n_lines, n_chunks, n_bytes))], [*batch.schema.names[:gone_at], *counters])

    schema = T.StructType([*kept.schema.fields, *(T.StructField(c, T.LongType()) for c in counters)])
    return joined.mapInArrow(cut, schema)


def full_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines with a word: text, start of the line, first byte of a word, end of the last word."""
    starts, ends, docs = tk.lines(data, offsets)
    word = tk.WORD_BYTE[data]
    at = np.flatnonzero(word)
    sums = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(word, out=sums[1:])
    f = np.flatnonzero(sums[ends] > sums[starts])
    return docs[f], starts[f], at[sums[starts[f]]], at[sums[ends[f]] - 1] + 1


def least_windows(docs: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of the shortest passages from every line onwards and up to every line.

    A passage has ``MIN_LINES`` lines and, joined by newlines, ``MIN_BYTES``
    bytes.  One of any length is covered by those inside it: up to the end of
    the window at its first line by that one, beyond by windows that end there.
    """
    n = len(docs)
    k = np.arange(n)
    upto = np.concatenate([[0], np.cumsum(stops - begins + 1)])
    onwards = np.maximum(np.searchsorted(upto, upto[:-1] + MIN_BYTES + 1) - 1, k + MIN_LINES - 1)
    back = np.minimum(np.searchsorted(upto, upto[1:] - MIN_BYTES - 1, side="right") - 1, k - MIN_LINES + 1)
    ok, ok_back = onwards < n, back >= 0
    ok[ok] = docs[onwards[ok]] == docs[ok]
    ok_back[ok_back] = docs[back[ok_back]] == docs[ok_back]
    pairs = np.unique(np.concatenate([k[ok] * (n + 1) + onwards[ok], back[ok_back] * (n + 1) + k[ok_back]]))
    return pairs // (n + 1), pairs % (n + 1)


def content_chunks(h: np.ndarray, docs: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of the content-defined chunks that are long enough to go."""
    n = len(h)
    edge = np.ones(n + 1, dtype=bool)
    edge[1:n] = _cuts(h, docs)[: n - 1] | (docs[1:] != docs[:-1]) if n else False
    at = np.flatnonzero(edge)
    first, last = at[:-1], at[1:] - 1
    upto = np.concatenate([[0], np.cumsum(stops - begins + 1)])
    long = (last - first + 1 >= MIN_LINES) & (upto[last + 1] - upto[first] - 1 >= MIN_BYTES)
    return first[long], last[long]


def window_table(slim: DataFrame, with_bytes: bool) -> DataFrame:
    """(h, doc_id, text_id, at, stop[, body]) of every chunk and least window; white space around a line's words is left out."""
    names = ["h", "doc_id", "text_id", "at", "stop"] + ["body"] * with_bytes

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = np.asarray(batch.column(0).is_valid().to_numpy(zero_copy_only=False))
            text_ids = batch.column(2).to_numpy(zero_copy_only=False)
            data, offsets = tk.packed(batch.column(1))
            for i, _, part, at in tk.chunks(data, offsets):
                docs, _, begins, stops = full_lines(part, at)
                line = tk.Hasher(part).spans(begins, stops)
                n = len(docs)
                pairs = np.unique(np.concatenate([x * (n + 1) + y for x, y in (content_chunks(line, docs, begins, stops), least_windows(docs, begins, stops))]))
                a, b = pairs // (n + 1), pairs % (n + 1)
                keep = known[i + docs[a]]
                a, b = a[keep], b[keep]
                up, down = tk.powers(n + 1)
                sums = np.zeros(n + 1, dtype=np.uint64)
                np.cumsum(line * up[:-1], out=sums[1:])
                h = tk.mix((sums[b + 1] - sums[a]) * down[a] + (b - a + 1).astype(np.uint64)).view(np.int64)
                d = docs[a]
                arrays = [pa.array(h), batch.column(0).take(pa.array(i + d)), *(pa.array(x) for x in (text_ids[i + d], begins[a] - at[d], stops[b] - at[d]))]
                if with_bytes:
                    raw = part.tobytes()
                    bodies = [raw[x:y] for x, y in zip(begins[a].tolist(), stops[b].tolist())]
                    # Where more than a newline lies between two lines, it is left out.
                    gaps = np.concatenate([[0, 0], np.cumsum(begins[1:] != stops[:-1] + 1)])
                    for k in np.flatnonzero(gaps[b + 1] > gaps[a + 1]).tolist():
                        bodies[k] = b"\n".join(raw[begins[x] : stops[x]] for x in range(a[k], b[k] + 1))
                    arrays.append(pa.array(bodies, pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names)

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(find, f"h long, doc_id {kind}, text_id long, at long, stop long" + ", body binary" * with_bytes)


def dedup_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", with_counters: bool = True) -> DataFrame:
    """Remove every passage of several lines that an earlier place of the corpus has.

    A passage is a run of at least ``MIN_LINES`` lines with a word, of at least
    ``MIN_BYTES`` bytes.  Places are ordered by id, then position; a line goes
    if some passage around it lies at an earlier place as well, and that place
    does not overlap it.  So of each line that goes an equal one stays earlier.

    Returns the input rows with the text shortened, and with the columns
    ``n_lines_removed``, ``n_chunks_removed`` (runs of lines that went) and
    ``n_bytes_removed`` (columns of these names are replaced; without
    ``with_counters`` no column is).  Null, empty and one-line texts come back
    as they are, very long ones are read whole; rows with a null id keep all and
    make nothing go; rows repeated under one id keep the same lines, different
    texts under one id are ordered by their hash; an empty table stays empty.  A text may become empty.  Blank
    lines go with the line before them; they and white space around a line's
    words do not count in the comparison.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_id"))
    # Repeated hashes: narrow rows with map-side minima, whatever the passage's size or number.
    place = F.struct("doc_id", "text_id", "at", "stop")
    seen = window_table(slim, False).groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = settled(seen.where("first <> last").select("h", "first"))
    # While they are few, windows meet them before any shuffle.
    known = F.broadcast(repeated) if repeated.count() <= BROADCAST_HASHES else repeated
    again = window_table(slim, True).join(known, "h").withColumn("same_text", F.expr("doc_id = first.doc_id AND text_id = first.text_id"))
    firsts = again.where("same_text AND at = first.at").select("h", F.col("body").alias("first_body")).dropDuplicates(["h"])
    later = again.where("NOT same_text OR at >= first.stop").select("h", "doc_id", "text_id", "at", "stop", "body")
    going, going_id, going_text = unused(docs.columns, "_gone", "_gone_id", "_gone_text")
    gone = later.join(firsts, "h").where("body = first_body").groupBy(F.col("doc_id").alias(going_id), F.col("text_id").alias(going_text))
    gone = gone.agg(F.collect_set(F.struct("at", "stop")).alias(going)).select(going_id, going_text, F.col(f"{going}.at").alias(going), F.col(f"{going}.stop").alias(f"{going}_stop"))

    counters = ["n_lines_removed", "n_chunks_removed", "n_bytes_removed"] if with_counters else []
    kept = docs.drop(*counters)
    joined = kept.join(gone.hint("shuffle_hash"), (F.col(id_col) == F.col(going_id)) & (F.xxhash64(text_col) == F.col(going_text)), "left").drop(going_id, going_text)
    text_at, gone_at = joined.columns.index(text_col), len(joined.columns) - 2

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, at, stop = batch.column(text_at), batch.column(gone_at), batch.column(gone_at + 1)
            data, offsets = tk.packed(column)
            touched = np.flatnonzero(np.asarray(at.is_valid().to_numpy(zero_copy_only=False)))
            n_lines, n_chunks, n_bytes = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            keep = np.ones(len(data), dtype=bool)
            for d in touched.tolist():
                part = data[offsets[d] : offsets[d + 1]]
                _, starts, begins, stops = full_lines(part, np.array([0, len(part)]))
                edges = np.zeros(len(starts) + 1, dtype=np.int64)
                np.add.at(edges, np.searchsorted(begins, at[d].values.to_numpy()), 1)
                np.add.at(edges, np.searchsorted(stops, stop[d].values.to_numpy()) + 1, -1)
                going = np.cumsum(edges[:-1]) > 0
                # The first line takes what lies before it along, every line what lies up to the next.
                bounds = np.concatenate([[0], starts[1:], [len(part)]])
                gone_bytes = np.repeat(going, np.diff(bounds))
                keep[offsets[d] : offsets[d + 1]] = ~gone_bytes
                n_lines[d], n_chunks[d], n_bytes[d] = going.sum(), (going & ~np.append(False, going[:-1])).sum(), gone_bytes.sum()
            if len(touched):
                left = np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int64)
                text = pa.LargeStringArray.from_buffers(batch.num_rows, pa.py_buffer(left.tobytes()), pa.py_buffer(data[keep].tobytes())).cast(pa.string())
                column = pc.if_else(column.is_valid(), text, pa.scalar(None, pa.string()))
            columns = list(batch.columns[:gone_at])
            columns[text_at] = column
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, (n_lines, n_chunks, n_bytes)[: len(counters)])], [*batch.schema.names[:gone_at], *counters])

    schema = T.StructType([*kept.schema.fields, *(T.StructField(c, T.LongType()) for c in counters)])
    return joined.mapInArrow(cut, schema)


def line_dedup_digest(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``dedup_passages`` leaves of every document: id, the three counters, and its size and hash."""
    out = dedup_passages(docs.select(id_col, text_col), id_col=id_col, text_col=text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return out.select(id_col, "n_lines_removed", "n_chunks_removed", "n_bytes_removed", F.octet_length(text).cast("long").alias("n_bytes_kept"), F.sha2(text, 256).alias("kept_sha256"))
