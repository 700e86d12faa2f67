"""Suffix-array dedup: remove every byte of a long string that occurs twice.

Suffixes are dealt into buckets by their content: the bucket of a suffix is the
smallest hash among the grams of its first ``length`` bytes, and its offset to
that gram, so suffixes that agree that far share a bucket.  Buckets of one
member need no sort, and a stretch of suffixes that occurs as a whole elsewhere
is settled by its hash.  The rest is sorted one block of whole buckets at a
time: the suffixes at difference-cover positions of the block are ranked first,
by doubling, and ranks then resolve the long ties of all other suffixes, so a
comparison reads a few bytes and two ranks however long the tie is.  A block
has a bounded number of bytes, and memory does not grow with the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, release, small
from .substring import BASES, Windows, difference_cover, mixed

LENGTH = 400
GRAM = 64
CLASS = 100
PERIOD = 32
CHUNK = 1 << 19
BLOCK = 1 << 21
CROWDED = 8192
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(raw: np.ndarray, windows: Windows, length: int, gram: int):
    """(start, count, anchor position, anchor hash) of the runs of suffixes with one anchor.

    The anchor of a suffix is the last of the grams with the smallest hash.  Texts
    are taken in chunks that overlap, so that each suffix is in one of them.
    """
    width, runs = length - gram + 1, []
    for base in range(0, max(len(raw) - length + 1, 0), CHUNK):
        part = raw[base : base + CHUNK + length - 1]
        hashes = windows(BYTES[part], gram)
        place = np.arange(len(hashes), dtype=np.uint64)
        low = np.uint64((1 << 20) - 1)
        least = _minima(hashes & ~low | low - place, width)
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        at = (low - (least[first] & low)).astype(np.int64)
        count = np.diff(np.concatenate((first, [len(least)])))
        runs.append((first + base, count, at + base, hashes[at]))
    return tuple(map(np.concatenate, zip(*runs))) if runs else (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)


def span_hashes(sums: dict, windows: Windows, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """Hashes of byte spans from the prefix sums of their chunk; the length is part of a hash."""
    values, down = sums[which]
    return mixed((values[ends] - values[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def prefix_sums(raw: np.ndarray, windows: Windows) -> dict:
    out = {}
    for which, base in enumerate(BASES):
        values = BYTES[raw] if which == 0 else mixed(BYTES ^ np.uint64(BASES[1]))[raw]
        up, down = windows._powers(base, len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(values * up[: len(raw)], out=sums[1:], dtype=np.uint64)
        out[which] = sums, down
    return out


def _raw(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _stretches(length: int, gram: int):
    """(bucket, whole, doc, start, n) per run of suffixes: its bucket and the hash of all its bytes."""

    def run(batches):
        windows = Windows()
        for batch in small(batches):
            out = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()):
                raw = _raw(text)
                start, count, _, hashes = anchors(raw, windows, length, gram)
                for base in range(0, len(raw), CHUNK):  # runs do not cross chunks
                    here = slice(*np.searchsorted(start, [base, base + CHUNK]))
                    if here.start == here.stop:
                        continue
                    sums = prefix_sums(raw[base : base + CHUNK + length - 1], windows)
                    a, n = start[here] - base, count[here]
                    out[1].append(span_hashes(sums, windows, a, a + n - 1 + length, 1))
                out[0].append(hashes)
                out[2].append(np.full(len(start), doc, np.int64))
                out[3].append(start)
                out[4].append(count)
            if out[1]:
                b, w, d, s, n = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.view(np.int64)), pa.array(w.view(np.int64)), pa.array(d), pa.array(s), pa.array(n)],
                    names=["bucket", "whole", "doc", "start", "n"],
                )

    return run


def _parts(length: int, gram: int, with_bytes: bool):
    """Classes of suffixes by their offset to the anchor, with the bytes that a class shares.

    Suffixes of one class of CLASS offsets have ``length - CLASS + 1`` bytes in
    common; equal suffixes agree on these, whose hash is the key.
    """

    def run(batches):
        windows = Windows()
        for batch in small(batches):
            rows = []
            for doc, text, places in zip(
                batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist(), batch.column(2)
            ):
                raw, wanted = _raw(text), np.asarray(places.values)
                start, count, at, _ = anchors(raw, windows, length, gram)
                chosen = np.searchsorted(start, wanted)
                found = []
                for i in chosen.tolist():
                    a, n, anchor = int(start[i]), int(count[i]), int(at[i])
                    # Offsets run from anchor - a down to anchor - (a + n - 1).
                    for c in range((anchor - a - n + 1) // CLASS, (anchor - a) // CLASS + 1):
                        first, last = max(a, anchor - c * CLASS - CLASS + 1), min(a + n - 1, anchor - c * CLASS)
                        found.append((first, last - first + 1, anchor - first, anchor - c * CLASS, c))
                found = np.array(found, np.int64).reshape(-1, 5)
                keys = np.zeros((2, len(found)), np.uint64)
                for base in range(0, len(raw), CHUNK):
                    here = np.flatnonzero((found[:, 0] >= base) & (found[:, 0] < base + CHUNK))
                    if not len(here):
                        continue
                    sums = prefix_sums(raw[base : base + CHUNK + 2 * length], windows)
                    a = found[here, 3] - base
                    for which in (0, 1):
                        keys[which, here] = mixed(
                            span_hashes(sums, windows, a, a + length - CLASS + 1, which)
                            + found[here, 4].astype(np.uint64)
                        )
                rows.append((doc, raw, found, keys))
            if not rows or not sum(len(r[2]) for r in rows):
                continue
            keys = np.concatenate([r[3] for r in rows], axis=1).view(np.int64)
            columns, names = [pa.array(keys[0]), pa.array(keys[1])], ["k1", "k2"]
            if with_bytes:
                found = np.concatenate([r[2] for r in rows])
                data = [raw[a : a + n - 1 + length].tobytes() for _, raw, f, _ in rows for a, n in f[:, :2].tolist()]
                docs = np.concatenate([np.full(len(r[2]), r[0], np.int64) for r in rows])
                columns += [pa.array(docs), *(pa.array(found[:, j]) for j in (0, 1, 2)), pa.array(data, pa.binary())]
                names += ["doc", "start", "n", "offset", "data"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def cover_gaps(period: int = PERIOD, most: int = 8) -> np.ndarray:
    """A difference cover in which no gap is longer than ``most``, as a mask of residues."""
    mask = np.zeros(period, bool)
    mask[difference_cover(period)] = True
    gap = 0
    for r in range(period):
        gap = 0 if mask[r] else gap + 1
        if gap >= most:
            mask[r], gap = True, 0
    mask[0] = True
    return mask


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks of the tuples of ``keys``, equal for equal tuples."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def sort_block(cells: np.ndarray, data: list[bytes], counts: np.ndarray, offsets: np.ndarray, length: int) -> list[np.ndarray]:
    """For each piece of a block, which of its suffixes has an equal one in its cell.

    A piece holds ``counts`` suffixes of ``length`` bytes, the first at ``offsets``
    bytes before its anchor.  Pieces are laid out with their anchors at one
    residue of the cover's period.
    """
    mask = cover_gaps()
    sizes = np.array([len(x) for x in data])
    room = -(-(sizes + 2 * PERIOD + 8) // PERIOD) * PERIOD
    ends = np.cumsum(room)
    base = ends - room + (-offsets) % PERIOD
    text = np.zeros(int(ends[-1]) + 8, np.uint8)
    for a, x in zip(base.tolist(), data):
        text[a : a + len(x)] = np.frombuffer(x, np.uint8)
    piece = np.repeat(np.arange(len(data)), sizes)
    inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = base[piece] + inner
    left = sizes[piece] - inner  # bytes up to the end of the piece
    depth = PERIOD
    while depth * 2 <= length - PERIOD:
        depth *= 2
    lines = np.lib.stride_tricks.sliding_window_view(text, 8)

    def load(at):  # eight bytes as one number, in text order
        return np.ascontiguousarray(lines[at]).view(">u8").ravel().astype(np.uint64)

    sample = mask[place % PERIOD] & (left >= PERIOD)
    rank = np.zeros(len(text), np.int64)
    at, rest, size = place[sample], left[sample], PERIOD
    rank[at] = _dense(*(load(at + i) for i in range(0, PERIOD, 8)))
    while size < depth:  # the rank of twice as many bytes is that of two ranks
        keep = rest >= 2 * size
        at, rest = at[keep], rest[keep]
        rank[at] = _dense(rank[at], rank[at + size])
        size *= 2
    # The suffixes in turn: bytes up to the cover, a rank, a later rank, bytes after it.
    ahead = np.array([next(d for d in range(PERIOD) if mask[(r + d) % PERIOD]) for r in range(PERIOD)])
    back = np.array([
        next(d for d in range(length - depth, -1, -1) if mask[(r + d) % PERIOD]) for r in range(PERIOD)
    ])
    suffix = inner < counts[piece]
    at, owner = place[suffix], piece[suffix]
    residue = at % PERIOD
    head, tail = ahead[residue], length - depth - back[residue]

    def leading(at, count):
        shift = (64 - 8 * count).astype(np.uint64)
        return np.where(count > 0, load(at) >> np.minimum(shift, np.uint64(63)), np.uint64(0))

    cell = _dense(cells[owner], offsets[owner] - inner[suffix])
    ranks = _dense(
        cell, leading(at, head), rank[at + head], rank[at + back[residue]],
        leading(at + back[residue] + depth, tail),
    )
    twice = np.bincount(ranks)[ranks] > 1
    return np.split(twice, np.cumsum(counts)[:-1])


def _runs(flags: np.ndarray):
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges[0::2], edges[1::2] - edges[0::2]


def _sorted_blocks(length: int):
    """(doc, start, n) of the repeated suffixes of whole buckets, block by block."""

    def settle(rows):
        k1, k2, doc, start, n, offset, data = rows
        found = sort_block(_dense(k1, k2), data, n, offset, length)
        out = [[], [], []]
        for d, s, flags in zip(doc.tolist(), start.tolist(), found):
            if flags.any():
                a, m = _runs(flags)
                out[0].append(np.full(len(a), d, np.int64))
                out[1].append(a + s)
                out[2].append(m)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["doc", "start", "n"])

    def run(batches):
        held, size = None, 0
        for batch in small(batches):
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)] + [batch.column(6).to_pylist()]
            for at in range(0, batch.num_rows, 1024):
                part = [x[at : at + 1024] for x in rows]
                held = part if held is None else [np.concatenate(p) for p in zip(held[:6], part[:6])] + [held[6] + part[6]]
                size += sum(map(len, part[6]))
                if size >= BLOCK:
                    last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
                    stop = int(last[-1]) + 1 if len(last) else 0
                    if stop:
                        yield from settle([x[:stop] for x in held])
                        held = [x[stop:] for x in held]
                        size = sum(map(len, held[6]))
        if held is not None and len(held[0]):
            yield from settle(held)

    return run


def _suffix_rows(length: int):
    """(h1, h2, doc, start) of every suffix of a piece."""

    def run(batches):
        windows = Windows()
        for batch in small(batches):
            out = [[], [], [], []]
            doc, start, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for d, s, m, x in zip(doc.tolist(), start.tolist(), n.tolist(), batch.column(3).to_pylist()):
                values = BYTES[np.frombuffer(x, np.uint8)]
                out[0].append(windows(values, length)[:m])
                out[1].append(windows(values, length, 1)[:m])
                out[2].append(np.full(m, d, np.int64))
                out[3].append(np.arange(s, s + m))
            if out[0]:
                h1, h2, d, s = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(d), pa.array(s)],
                    names=["h1", "h2", "doc", "start"],
                )

    return run


def repeated_suffixes(
    texts: DataFrame, length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED
) -> DataFrame:
    """(doc, runs) with the runs (start, n) of suffixes of ``texts`` (doc, text) whose
    first ``length`` bytes also start elsewhere."""
    spark = texts.sparkSession
    stretches = texts.mapInArrow(
        _stretches(length, gram), "bucket long, whole long, doc long, start long, n long"
    )
    wholes = stretches.groupBy("bucket", "whole").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc", "start")).alias("first")
    )
    sizes = wholes.groupBy("bucket").agg(F.count("*").alias("kinds"))
    shared = cut(wholes.join(sizes, "bucket").filter("copies > 1 OR kinds > 1"))
    release(spark)
    marked = stretches.join(shared, ["bucket", "whole"]).select(
        "doc",
        "start",
        "n",
        (F.col("copies") > 1).alias("settled"),
        ((F.col("kinds") > 1) & (F.struct("doc", "start") == F.col("first"))).alias("sort"),
    )
    lists = cut(
        marked.groupBy("doc").agg(
            F.collect_list(F.when(F.col("settled"), F.struct("start", "n"))).alias("settled"),
            F.sort_array(F.collect_list(F.when(F.col("sort"), F.col("start")))).alias("places"),
        )
    )
    release(spark)
    wanted = lists.filter(F.size("places") > 0).select("doc", "places")
    chosen = texts.join(wanted, "doc").select("doc", "text", "places")
    keys = cut(
        chosen.mapInArrow(_parts(length, gram, False), "k1 long, k2 long")
        .groupBy("k1", "k2").agg(F.count("*").alias("members")).filter("members > 1")
    )
    release(spark)
    parts = chosen.mapInArrow(
        _parts(length, gram, True),
        "k1 long, k2 long, doc long, start long, n long, offset long, data binary",
    ).join(keys, ["k1", "k2"])
    columns = ["k1", "k2", "doc", "start", "n", "offset", "data"]
    found = (
        parts.filter(F.col("members") <= crowded).select(*columns)
        .repartition("k1", "k2").sortWithinPartitions("k1", "k2")
        .mapInArrow(_sorted_blocks(length), "doc long, start long, n long")
    )
    if not keys.filter(F.col("members") > crowded).isEmpty():
        # A bucket beyond the limit is settled by counting its suffixes' hashes instead.
        rows = (
            parts.filter(F.col("members") > crowded).select("doc", "start", "n", "data")
            .mapInArrow(_suffix_rows(length), "h1 long, h2 long, doc long, start long")
        )
        twice = rows.groupBy("h1", "h2").agg(F.count("*").alias("c")).filter("c > 1").select("h1", "h2")
        found = found.unionByName(
            rows.join(twice, ["h1", "h2"]).select("doc", "start", F.lit(1).cast("long").alias("n"))
        )
    sorted_ = cut(found.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("runs")))
    release(spark)
    return (
        lists.select("doc", F.col("settled").alias("runs")).unionByName(sorted_)
        .groupBy("doc").agg(F.flatten(F.collect_list("runs")).alias("runs"))
        .filter(F.size("runs") > 0)
    )


def suffix_dedup(
    docs: DataFrame, id_col="doc_id", text_col="text", length: int = LENGTH, gram: int = GRAM,
    crowded: int = CROWDED,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_bytes, n_removed, n_spans, kept (binary).

    A byte goes if it is covered by a string of ``length`` bytes that also starts
    elsewhere, in any document or its own; overlaps count and strings are judged
    on the input.  Strings that are settled without a sort are compared by 128
    hash bits.

    Null text counts as empty.  Rows are told apart by a number of their own, so
    repeated rows, repeated ids and rows without id are documents like any other:
    a long text that is given twice is removed twice.  Other columns are not
    read; an empty table gives an empty result.
    """
    if length - CLASS + 1 <= gram or length < 2 * PERIOD + CLASS:
        raise ValueError("the length is too short for the gram")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    repeated = rows.groupBy("id").count().filter("count > 1 OR id IS NULL").select("id")
    if not repeated.isEmpty() or kind not in ("bigint", "int"):
        # Number the rows once and for all; the numbers are written with them.
        rows = cut(rows.select("id", F.monotonically_increasing_id().alias("doc"), "text"))
    else:
        rows = rows.withColumn("doc", F.col("id").cast("long"))
    runs = repeated_suffixes(rows.select("doc", "text"), length, gram, crowded)

    def run(batches):
        for batch in small(batches):
            out = [[], [], [], []]
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2)):
                raw = _raw(text)
                gone = np.zeros(len(raw) + 1, np.int64)
                if spans.is_valid and len(spans.values):
                    start, n = (np.asarray(spans.values.field(i)) for i in (0, 1))
                    np.add.at(gone, start, 1)
                    np.add.at(gone, start + n - 1 + length, -1)
                gone = np.cumsum(gone[:-1]) > 0
                out[0].append(len(raw))
                out[1].append(int(gone.sum()))
                out[2].append(len(_runs(gone)[0]))
                out[3].append(raw[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.binary())],
                names=[id_col, "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return (
        rows.join(runs, "doc", "left").select("id", "text", "runs")
        .mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    )
