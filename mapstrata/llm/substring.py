"""Substring dedup with difference-cover anchors.

Every run of ``words`` words that also starts in a document with a smaller id
is removed.  Only windows at cover positions modulo a period are hashed: for
any two offsets the cover has a shift that puts both on it, so a match of
``words`` words shares an aligned anchor of ``words - period + 1`` words.
Anchors that only one document has end the search; around the others the match
is extended, by comparing all windows that contain the anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, release, small, split_by_ids

WORDS = 50
PERIOD = 31
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
PIECE = 1 << 20
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def difference_cover(period: int) -> list[int]:
    """A small set of residues whose differences are all residues.

    Searches for a set in which every difference occurs once, which exists for
    periods such as 7, 13, 21, 31, 57 and 73; else takes residues one by one,
    each time the one that adds most differences.
    """

    def extended(cover, seen):
        if len(seen) == period:
            return cover
        for x in range(cover[-1] + 1, period):
            new = [d for c in cover for d in ((x - c) % period, (c - x) % period)]
            if len(set(new)) == len(new) and not seen & set(new):
                if found := extended([*cover, x], seen | set(new)):
                    return found
        return None

    size = round(period**0.5)
    if size * (size + 1) + 1 == period or size * (size - 1) + 1 == period:
        if found := extended([0], {0}):
            return found
    cover, seen = [0], {0}
    while len(seen) < period:
        added = {
            x: {d for c in cover for d in ((x - c) % period, (c - x) % period)} - seen
            for x in range(period)
        }
        best = max(range(period), key=lambda x: len(added[x]))
        seen |= added[best]
        cover.append(best)
    return sorted(cover)


def word_pieces(text: str | None):
    """The words of a text as lists of bytes; a list covers about PIECE bytes."""
    data = (text or "").encode("utf-8", "surrogatepass")
    at = 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data):  # up to the next blank, so that no word is cut
            blank = np.flatnonzero(BLANK[np.frombuffer(data[end : end + PIECE], np.uint8)])
            if len(blank):
                end += int(blank[0])
                break
            end = min(len(data), end + PIECE)
        yield data[at:end].split()
        at = end


def word_hashes(text: str | None) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    parts = [np.fromiter(map(digest, words), np.uint64, len(words)) for words in word_pieces(text)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


class Windows:
    """Hashes of all runs of words, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self):
        self.powers = {b: (np.ones(1, np.uint64), np.ones(1, np.uint64)) for b in BASES}

    def _powers(self, base: int, n: int):
        up, down = self.powers[base]
        if len(up) < n:
            size = max(n, 2 * len(up))
            made = []
            for step in (base, pow(base, -1, 1 << 64)):
                factors = np.full(size, step, np.uint64)
                factors[0] = 1
                made.append(np.cumprod(factors, dtype=np.uint64))
            self.powers[base] = up, down = tuple(made)
        return up[:n], down[:n]

    def __call__(self, hashes: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        n = len(hashes)
        if n < length:
            return np.zeros(0, np.uint64)
        values = hashes if which == 0 else mixed(hashes ^ np.uint64(BASES[1]))
        up, down = self._powers(BASES[which], n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up, out=sums[1:], dtype=np.uint64)
        return mixed((sums[length:] - sums[:-length]) * down[: n - length + 1])

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """The hash of each row of a matrix, as a window of that length."""
        up, _ = self._powers(BASES[0], hashes.shape[1])
        return mixed((hashes * up).sum(axis=1, dtype=np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _anchor_rows(cover: list[int], period: int, words: int, combined: bool):
    """Anchors of texts: (hash, low, high) of each batch, or (hash, doc, pos) of each anchor."""
    length = words - period + 1
    marks = np.isin(np.arange(period), cover)

    def run(batches):
        windows = Windows()
        for batch in small(batches):
            found, docs, places = [], [], []
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for doc, text in zip(ids, batch.column(1).to_pylist()):
                hashes = word_hashes(text)
                if len(hashes) < words:
                    continue
                all_ = windows(hashes, length)
                at = np.flatnonzero(np.resize(marks, len(all_)))
                found.append(all_[at])
                docs.append(np.full(len(at), doc, np.int64))
                places.append(at.astype(np.int32))
            if not found:
                continue
            h, d, p = np.concatenate(found).view(np.int64), np.concatenate(docs), np.concatenate(places)
            if not combined:
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(d), pa.array(p)], names=["hash", "doc", "pos"])
                continue
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            last = np.concatenate((first[1:], [len(h)])) - 1
            yield pa.RecordBatch.from_arrays([pa.array(h[first]), pa.array(d[first]), pa.array(d[last])], names=["hash", "low", "high"])

    return run


def _window_rows(period: int, words: int):
    """(h1, h2, doc, pos) of every window that contains one of the anchors at ``places``."""

    def run(batches):
        windows = Windows()
        for batch in small(batches):
            out = [[], [], [], []]
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for doc, text, places in zip(ids, batch.column(1).to_pylist(), batch.column(2)):
                hashes = word_hashes(text)
                starts = len(hashes) - words + 1
                marks = np.zeros(starts + 1, np.int32)
                at = np.asarray(places.values)
                np.add.at(marks, np.clip(at - period + 1, 0, starts), 1)
                np.add.at(marks, np.clip(at + 1, 0, starts), -1)
                pos = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
                out[0].append(windows(hashes, words)[pos])
                out[1].append((windows(hashes, words, 1)[pos] >> np.uint64(32)).astype(np.uint32))
                out[2].append(np.full(len(pos), doc, np.int64))
                out[3].append(pos.astype(np.int32))
            if out[0]:
                h1, h2, d, p = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int32)), pa.array(d), pa.array(p)],
                    names=["h1", "h2", "doc", "pos"],
                )

    return run


def kept_words(text: str | None, starts: np.ndarray, words: int, everything: bool):
    """(words, removed words, kept text) after removal of the windows at ``starts``."""
    n, removed, kept, pieces = 0, 0, [], list(word_pieces(text))
    n = sum(map(len, pieces))
    gone = np.zeros(n + 1, np.int64)
    if everything and n >= words:
        gone[0] = 1
    np.add.at(gone, starts, 1)
    np.add.at(gone, np.minimum(starts + words, n), -1)
    gone = np.cumsum(gone[:-1]) > 0
    at = 0
    for piece in pieces:
        mask = gone[at : at + len(piece)]
        at += len(piece)
        left = piece if not mask.any() else [piece[i] for i in np.flatnonzero(~mask)]
        if left:
            kept.append(b" ".join(left))
    return n, int(gone.sum()), b" ".join(kept).decode("utf-8", "surrogatepass")


def substring_dedup(
    docs: DataFrame, id_col="doc_id", text_col="text", words: int = WORDS, period: int = PERIOD
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_words, n_removed, kept_text.

    Windows are judged on the input.  They are compared by 96 hash bits, of two
    independent polynomials; at 10**13 windows the chance of any false match is
    below one in a thousand.  Texts with the same digest are compared once, and
    only the one with the smallest id stays in the search.

    Null and blank texts have no words.  Ids are integers; rows without id match
    nothing and are returned unchanged, as are texts of fewer than ``words``
    words.  Repeated rows with one id are one document: neither removes words of
    the other, and each gets a row.  Other columns are not read.
    """
    if not 1 <= period <= words:
        raise ValueError("the period must be between 1 and the window")
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = texts.filter("id IS NOT NULL AND text IS NOT NULL").withColumn("id", F.col("id").cast("long"))
    digests = known.select("id", F.unhex(F.sha2("text", 256)).alias("digest"))
    first = digests.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    copies = cut(
        digests.join(first.filter("first < last"), "digest").filter("first < id").select("id").distinct()
    )

    cover = difference_cover(period)
    shared = cut(
        known.mapInArrow(_anchor_rows(cover, period, words, True), "hash long, low long, high long")
        .groupBy("hash").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .filter("low < high").select("hash")
    )
    release(spark)
    anchors = cut(
        known.mapInArrow(_anchor_rows(cover, period, words, False), "hash long, doc long, pos int")
        .join(shared, "hash")
        .groupBy("doc").agg(F.collect_list("pos").alias("places"))
        .join(copies.withColumnRenamed("id", "doc"), "doc", "left_anti")
    )
    release(spark)
    near, _ = split_by_ids(known, "id", anchors.select("doc"))
    windows = (
        near.join(anchors, near.id == anchors.doc)
        .select("id", "text", "places")
        .mapInArrow(_window_rows(period, words), "h1 long, h2 int, doc long, pos int")
    )
    lowest = (
        windows.groupBy("h1", "h2").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
        .filter("low < high").select("h1", "h2", "low")
    )
    removed = cut(
        windows.join(lowest, ["h1", "h2"]).filter("low < doc")
        .groupBy("doc").agg(F.collect_set("pos").alias("starts"))
    )
    release(spark)
    marks = removed.withColumn("whole", F.lit(False)).unionByName(
        copies.select(
            F.col("id").alias("doc"), F.array().cast("array<int>").alias("starts"), F.lit(True).alias("whole")
        )
    )
    marks = cut(
        marks.groupBy("doc").agg(
            F.flatten(F.collect_list("starts")).alias("starts"), F.max("whole").alias("whole")
        )
    )
    release(spark)

    def run(batches):
        for batch in small(batches):
            rows = [
                kept_words(text, np.asarray(starts, np.int64) if starts else np.zeros(0, np.int64), words, bool(whole))
                for text, starts, whole in zip(
                    batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
                )
            ]
            n, gone, kept = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                names=[id_col, "n_words", "n_removed", "kept_text"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    changed, same = split_by_ids(texts, "id", marks.select("doc"))
    rows = changed.join(marks, changed.id == marks.doc, "left").select("id", "text", "starts", "whole")
    rows = rows.unionByName(
        same.select(
            "id", "text", F.lit(None).cast("array<int>").alias("starts"), F.lit(None).cast("boolean").alias("whole")
        )
    )
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_removed long, kept_text string")
