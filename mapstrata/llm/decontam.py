"""Benchmark decontamination under edit distance.

A document leaks an item if one of its item-sized windows of words is within
the edit radius of the item.  Windows and items are embedded by the random walk
of Chakraborty, Goldenberg and Koucky: both walk over their words and copy the
current one at each step, advancing or not by a random bit that depends on step
and word.  Small edit distances become small Hamming distances, which repeated
bit sampling finds: windows that agree with an item on the sampled steps of one
repetition are candidates.  Candidates are verified by the exact edit distance.

A window within the radius shares one of ``radius + 1`` disjoint pieces of the
item unchanged, so only windows around such a piece are embedded; this drops no
window that could match.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small, split_by_ids
from .substring import Windows, mixed

SIMILARITY = 0.8
RECALL = 0.995
SAMPLED = 3
ITEM_BLOCK = 4 << 20
WORD = re.compile(r"\w+")


def text_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def radius_of(n: int, similarity: float) -> int:
    return math.floor((1 - similarity) * n + 1e-9)


def edit_distance(a, b) -> int:
    """Word insertions, deletions and substitutions; one bit per word of ``a``."""
    if not len(a):
        return len(b)
    masks: dict = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    last, full = 1 << (len(a) - 1), (1 << len(a)) - 1
    up, down, score = full, 0, len(a)
    for x in b:
        eq = masks.get(x, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | ~(diagonal | up) & full, up & diagonal
        score += bool(plus & last) - bool(minus & last)
        plus, minus = (plus << 1 | 1) & full, minus << 1 & full
        up, down = minus | ~(diagonal | plus) & full, plus & diagonal
    return score


def embed(rows: np.ndarray, seed: int, steps: np.ndarray) -> np.ndarray:
    """The symbols that the walks over ``rows`` copy at the sorted ``steps``; 0 past the end."""
    n, length = rows.shape
    at = np.zeros(n, np.int64)
    lines = np.arange(n)
    padded = np.concatenate([rows, np.zeros((n, 1), rows.dtype)], axis=1)
    out = np.zeros((n, len(steps)), np.int64)
    k = 0
    for step in range(int(steps[-1]) + 1):
        symbol = padded[lines, np.minimum(at, length)]
        while k < len(steps) and steps[k] == step:
            out[:, k] = symbol
            k += 1
        salt = np.uint64(((seed << 20) + step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        at += (mixed(symbol.astype(np.uint64) ^ salt) & np.uint64(1)).astype(np.int64)
    return out


def sampled_steps(seed: int, length: int, sampled: int = SAMPLED) -> np.ndarray:
    return np.sort(np.random.default_rng([7, seed, length]).integers(0, 3 * length, sampled))


def repetitions(length: int, radius: int, recall: float = RECALL, sampled: int = SAMPLED, trials: int = 100, probes: int = 40) -> int:
    """So many repetitions that a pair at the radius collides with probability ``recall``.

    Draws ``trials`` pairs of word sequences with ``radius`` random edits and
    measures how often each of them collides.  The chance of a miss is averaged
    over pairs, as some pairs collide rarely.
    """
    rng = np.random.default_rng([11, length, radius])
    a = rng.integers(1, 1 << 40, (trials, length))
    b = np.zeros_like(a)
    for i in range(trials):
        row = a[i].tolist()
        for _ in range(radius):
            kind, p = rng.integers(3), int(rng.integers(len(row)))
            if kind == 0:
                row[p] = int(rng.integers(1, 1 << 40))
            elif kind == 1:
                row.insert(p, int(rng.integers(1, 1 << 40)))
            elif len(row) > 1:
                del row[p]
        b[i, : len(row[:length])] = row[:length]
    hits = np.zeros(trials)
    for seed in range(probes):
        steps = sampled_steps(seed, length, sampled)
        hits += (embed(a, seed, steps) == embed(b, seed, steps)).all(axis=1)
    chance = np.clip(hits / probes, 1 / (4 * probes), 1 - 1e-9)
    count = 1
    while ((1 - chance) ** count).mean() > 1 - recall and count < 400:
        count += 1
    return count


class Items:
    """One block of the benchmark, prepared for search."""

    def __init__(self, rows, similarity: float):
        self.vocabulary: dict[str, int] = {}
        self.items = []  # (id, words as numbers, radius)
        for item, text in rows:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in text_words(text)]
            if words:
                self.items.append((item, np.array(words, np.int64), radius_of(len(words), similarity)))
        windows = Windows()
        pieces: dict[int, dict[int, list]] = {}
        for k, (_, words, radius) in enumerate(self.items):
            cuts = [len(words) * i // (radius + 1) for i in range(radius + 2)]
            hashes = symbols(words)
            for a, b in zip(cuts, cuts[1:]):
                value = int(windows(hashes[a:b], b - a)[0])
                pieces.setdefault(b - a, {}).setdefault(value, []).append((k, a))
        # Which pairs of words a piece begins with; a piece of one word is looked up itself.
        self.begins = np.zeros(1 << 20, bool)
        self.pieces = pieces
        for n, found in pieces.items():
            for entries in found.values():
                for k, a in entries:
                    words = self.items[k][1]
                    if n > 1:
                        self.begins[pair_codes(words[a : a + 2])] = True
        coarse = {}  # measured at the next multiple of eight words, which is not easier
        for _, words, radius in self.items:
            n = -(-len(words) // 8) * 8
            if n not in coarse:
                coarse[n] = repetitions(n, radius_of(n, similarity)) if similarity < 1 else 1
        self.repetitions = {len(words): coarse[-(-len(words) // 8) * 8] for _, words, _ in self.items}
        self.sketches = []
        for _, words, _ in self.items:
            n = len(words)
            self.sketches.append([embed(words[None], s, sampled_steps(s, n))[0] for s in range(self.repetitions[n])])


def pair_codes(words: np.ndarray) -> np.ndarray:
    return (words[:-1] * 1_000_003 + words[1:]) & ((1 << 20) - 1)


def symbols(words: np.ndarray) -> np.ndarray:
    return mixed(words.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def find_leaks(text: str | None, items: Items, windows: Windows) -> list[tuple[int, int, int]]:
    """(item index, distance, start word) of the best window per leaked item."""
    get = items.vocabulary.get
    words = np.array([get(w, 0) for w in text_words(text)], np.int64)
    if not words.any():
        return []
    # Words that no item has differ from all symbols, and from each other where they are sampled.
    places = np.flatnonzero(words == 0)
    words[places] = -1 - places
    starts: dict[int, set] = {}
    begun = np.flatnonzero(items.begins[pair_codes(words)] & (words[:-1] > 0) & (words[1:] > 0))
    for n, found in items.pieces.items():
        at = np.flatnonzero(words > 0) if n == 1 else begun[begun <= len(words) - n]
        if not len(at):
            continue
        rows = symbols(words[at[:, None] + np.arange(n)].ravel()).reshape(-1, n)
        for p, value in zip(at.tolist(), windows.rows(rows).tolist()):
            for k, offset in found.get(value, ()):
                size, radius = len(items.items[k][1]), items.items[k][2]
                last = max(len(words) - size, 0)
                low, high = min(max(p - offset - radius, 0), last), min(max(p - offset + radius, 0), last)
                starts.setdefault(k, set()).update(range(low, high + 1))
    leaks = []
    for k, places in starts.items():
        _, item, radius = items.items[k]
        at = np.array(sorted(places), np.int64)
        size = len(item)
        index = at[:, None] + np.arange(size)
        rows = np.where(index < len(words), words[np.minimum(index, len(words) - 1)], 0)
        near = np.zeros(len(at), bool)
        best, item = None, item.tolist()
        for s, sketch in enumerate(items.sketches[k]):
            left = np.flatnonzero(~near)
            if not len(left) or best and not best[0]:
                break
            hit = left[(embed(rows[left], s, sampled_steps(s, size)) == sketch).all(axis=1)]
            near[hit] = True
            for i in hit.tolist():
                distance = edit_distance(item, words[at[i] : at[i] + size].tolist())
                if distance <= radius and (best is None or (distance, at[i]) < best):
                    best = distance, int(at[i])
        if best:
            leaks.append((k, *best))
    return leaks


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The benchmark in blocks of about ``block_bytes`` bytes of text, one in memory at a time."""
    rows = benchmark.select(id_col, text_col).filter(F.col(id_col).isNotNull()).orderBy(id_col, text_col)
    block, size = [], 0
    for row in rows.toLocalIterator():
        block.append((row[0], row[1]))
        size += len((row[1] or "").encode("utf-8", "surrogatepass"))
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text",
    item_col="item_id", item_text_col="text", similarity: float = SIMILARITY,
    block_bytes: int = ITEM_BLOCK,
) -> DataFrame:
    """(``id_col``, ``item_col``, n_words, distance, start) of every leak.

    Words are runs of letters, digits and underscores in lower case.  A leak is
    an item-sized window of the document at a word edit distance of at most
    ``1 - similarity`` of the item's words, found with a probability of RECALL
    or more; of several, the nearest and then first window is told.  A document
    shorter than the item is one window.  The benchmark is a stated query set: it
    is sent to the tasks in blocks of bounded size, so any number of items works.

    Null and wordless texts and items leak nothing; rows without id are left out;
    repeated rows of either table are told once; other columns are not read.
    """
    spark = docs.sparkSession
    item_kind = benchmark.schema[item_col].dataType
    id_kind = docs.schema[id_col].dataType
    schema = f"`{id_col}` {id_kind.simpleString()}, `{item_col}` {item_kind.simpleString()}, n_words long, distance long, start long"
    texts = docs.select(id_col, text_col).filter(F.col(id_col).isNotNull())
    results = None
    for block in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        sent = spark.sparkContext.broadcast(Items(block, similarity))

        def run(batches, sent=sent):
            windows = Windows()
            for batch in small(batches):
                items, found = sent.value, []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for k, distance, start in find_leaks(text, items, windows):
                        item, words, _ = items.items[k]
                        found.append((doc, item, len(words), distance, start))
                columns = list(zip(*found)) if found else [[]] * 5
                kinds = [batch.schema.field(0).type, None, pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, t) if t is not None else pa.array(c, item_arrow) for c, t in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=[id_col, item_col, "n_words", "distance", "start"])

        item_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_kind.simpleString()]
        one = texts.mapInArrow(run, schema)
        results = one if results is None else results.unionByName(one)
    if results is None:
        return spark.createDataFrame([], schema)
    return results.groupBy(id_col, item_col).agg(
        F.min(F.struct("distance", "start", "n_words")).alias("_best")
    ).select(id_col, item_col, "_best.n_words", "_best.distance", "_best.start")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that leak no item; rows without id stay."""
    found = cut(leaks(docs, benchmark, id_col, **options).select(id_col).distinct())
    near, other = split_by_ids(docs, id_col, found)
    return near.join(found, id_col, "left_anti").select(*docs.columns).unionByName(other)
