"""SimHash near-dedup with bit-sliced comparison.

Fingerprints are made per text in Arrow batches.  Equal ones are merged first,
so copies cost nothing later.  Only rows that share a key are compared.  For a
small radius a key leaves out ``radius`` of the blocks of the fingerprint, and
every such choice is one, so no pair is missed; for a large one keys sample
bits, so often that a pair at the stated similarity is found with probability
RECALL; such pairs are candidates only, and their shingle sets decide: the rows that
are in such a pair take their sets along to the cell and are compared there, so pairs
leave a cell only as links, fewer than it has rows.  Rows of a key are laid out as bit planes, and all distances of a shift
are counted at once by carry-save adders over 64 lanes a word.  A run of lanes
is abandoned once all exceed the radius.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, release, small, split_by_ids

SEED = 42
RADIUS = 2
BLOCKS = 5
CELL = 4096
RECALL = 0.99
FILL = 1000
LANES = 1 << 16
CHUNK = 1 << 15
#: Shingles in the sets of a cell, and bytes of rows held until whole cells are compared.
CELL_SHINGLES = 1 << 21
HELD_BYTES = 1 << 25


def shingles(text: str | None, words: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a text in lower case, and where each of its shingles starts and ends."""
    data = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not data:
        return data, np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(data)]))
    return data, starts[: max(1, len(starts) - words + 1)], ends[min(words, len(ends)) - 1 :]


def shingle_set(text: str | None, words: int) -> set[bytes]:
    data, starts, ends = shingles(text, words)
    return {data[a:b] for a, b in zip(starts.tolist(), ends.tolist())}


def fingerprint(text: str | None, words: int = 3, bits: int = 64) -> list[int]:
    """Majority bits of the XXH64 values of all word shingles, 64 to a number and
    seed; 0 without words."""
    return _majority(*shingles(text, words), bits)


def _majority(data: bytes, starts: np.ndarray, ends: np.ndarray, bits: int) -> list[int]:
    counts = np.zeros((bits // 64, 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        pairs = list(zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist()))
        for k in range(bits // 64):
            hashes = np.array([digest(data[a:b], SEED + k) for a, b in pairs], "<u8")
            counts[k] += np.unpackbits(
                hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
            ).sum(axis=0, dtype=np.int64)
    return [sum(1 << i for i in np.flatnonzero(row * 2 > len(starts)).tolist()) for row in counts]


def _hash_set(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different 64-bit hashes of the shingles, ascending, and where each is first."""
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], "<u8")
    return np.unique(hashes, return_index=True)


def set_fingerprint(text: str | None, words: int, bits: int) -> tuple[list[int], int, bytes]:
    """Fingerprint of the different shingles, each counted once, their number, and
    a digest of 128 bits that equal sets share."""
    data, starts, ends = shingles(text, words)
    hashes, first = _hash_set(data, starts, ends)
    return _majority(data, starts[first], ends[first], bits), len(first), xxhash.xxh3_128_digest(hashes.tobytes())


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", words=3, bits=64) -> DataFrame:
    """(id, fp) of every row; fp holds the bits as an array of signed longs."""

    def run(batches):
        for batch in small(batches):
            made = np.array([fingerprint(x, words, bits) for x in batch.column(1).to_pylist()], np.uint64)
            made = made.reshape(batch.num_rows, bits // 64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(made), pa.list_(pa.int64()))], names=["id", "fp"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, fp array<long>")


def set_fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int, bits: int) -> DataFrame:
    """(id, fp, size, digest) of every row, of its set of shingles."""

    def run(batches):
        for batch in small(batches):
            made = [set_fingerprint(x, words, bits) for x in batch.column(1).to_pylist()]
            fps = np.array([fp for fp, _, _ in made], np.uint64).reshape(len(made), bits // 64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(list(fps), pa.list_(pa.int64())),
                    pa.array([n for _, n, _ in made], pa.int64()), pa.array([d for _, _, d in made], pa.binary()),
                ],
                names=["id", "fp", "size", "digest"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, fp array<long>, size long, digest binary")


def block_masks(radius: int, bits: int = 64, blocks: int = BLOCKS) -> list[int]:
    """Masks of the bits that stay when ``radius`` of the blocks are left out."""
    edges = [bits * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    full = (1 << bits) - 1
    return [full ^ sum(out) for out in combinations(parts, radius)]


def _apart(similarity: float) -> float:
    """Share of the bits in which sets of this Jaccard differ, by the angle of their counts."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def _distances(similarity: float, bits: int) -> np.ndarray:
    """Probability of each distance of two fingerprints whose sets have this Jaccard."""
    apart = _apart(similarity)
    return np.array([math.comb(bits, d) * apart**d * (1 - apart) ** (bits - d) for d in range(bits + 1)])


def candidate_radius(similarity: float, bits: int, recall: float = RECALL) -> int:
    """The radius that leaves out pairs of this Jaccard with an eighth of the loss that
    ``recall`` allows; the keys may use the rest."""
    within = np.cumsum(_distances(similarity, bits))
    return int(np.searchsorted(within, 1 - (1 - recall) / 8))


def sampled_masks(rows: int, similarity: float, bits: int, radius: int, recall: float = RECALL) -> list[int]:
    """Masks of random bits, for so many keys that two texts of this shingle
    similarity (Jaccard) are within ``radius`` and share a key with probability ``recall``.

    All masks look at the same differing bits of a pair, so its miss is that of
    its distance to the power of the masks, averaged over the distances.  The bits
    of a mask grow with the logarithm of the rows, so that about FILL unrelated
    rows share a key at every size.
    """
    width = max(4, math.ceil(math.log2(max(rows, 1) / FILL))) if rows > FILL else 1
    chance = _distances(similarity, bits)[: radius + 1]
    if chance.sum() < recall:
        raise ValueError(f"a radius of {radius} alone misses more than a recall of {recall} allows")
    agree = np.array([math.comb(bits - d, width) / math.comb(bits, width) for d in range(radius + 1)])
    count = 1
    while chance @ (1 - (1 - agree) ** count) < recall:
        count += 1
    rng = np.random.default_rng(SEED)
    return [sum(1 << int(b) for b in rng.choice(bits, width, replace=False)) for _ in range(count)]


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """A row of words for each bit; bit i of row b is bit b of fingerprint i."""
    n, numbers = fps.shape
    lanes = -(-n // 64) * 64 + 64  # a spare word, so that a shift has bits to take in
    rows = np.zeros((lanes, 64 * numbers), np.uint8)
    rows[:n] = np.unpackbits(
        np.ascontiguousarray(fps).astype("<u8").view(np.uint8).reshape(n, -1), axis=1, bitorder="little"
    )
    return np.packbits(np.ascontiguousarray(rows.T), axis=1, bitorder="little").view(np.uint64)


def shifted(planes: np.ndarray, shift: int, words: int) -> np.ndarray:
    """``words`` words of every plane, from lane ``shift`` on."""
    at, bit = divmod(shift, 64)
    low = planes[:, at : at + words]
    if not bit:
        return low
    return (low >> np.uint64(bit)) | (planes[:, at + 1 : at + 1 + words] << np.uint64(64 - bit))


def _compare(planes: np.ndarray, other: np.ndarray, lanes: int, radius: int, run: int = 64) -> np.ndarray:
    """True where the bits of a lane differ in ``radius`` places at most.

    Counters are bit planes as well.  Two difference planes at a time enter a
    carry-save adder with the lowest counter, and its carries ripple upwards;
    ``over`` collects lanes beyond the radius.  Runs of ``run`` words in which every lane
    is over are left out from then on.
    """
    words = -(-lanes // 64)
    width = max(2, (radius + 1).bit_length())
    alive = np.arange(words)
    over = np.zeros(words, np.uint64)
    if lanes % 64:
        over[-1] = ~np.uint64((1 << (lanes % 64)) - 1)
    counters = np.zeros((width, words), np.uint64)
    left, right = planes[:, :words], other[:, :words]
    for at in range(0, len(left), 8):
        for b in range(at, at + 8, 2):
            x, y = left[b] ^ right[b], left[b + 1] ^ right[b + 1]
            ones = counters[0]
            half = ones ^ x  # ones + x + y as a sum plane and a carry plane
            carry = (ones & x) | (half & y)
            counters[0] = half ^ y
            for k in range(1, width):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            over |= carry
        over |= _above(counters, radius)
        full = over == ~np.uint64(0)
        if at + 8 < len(left) and full.any():
            pad = -(-len(full) // run) * run
            dead = np.ones(pad, bool)
            dead[: len(full)] = full
            keep = np.repeat(~dead.reshape(-1, run).all(axis=1), run)[: len(full)]
            if not keep.all():
                alive, over, counters = alive[keep], over[keep], counters[:, keep]
                left, right = left[:, keep], right[:, keep]
                if not len(alive):
                    break
    near = np.zeros(words, np.uint64)
    near[alive] = ~over
    return np.unpackbits(near.view(np.uint8), bitorder="little")[:lanes].astype(bool)


def _above(counters: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is larger than ``radius``."""
    more = np.zeros_like(counters[0])
    equal = ~more
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            more |= equal & counters[k]
            equal = equal & ~counters[k]
    return more


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def near_rows(cells: np.ndarray, fps: np.ndarray, radius: int):
    """Yields arrays (x, y) of the places of near rows of one cell, every pair once."""
    order = np.argsort(cells, kind="stable")
    _, first, sizes = np.unique(cells[order], return_index=True, return_counts=True)
    by_size = np.argsort(sizes, kind="stable")[::-1]  # large cells in front: later shifts see a prefix
    rows = np.concatenate([order[first[i] : first[i] + sizes[i]] for i in by_size]) if len(by_size) else order
    cells = cells[rows]
    ends = np.cumsum(sizes[by_size])
    planes = bit_planes(fps[rows])
    for shift in range(1, int(sizes.max()) if len(sizes) else 0):
        stop = int(ends[np.searchsorted(-sizes[by_size], -shift, side="left") - 1])
        for at in range(0, stop - shift, LANES):
            lanes = min(LANES, stop - shift - at)
            words = -(-lanes // 64)
            near = _compare(planes[:, at // 64 : at // 64 + words], shifted(planes, at + shift, words), lanes, radius)
            hit = np.flatnonzero(near & (cells[at : at + lanes] == cells[at + shift : at + shift + lanes])) + at
            if len(hit):
                yield rows[hit], rows[hit + shift]


def link_cells(cells: np.ndarray, ids: np.ndarray, fps: np.ndarray, radius: int):
    """Pairs of ids that join the near rows of each cell into its components.

    At most one pair per row comes out: a row and the first row of its component.
    """
    parent = np.arange(len(ids))
    for x, y in near_rows(cells, fps, radius):
        a, b = parent[x], parent[y]
        while (apart := a != b).any():
            low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            np.minimum.at(parent, high, low)
            parent = _roots(parent)
            a, b = parent[x], parent[y]
    linked = np.flatnonzero(parent != np.arange(len(ids)))
    return ids[linked], ids[parent[linked]]


def candidate_cells(cells, ids, fps, groups, sizes, radius: int, similarity: float, spanning: bool):
    """Yields arrays (a, b) of ids of near rows of one cell that are of different
    groups and whose sets are not too unlike in size for the similarity.

    With ``spanning`` only so many pairs come out as join all of these groups,
    less than there are groups; a pair is always two near rows.
    """
    _, of = np.unique(groups, return_inverse=True)
    parent = np.arange(of.max() + 1 if len(of) else 0)
    for x, y in near_rows(cells, fps, radius):
        fit = np.minimum(sizes[x], sizes[y]) >= similarity * np.maximum(sizes[x], sizes[y]) * (1 - 1e-12)
        x, y = x[fit], y[fit]
        while True:
            a, b = parent[of[x]], parent[of[y]]
            apart = a != b
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            if not len(x):
                break
            if not spanning:
                yield ids[x], ids[y]
                break
            low, high = np.minimum(a, b), np.maximum(a, b)
            order = np.lexsort((low, high))
            chosen = order[np.unique(high[order], return_index=True)[1]]
            yield ids[x[chosen]], ids[y[chosen]]
            parent[high[chosen]] = low[chosen]
            parent = _roots(parent)


def in_cells(reps: DataFrame, masks: list[int], cell: int = CELL, numbered: bool = False) -> DataFrame:
    """The rows of ``reps`` (id, fp and more) once for each cell they are in, sorted by ``cell``;
    with ``numbered`` also the number of the cell's mask, as ``mask``.

    A key with more than ``cell`` rows is dealt out over pairs of its parts, so
    every pair still meets in one cell and no cell has over twice ``cell`` rows
    on average.
    """
    numbers = -(-max(m.bit_length() for m in masks) // 64)

    def masked(mask):
        parts = [(mask >> 64 * i) & (1 << 64) - 1 for i in range(numbers)]
        signed = [m - (1 << 64) if m >> 63 else m for m in parts]
        return F.xxhash64(*[
            F.get("fp", F.lit(i)).bitwiseAND(F.lit(m).cast("long")) for i, m in enumerate(signed)
        ])

    keyed = reps.select(
        *reps.columns,
        F.explode(
            F.array(*[
                F.struct(F.lit(i).alias("mask"), masked(m).alias("key")) for i, m in enumerate(masks)
            ])
        ).alias("k"),
    ).select(*reps.columns, "k.mask", "k.key")
    crowded = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / F.lit(cell)).cast("int")
    return (
        keyed.join(crowded, ["mask", "key"])
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            F.xxhash64(
                "mask", "key", F.least("part", "other"), F.greatest("part", "other")
            ).alias("cell"),
            *reps.columns,
            *(["mask"] if numbered else []),
        )
        .repartition("cell")
        .sortWithinPartitions("cell")
    )


def _whole_cells(batches):
    """Columns of LANES rows or HELD_BYTES or more, from Arrow batches sorted by their first column;
    no cell is torn."""
    held, rows, size = [], 0, 0
    for batch in batches:
        columns = [
            c.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).view(np.uint64)
            if pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False)
            for c in batch.columns
        ]
        held.append(columns)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= LANES or size >= HELD_BYTES:
            whole = [np.concatenate(x) for x in zip(*held)]
            stop = int(np.searchsorted(whole[0], whole[0][-1]))  # the last cell may go on
            if stop:
                yield [x[:stop] for x in whole]
            held, rows, size = [[x[stop:] for x in whole]], len(whole[0]) - stop, 0
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def near_links(reps: DataFrame, masks: list[int], radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """Links (a, b) between ids of distinct fingerprints (id, fp) that join all
    pairs within ``radius`` bits that share a key into the same components."""

    def run(batches):
        for cells, ids, fps in _whole_cells(batches):
            a, b = link_cells(cells, ids, fps, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return in_cells(reps.select("id", "fp"), masks, cell).mapInArrow(run, "a long, b long")


def _first_shared(apart: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Number of the first mask under which fingerprints that differ in ``apart`` are equal."""
    first = np.full(len(apart), len(masks))
    for k in range(len(masks) - 1, -1, -1):
        first[~(apart & masks[k]).any(axis=1)] = k
    return first


def _near_places(cells, fps, sizes, mask, masks: np.ndarray, radius: int, similarity: float):
    """Yields arrays (x, y) of the places of near rows that may be similar, each pair
    only in the cell of the first key that it shares."""
    places = np.arange(len(cells))
    for x, y in candidate_cells(cells, places, fps, places, sizes, radius, similarity, False):
        own = _first_shared(fps[x] ^ fps[y], masks) == mask[x]
        yield x[own], y[own]


def _mask_numbers(masks: list[int], numbers: int) -> np.ndarray:
    return np.array([[m >> 64 * i & (1 << 64) - 1 for i in range(numbers)] for m in masks], np.uint64)


def candidates(
    reps: DataFrame, masks: list[int], radius: int, similarity: float, bits: int, cell: int = CELL
) -> DataFrame:
    """The rows of ``reps`` (id, tag, fp, size) in each cell (cell, mask) where they are near
    another row that may be similar."""
    parts = _mask_numbers(masks, bits // 64)

    def run(batches):
        for cells, ids, tags, fps, sizes, mask in _whole_cells(batches):
            near = np.zeros(len(cells), bool)
            for x, y in _near_places(cells, fps, sizes, mask, parts, radius, similarity):
                near[x] = near[y] = True
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cells[near]), pa.array(ids[near]), pa.array(tags[near]),
                    pa.array(list(fps[near].view(np.int64)), pa.list_(pa.int64())),
                    pa.array(sizes[near]), pa.array(mask[near]),
                ],
                names=["cell", "id", "tag", "fp", "size", "mask"],
            )

    dealt = in_cells(reps.select("id", "tag", "fp", "size"), masks, cell, True)
    return dealt.mapInArrow(run, "cell long, id long, tag long, fp array<long>, size long, mask int")


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, words: int, wanted: DataFrame) -> DataFrame:
    """(id, tag, hashes) of the ``wanted`` (id, tag): the hashes of a text's shingles, ascending, as bytes."""

    def run(batches):
        for batch in small(batches):
            sets = [_hash_set(*shingles(x, words))[0].tobytes() for x in batch.column(1).to_pylist()]
            digests = pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), digests, pa.array(sets, pa.binary())], names=["id", "digest", "hashes"]
            )

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    near, _ = split_by_ids(texts, "id", wanted.select("id"))
    made = near.mapInArrow(run, "id long, digest binary, hashes binary")
    named = made.select("id", F.xxhash64("digest").alias("tag"), "hashes")
    return named.join(wanted, ["id", "tag"], "left_semi").dropDuplicates(["id", "tag"])


def similar_rows(ids, sets, pairs, similarity: float) -> tuple[list, list]:
    """Links (a, b) of ids that join all ``pairs`` of places whose sets have a Jaccard of
    ``similarity`` or more; fewer than there are ids.  A pair that is joined already is not looked at."""
    parent, a, b = list(range(len(ids))), [], []

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for x, y in pairs:
        for i, j in zip(x.tolist(), y.tolist()):
            low, high = sorted((root(i), root(j)))
            if low == high:
                continue
            s, t = np.frombuffer(sets[i], "<u8"), np.frombuffer(sets[j], "<u8")
            both = len(np.intersect1d(s, t, assume_unique=True))
            if both >= similarity * (len(s) + len(t) - both) * (1 - 1e-12):
                parent[high] = low
                a.append(ids[i])
                b.append(ids[j])
    return a, b


def similar(
    near: DataFrame, sets: DataFrame, masks: list[int], radius: int, similarity: float, bits: int,
    most: int = CELL_SHINGLES,
) -> DataFrame:
    """Links (a, b) between ids that join all rows of a cell of ``near`` (see candidates) whose
    ``sets`` have a Jaccard of ``similarity`` or more.

    A cell whose sets have more than ``most`` shingles is dealt out over pairs of its parts.
    """
    numbers = _mask_numbers(masks, bits // 64)

    def run(batches):
        for cells, ids, fps, sizes, mask, hashes in _whole_cells(batches):
            pairs = _near_places(cells, fps, sizes, mask, numbers, radius, similarity)
            a, b = similar_rows(ids, hashes, pairs, similarity)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    heavy = near.groupBy("cell").agg(F.sum("size").alias("n")).filter(F.col("n") > most)
    parts = F.coalesce(F.ceil(F.col("n") / F.lit(most)), F.lit(1)).cast("int")
    dealt = (
        near.join(heavy, "cell", "left")
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("id", "tag"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("cell", F.xxhash64("cell", F.least("part", "other"), F.greatest("part", "other")))
        .join(sets, ["id", "tag"])
        .select("cell", "id", "fp", "size", "mask", "hashes")
    )
    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")


def near_groups(
    docs: DataFrame, id_col="doc_id", text_col="text", radius: int = RADIUS, words: int = 3, bits: int = 64,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, fp (array of longs), component_id.

    Rows whose fingerprints are within ``radius`` bits are linked, and no such pair
    is missed; component_id is the smallest id reachable.

    Ids are integers; rows without id are left out, as nothing could name them.
    Null, empty and blank texts have fingerprint 0 and are linked like any other.
    Repeated rows give repeated rows.  Other columns are not read; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    made = cut(fingerprints(docs.filter(F.col(id_col).isNotNull()), id_col, text_col, words, bits))
    reps = cut(made.groupBy("fp").agg(F.min("id").cast("long").alias("id")))
    links = cut(near_links(reps, block_masks(radius, bits), radius).distinct())
    release(spark)
    found = components(links)
    named = reps.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "fp", F.coalesce("component", "id").alias("component_id")
    )
    return made.join(named, "fp").select(F.col("id").alias(id_col), "fp", F.col("component_id"))


def near_dedup(
    docs: DataFrame, id_col="doc_id", text_col="text", similarity: float = 0.8, words: int = 5,
    bits: int = 128,
) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest id.

    Texts are linked if the Jaccard of their shingle sets is ``similarity`` or more;
    fingerprints only find the pairs to look at.  Equal sets are merged first.  Pairs
    are looked at in the task of their cell, unless links found there join them
    already, so within a group of near copies most pairs need no look, and no step
    makes a row for each pair.  Rows without id stay, as they are in no group; of
    repeated rows with one id all stay or none.
    """
    spark = docs.sparkSession
    named = docs.filter(F.col(id_col).isNotNull())
    made = cut(set_fingerprints(named, id_col, text_col, words, bits))
    reps = cut(
        made.groupBy("digest").agg(
            F.min("id").cast("long").alias("id"), F.first("fp").alias("fp"), F.first("size").alias("size")
        )
    )
    radius = candidate_radius(similarity, bits)
    masks = sampled_masks(reps.count(), similarity, bits, radius)
    tagged = reps.withColumn("tag", F.xxhash64("digest"))
    near = cut(candidates(tagged, masks, radius, similarity, bits))
    release(spark)
    sets = shingle_sets(named, id_col, text_col, words, cut(near.select("id", "tag").distinct()))
    found = components(similar(near, sets, masks, radius, similarity, bits))
    release(spark)
    merged = reps.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component")
    )
    gone = cut(made.join(merged, "digest").filter("id != component").select(F.col("id").alias(id_col)).distinct())
    near, other = split_by_ids(docs, id_col, gone)
    return near.join(gone, id_col, "left_anti").select(*docs.columns).unionByName(other)
