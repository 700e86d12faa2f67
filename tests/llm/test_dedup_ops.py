"""The dedup operators against brute force and on edge cases."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from mapstrata.llm import exact_dedup, simhash, substring, suffix
from mapstrata.llm.common import components, split_by_ids

DOCS = "doc_id long, text string"
EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One  two"), (6, "one\ttwo"), (7, "One two"),
    (7, "One two"), (8, "x" * 3000), (9, "x" * 3000), (None, "One two"), (10, "ü" * 700),
]


def frame(spark, rows):
    """Documents with extra columns under names that operators use inside."""
    made = spark.createDataFrame(rows, DOCS)
    return made.selectExpr("*", "1 AS id", "'a' AS digest", "2 AS _place", "3 AS _digest", "4 AS hash", "5 AS doc").repartition(3)


def vocabulary_texts(seed, n, passages=()):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    texts = []
    for _ in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(0, 250))]
        for passage in rng.sample(passages, rng.randint(0, len(passages))) if passages else ():
            at = rng.randint(0, len(text))
            text[at:at] = passage
        texts.append(rng.choice([" ", "  ", "\n"]).join(text))
    return texts


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_exact_groups(spark):
    found = {}
    for r in exact_dedup.exact_groups(frame(spark, EDGES)).collect():
        found.setdefault(r.doc_id, []).append((r.keep_id, r.group_size, r.kept))
    assert found[1] == [(1, 2, True)] and found[2] == [(1, 2, False)] and found[3] == [(3, 1, True)]
    assert found[5] == [(5, 4, True)]  # rows 5, 7, 7 and the one without id
    assert found[7] == [(5, 4, False)] * 2 and found[None] == [(5, 4, False)] and found[6] == [(6, 1, True)]
    assert found[8] == [(8, 2, True)] and found[9] == [(8, 2, False)]


def test_exact_groups_of_clashing_digests(spark):
    from pyspark.sql import functions as F

    docs = frame(spark, EDGES)
    good = exact_dedup.exact_groups(docs).drop("digest").collect()
    weak = exact_dedup.exact_groups(docs, digest=lambda t: F.length(t) % 2, salts=2).drop("digest").collect()
    assert sorted(map(repr, good)) == sorted(map(repr, weak))


def test_exact_dedup_keeps_columns_and_one_row(spark):
    docs = frame(spark, [*EDGES, (4, "one")])
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    rows = sorted(((r.doc_id is None, r.doc_id or 0, r._digest) for r in kept.collect()))
    assert [r[1] for r in rows] == [1, 3, 4, 5, 6, 8, 10] and {r[2] for r in rows} == {3}


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", None, " a", "A b", "a B c d Ü", "x " * 300, "a\x0bb\x1cc d"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == [plain_fingerprint(text)]


def clustered(seed, clusters=25, each=20):
    rng = random.Random(seed)
    made = [
        base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4)))
        for base in (rng.getrandbits(64) for _ in range(clusters)) for _ in range(each)
    ]
    star = made[0]
    made += [star ^ (1 << i) ^ (1 << j) for i in range(15) for j in range(i)]
    return list(dict.fromkeys(m & (1 << 64) - 1 for m in made))


@pytest.mark.parametrize("cell", [4096, 40])
def test_near_links_join_all_pairs_within_the_radius(spark, cell):
    fps = clustered(3)
    near = [(i, j) for i, a in enumerate(fps) for j, b in enumerate(fps[:i]) if (a ^ b).bit_count() <= 2]
    rows = [(i, [f - (1 << 64) if f >> 63 else f]) for i, f in enumerate(fps)]
    reps = spark.createDataFrame(rows, "id long, fp array<long>")
    links = simhash.near_links(reps, simhash.block_masks(2), 2, cell)
    found = dict.fromkeys(range(len(fps)))
    found = {i: i for i in found} | {r.node: r.component for r in components(links).collect()}
    assert found == union(near, range(len(fps)))


@pytest.mark.parametrize("radius", [0, 1, 2, 13, 26])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    a = rng.integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(128, rng.integers(0, 2 * radius + 3), replace=False):
            b[i, bit // 64] ^= np.uint64(1 << int(bit % 64))
    exact = np.unpackbits((a ^ b).view(np.uint8).reshape(5000, -1), axis=1).sum(axis=1) <= radius
    planes = simhash.bit_planes(np.concatenate([a, b]))
    found = simhash._compare(planes[:, :79], simhash.shifted(planes, 5000, 79), 5000, radius)
    assert (found == exact).all() and exact.any()


def test_near_groups_of_edges(spark):
    rows = {}
    for r in simhash.near_groups(frame(spark, EDGES)).collect():
        rows.setdefault(r.doc_id, set()).add((r.fp[0] % (1 << 64), r.component_id))
    assert None not in rows and rows[1] == rows[2] == rows[3] == {(0, 1)}
    assert rows[7] == {(plain_fingerprint("one two"), 5)} and rows[6] == rows[5]


def test_near_dedup_catches_near_copies_only(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    clean = [" ".join(word() for _ in range(200)) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(clean)]
    for i in range(40):
        words = clean[i].split()
        for _ in range(2):
            words[rng.randrange(200)] = word()
        rows.append((1000 + i, " ".join(words)))
    docs = frame(spark, rows)
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(120))


def five_word_sets(rows):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for i, t in rows}
    return {i: {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4)) if w} for i, w in words.items()}


def similar_pairs(rows, least=0.8):
    sets = sorted(five_word_sets(rows).items())
    return [
        (a, b) for k, (b, t) in enumerate(sets) for a, s in sets[:k]
        if s == t or len(s & t) >= least * len(s | t)
    ]


def planted(rng, jaccard, size=240):
    """Two texts of ``size`` different five-word shingles of about this Jaccard, in one cut."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    shared = round(2 * jaccard * size / (1 + jaccard))
    head = [word() for _ in range(shared + 4)]
    return [" ".join(head + [word() for _ in range(size - shared)]) for _ in range(2)]


def test_near_dedup_keeps_texts_below_the_similarity(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for k, jaccard in enumerate([0.5, 0.6, 0.65, 0.7, 0.75, 0.78, 0.95] * 8):
        rows += enumerate(planted(rng, jaccard), 10 * k)
    line = " ".join(word() for _ in range(9))
    for i in range(2):  # unlike texts with one frequent line
        rows.append((5000 + i, f"{' '.join(word() for _ in range(200))} {f'{line} ' * 60}"))
    pairs = similar_pairs(rows)
    assert len(pairs) == 8
    kept = sorted(r.doc_id for r in simhash.near_dedup(frame(spark, rows)).collect())
    assert kept == sorted({i for i, _ in rows} - {b for _, b in pairs})


def test_near_dedup_makes_no_row_for_each_pair(spark):
    """A family of texts that are near and not similar, and a near copy of some: the rows of the
    candidates grow with the texts, the links with the copies."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    head = [word() for _ in range(200)]
    rows = [(i, " ".join(head + [word() for _ in range(50)])) for i in range(60)]
    rows += [(1000 + i, f"{rows[i][1]} {word()}") for i in range(20)]
    assert sorted(similar_pairs(rows)) == [(i, 1000 + i) for i in range(20)]
    made = simhash.set_fingerprints(frame(spark, rows), "doc_id", "text", 5, 128)
    reps = made.withColumn("tag", F.xxhash64("digest"))
    masks = [1, 2, 1 << 100]
    near = simhash.candidates(reps, masks, 32, 0.8, 128).cache()
    assert 80 < near.count() <= len(masks) * len(rows)
    wanted = near.select("id", "tag").distinct()
    sets = simhash.shingle_sets(frame(spark, rows), "doc_id", "text", 5, wanted).cache()
    for most in (1 << 21, 4000):
        links = simhash.similar(near, sets, masks, 32, 0.8, 128, most).collect()
        assert {(min(r), max(r)) for r in links} == {(i, 1000 + i) for i in range(20)} and len(links) <= 60
    kept = sorted(r.doc_id for r in simhash.near_dedup(frame(spark, rows)).collect())
    assert kept == list(range(60))


@pytest.mark.parametrize("rows", [1000, 40_000, 500_000, 15_000_000])
def test_recall_at_the_similarity(rows):
    """Fingerprints of sets of Jaccard 0.8: near enough and on one key at least 0.99 of the time."""
    radius = simhash.candidate_radius(0.8, 128)
    masks = simhash.sampled_masks(rows, 0.8, 128, radius)
    masks = np.array([[m & (1 << 64) - 1, m >> 64] for m in masks], np.uint64)
    rng = np.random.default_rng(rows)
    pairs, n, unique = 20_000, 128, 16  # 128 shared shingles and 16 of each: 0.8
    bits = lambda k: rng.binomial(k, 0.5, (pairs, 128))
    shared = bits(n)
    a, b = ((shared + bits(unique)) * 2 > n + unique for _ in range(2))
    apart = np.packbits(a ^ b, axis=1, bitorder="little").view(np.uint64)
    meet = np.zeros(pairs, bool)
    for m in masks:
        meet |= ~(apart & m).any(axis=1)
    assert ((a ^ b).sum(axis=1) <= radius)[meet].sum() >= 0.988 * pairs


def test_candidates_span_groups_with_near_pairs_only():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 6)
    fps = np.array([[base[i % 6] ^ (1 << int(rng.integers(62))) ^ (1 << int(rng.integers(62)))] for i in range(120)], np.uint64)
    cells, ids, sizes = np.arange(120) // 60, np.arange(120) + 1000, np.full(120, 50)
    groups = np.arange(120) // 3
    near = {
        (i, j) for i in range(120) for j in range(i)
        if cells[i] == cells[j] and groups[i] != groups[j] and (int(fps[i, 0]) ^ int(fps[j, 0])).bit_count() <= 3
    }
    found = [
        {(max(x, y) - 1000, min(x, y) - 1000) for a, b in made for x, y in zip(a.tolist(), b.tolist())}
        for made in (simhash.candidate_cells(cells, ids, fps, groups, sizes, 3, 0.8, spans) for spans in (False, True))
    ]
    assert found[0] == near and found[1] <= near and len(found[1]) < 40
    joined = [union([(groups[i], groups[j]) for i, j in pairs], range(40)) for pairs in found]
    assert joined[0] == joined[1]


def removed_words(rows, size):
    first, texts = {}, {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        texts[doc] = words
        for i in range(len(words) - size + 1):
            key = tuple(words[i : i + size])
            first[key] = min(first.get(key, doc), doc)
    out = {}
    for doc, words in texts.items():
        gone = set()
        for i in range(len(words) - size + 1):
            if first[tuple(words[i : i + size])] < doc:
                gone.update(range(i, i + size))
        out[doc] = (len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone))
    return out


@pytest.mark.parametrize("size, period", [(50, 31), (12, 7), (12, 12), (3, 1)])
def test_substring_dedup(spark, size, period):
    rng = random.Random(size)
    passages = [[f"p{i}{rng.randint(0, 9)}" for _ in range(n)] for i, n in enumerate((size, size - 1, size + 7, 3 * size))]
    texts = vocabulary_texts(size, 60, passages)
    rows = [(i * 3, t) for i, t in enumerate([*texts, texts[3], texts[5], None, "", "ab " * 200, "ab " * 120])]
    found = substring.substring_dedup(frame(spark, rows), words=size, period=period).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in found} == removed_words(rows, size)


def test_substring_dedup_of_edges(spark):
    long = " ".join(map(str, range(80)))
    rows = [(5, long), (5, long), (7, long), (None, long), (None, None)]
    found = sorted(substring.substring_dedup(frame(spark, rows)).collect(), key=repr)
    assert sorted((r.doc_id or -1, r.n_removed) for r in found) == [(-1, 0), (-1, 0), (5, 0), (5, 0), (7, 80)]


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(substring, "PIECE", 7)
    text = "  a bb  ccccccccccccccccc d\ne " * 5
    assert [w for piece in substring.word_pieces(text) for w in piece] == text.encode().split()


@pytest.mark.parametrize("period", [1, 7, 13, 31, 32, 50])
def test_difference_cover(period):
    cover = substring.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def removed_bytes(rows, length):
    counts = collections.Counter(
        t[i : i + length] for t in ((x or "").encode() for _, x in rows) for i in range(len(t) - length + 1)
    )
    out = []
    for doc, text in rows:
        data, gone = (text or "").encode(), bytearray(len((text or "").encode()))
        for i in range(len(data) - length + 1):
            if counts[data[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("crowded", [8192, 2])
@pytest.mark.parametrize("chunk", [1 << 19, 700])
def test_suffix_dedup(spark, monkeypatch, crowded, chunk):
    monkeypatch.setattr(suffix, "CHUNK", chunk)
    rng = random.Random(crowded)
    passages = [["".join(rng.choice("abcdefé") for _ in range(4)) for _ in range(n)] for n in (60, 79, 90, 200)]
    texts = vocabulary_texts(crowded, 40, passages)
    rows = [(i, t) for i, t in enumerate([*texts, texts[2], None, "", "x" * 399, "y" * 401, "ab" * 900, "ü" * 300])]
    rows.append((3, texts[3]))
    found = suffix.suffix_dedup(frame(spark, [*rows, (None, texts[4])]), crowded=crowded).collect()
    made = sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found), key=repr
    )
    assert made == removed_bytes([*rows, (None, texts[4])], 400)


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(i, i + 1) for i in range(500, 560)]
    pairs += [(600, i) for i in range(601, 700)]
    links = spark.createDataFrame(pairs, "a long, b long")
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {n: c for n, c in union(pairs, {n for p in pairs for n in p}).items() if n in nodes}


def test_split_by_ids(spark):
    rows = frame(spark, [(i if i else None, "x") for i in range(2000)])
    near, other = split_by_ids(rows, "doc_id", spark.range(5, 50, 3).toDF("k"))
    assert near.columns == rows.columns == other.columns
    assert {r.doc_id for r in near.collect()} >= set(range(5, 50, 3)) and near.count() + other.count() == 2000


@pytest.mark.parametrize("make", [
    exact_dedup.exact_groups, exact_dedup.exact_dedup, simhash.near_groups, simhash.near_dedup,
    substring.substring_dedup, suffix.suffix_dedup,
])
def test_empty_table(spark, make):
    assert make(frame(spark, [])).collect() == []
