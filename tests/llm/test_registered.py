"""The registered corpus queries, and the pipeline stage by stage."""

import hashlib
import random
import re
import sys
from pathlib import Path

import duckdb
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent / "scripts"))
import check_oracle  # noqa: E402
import corpus_pipeline  # noqa: E402
import public_tokenizers  # noqa: E402
from mapstrata.llm import decontam, queries  # noqa: E402
from test_text_ops import encoding, plain_spans  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    connection = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    assert check_oracle.compare(spark, con, name, queries.QUERIES[name], queries.ORACLE_SQL[name], FOLDER) == ""


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL) - {"op4_decontaminate"}))
def test_query_has_a_row_per_document(spark, con, name):
    rows = queries.QUERIES[name](spark, FOLDER).select("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == [r[0] for r in con.sql("SELECT doc_id FROM documents ORDER BY 1").fetchall()]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def plain_op1(texts):
    prints = {}
    for i, text in texts.items():
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {(i, f"{prints[i]:016x}", root(i)) for i in texts}


def plain_op3(texts):
    kinds, rows = ("email", "ip", "card", "phone"), set()
    for i, text in texts.items():
        spans = plain_spans(text)
        counts = [sum(k == at for _, k, _ in spans) for at in range(4)]
        rows.add((i, *counts, sha(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans).encode())))
    return rows


def plain_op5(texts):
    encoder, rows = encoding()[0], set()
    for i, text in texts.items():
        ids = encoder.encode_ordinary(text)
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        rows.add((i, len(ids), sha(packed), sha(text.encode())))
    return rows


def plain_op8(texts):
    data, starts, rows = {i: t.encode() for i, t in texts.items()}, {}, set()
    for i, d in data.items():
        for at in range(len(d) - 399):
            starts.setdefault(d[at : at + 400], []).append((i, at))
    gone = {i: bytearray(len(d)) for i, d in data.items()}
    for places in starts.values():
        if len(places) > 1:
            for i, at in places:
                gone[i][at : at + 400] = b"\x01" * 400
    for i, d in data.items():
        runs = len(re.findall(b"\x01+", bytes(gone[i])))
        kept = bytes(b for b, out in zip(d, gone[i]) if not out)
        rows.add((i, len(d), sum(gone[i]), runs, sha(kept)))
    return rows


def plain_op11(texts):
    library, rows = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), set()
    library.no_truncation()
    library.no_padding()
    for i, text in texts.items():
        n = len(library.encode(text, add_special_tokens=False).ids)
        rows.add((i, len(text.encode()), n, n > 2048))
    return rows


@pytest.mark.parametrize("name, plain, columns", [
    ("op1_simhash", plain_op1, "doc_id fingerprint component_id"),
    ("op3_pii", plain_op3, "doc_id n_email n_ip n_card n_phone base_sha256"),
    ("op5_byte_bpe", plain_op5, "doc_id n_tokens ids_sha256 decoded_sha256"),
    ("op8_suffix_dedup", plain_op8, "doc_id n_bytes n_removed n_spans kept_sha256"),
    ("op11_token_counts", plain_op11, "doc_id n_bytes n_tokens over_limit"),
])
def test_query_equals_plain_version(spark, con, name, plain, columns):
    texts = {i: t or "" for i, t in con.sql("SELECT doc_id, text FROM documents").fetchall()}
    found = [tuple(r) for r in queries.QUERIES[name](spark, FOLDER).select(*columns.split()).collect()]
    assert len(found) == len(texts) and set(found) == plain(texts)


def test_pipeline(spark, con):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (900_001, "", "en", "s", 0), (900_001, "", "en", "s", 0)], docs.schema
    )
    docs = docs.unionByName(odd).withColumn("digest", docs.doc_id)
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, FOLDER)
        if name != "byte_bpe":
            assert after.columns == docs.columns
        sizes.append(after.count())
        docs = after
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] > 100
    run = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "n_tokens", "decoded_sha256"} <= set(run.columns) and run.count() > 100


def five_word_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4)) if words}


def least_of_groups(texts):
    """Ids that are the smallest of their group, links being all pairs of Jaccard 0.8 or more."""
    sets, parent = {i: five_word_set(t) for i, t in texts.items()}, {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in texts:
        for b in texts:
            s, t = sets[a], sets[b]
            if a < b and (s == t or len(s & t) >= 0.8 * len(s | t)):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i for i in texts if root(i) == i}


def leaks_an_item(text, items):
    words = decontam.text_words(text)
    for target in map(decontam.text_words, items):
        starts = range(max(1, len(words) - len(target) + 1))
        least = min(decontam.edit_distance(target, words[a : a + len(target)]) for a in starts)
        if words and least <= decontam.radius_of(len(target), 0.8):
            return True
    return False


def test_pipeline_stages_equal_brute_force(spark, tmp_path):
    rng = random.Random(33)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
    text = lambda n: " ".join(word() for _ in range(n))
    texts, labels = [text(60) for _ in range(60)], []
    texts += [f"{text(50)} vilest wretch scorned vilest wretch" for _ in range(40)]
    labels = [(i, int(i >= 60), int(i < 60)) for i in range(100)]
    for jaccard in (0.5, 0.6, 0.65, 0.7, 0.75, 0.78, 0.85, 0.9, 0.95) * 4:
        shared = round(2 * jaccard * 200 / (1 + jaccard))
        head = text(shared + 4)
        texts += [f"{head} {text(200 - shared)}" for _ in range(2)]
    chain = text(200).split()  # each like the next, the ends unlike
    for k in range(5):
        chain[20 * k : 20 * k + 6] = text(6).split()
        texts.append(" ".join(chain))
    line = text(9)
    texts += [f"{text(150)} {f'{line} ' * 50}" for _ in range(4)]
    texts += [texts[0], texts[1], texts[1], "", None, " "]
    items = [text(20) for _ in range(4)]
    for item in items:
        leak = item.split()
        leak[3] = word()
        texts += [f"{text(30)} {' '.join(leak)} {text(30)}", f"{text(40)} {item}"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    folder = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, sizes = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        after = stage(spark, docs, folder)
        after.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        kept = sorted(r.doc_id for r in after.collect())
        if name == "toxicity":
            expected = {i for i, t in before.items() if "vilest" not in (t or "")}
        elif name == "exact_dedup":
            first = {}
            for i, t in sorted(before.items()):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
            expected = set(first.values())
        elif name == "near_dedup":
            expected = least_of_groups(before)
        else:
            expected = {i for i, t in before.items() if not leaks_an_item(t, items)}
        assert kept == sorted(expected), name
        sizes[name] = len(before) - len(kept)
        docs = after
    assert all(sizes.values()) and sizes["near_dedup"] >= 12
    encoded = corpus_pipeline.encode(spark, docs, folder).collect()
    texts = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect()}
    assert {r.doc_id: r.decoded_sha256 for r in encoded} == texts and len(encoded) == len(texts)
