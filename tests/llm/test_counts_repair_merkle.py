"""Token counts, conversation repair and the Merkle manifest against brute force and on edge cases."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mapstrata.llm import merkle, queries, repair, token_counts

VOCABULARY = public_tokenizers.path(queries.WORD_VOCABULARY)
BLANKS = "\x20\x09-\x0D"


# Token counts


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(VOCABULARY)
    found.no_truncation()
    found.no_padding()
    return found


def odd_texts(seed, n):
    rng = random.Random(seed)
    signs = ["'s", "'", "’", "don't", "A", "é", "é", "́", "İ", "ß", "12", "①", "<|endoftext|>", "<|startoftext|>",
             "<|", "|>", "endoftext", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", " ", "　", "中文", "。", "가", "가",
             "🙂", "𝔸", "Ω", "K", "...", "\x00", "long" * 20, "ำ", "﻿"]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 120))) for _ in range(n)]


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 15, 128), (64, 40), (40, 8), (200, 60)])
def test_token_counts_equal_the_library(spark, library, chunk, overlap):
    texts = [*odd_texts(chunk, 250), None, "", " ", "x" * 3000, "中" * 2000, "a1" * 900, "word " * 900, "'s" * 700]
    rows = [(None if k % 50 == 0 else k // 2, t) for k, t in enumerate(texts)] + [(7, "twice"), (7, "twice")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 AS id", "2 AS key", "'n' AS n_bytes")
    found = token_counts.count_tokens(docs.repartition(3), VOCABULARY, chunk_chars=chunk, overlap=overlap, limit=100)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = []
    for i, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False))
        expected.append((i, len((text or "").encode()), n, n > 100))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_a_boundary_is_stable(library):
    """What precedes a stable position does not change the tokens behind it."""
    encoder = token_counts.Encoder(token_counts.load_vocabulary(VOCABULARY))
    seen = 0
    for text in odd_texts(5, 300):
        whole = library.encode(text, add_special_tokens=False).ids
        for p in encoder.stable(text, 1, len(text) - 1):
            parts = [library.encode(t, add_special_tokens=False).ids for t in (text[:p], text[p:])]
            assert parts[0] + parts[1] == whole, (text, p)
            seen += 1
    assert seen > 3000


def test_token_counts_of_nothing_and_of_other_vocabularies(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(empty, VOCABULARY).collect() == []
    with pytest.raises(ValueError, match="stable boundaries"):
        token_counts.count_tokens(empty, public_tokenizers.path("byte_bpe_50k.json"))


# Conversation repair

INITIALS = {"s": "system", "u": "user", "a": "assistant"}


def least_repair(rows):
    """(cost, audit, repaired) by trying all edits, cheapest first; rows are (role, text, dead, truncated)."""

    def legal(roles):
        return re.fullmatch(r"(s?(ua)+)?", "".join(roles))

    best = None
    edits = [[("D", 3, None)] if dead else [("D", 3, None), ("K", int(cut), role), *(("R", 2 + cut, r) for r in ("user", "assistant"))]
             for role, _, dead, cut in rows]
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for chosen in itertools.product(*edits):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            cost = sum(e[1] for e in chosen) + 2 * sum(map(len, gaps))
            if best and cost > best[0]:
                continue
            audit, said = "", []
            for k, gap in enumerate(gaps):
                audit += "I" * len(gap)
                said += [(r, "") for r in gap]
                if k < len(rows):
                    audit += chosen[k][0]
                    said += [] if chosen[k][2] is None else [(chosen[k][2], rows[k][1])]
            if legal(r[:1] or "-" for r, _ in said) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, said)
    return best


def judged(turns):
    """Rows of a conversation in order, with their faults."""
    rows, seen, faults = [], set(), []
    for turn, role, text in sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        last = re.search(rf"[^{BLANKS}](?=[{BLANKS}]*\Z)", text)
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last[0] in ".!?" else "truncated"
        seen.add((role, text))
        rows.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        faults.append(fault)
    return rows, faults


def brute_repair(turns):
    rows, faults = judged(turns)
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [r[0][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    cost, audit, said = least_repair(rows)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, digest)


def run_repair(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string").selectExpr(
        "*", "1 AS conv", "2 AS part", "3 AS rows", "'x' AS letters"
    )
    done = repair.repair(turns.repartition(4))
    digests = {r.conv_id: r.sha256 for r in repair.digests(done.pieces).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r[0]: (*r[1:], digests.get(r[0], empty)) for r in done.conversations.collect()}


@pytest.mark.parametrize("block", [1, 2, 256])
def test_repair_equals_all_edits(spark, monkeypatch, block):
    rng = random.Random(block)
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", "User"]
    texts = ["Yes.", "No!", "Why? \n", "cut", "", " ", "cut off, \t"]
    rows = []
    for conv in range(60):
        for _ in range(rng.randint(1, 4)):
            row = (f"c{conv}" if conv else None, rng.choice([None, 1, 2, 3, 7]), rng.choice(roles), rng.choice(texts))
            rows += [row] * rng.choice([1, 1, 1, 2])
    by = {}
    for conv, *turn in rows:
        by.setdefault(conv, []).append(tuple(turn))
    by = {c: t for c, t in by.items() if len(t) <= 4}
    rows = [(c, *t) for c, turns in by.items() for t in turns]
    assert len(by) > 30
    assert run_repair(spark, rows) == {c: brute_repair(t) for c, t in by.items()}


def least_by_strings(rows):
    """(cost, audit) by a program over states and strings; one row after the other, from the first on."""

    def gap(best):
        for _ in range(3):
            options = [*best.items()]
            for q, (cost, audit) in best.items():
                options.append(("a" if q == "u" else "u", (cost + 2, audit + "I")))
            best = {}
            for q, w in options:
                best[q] = min(w, best.get(q, w))
        return best

    best = gap({"": (0, "")})
    for role, _, dead, cut in rows:
        after = {}

        def offer(q, w):
            after[q] = min(w, after.get(q, w))  # noqa: B023

        for q, (cost, audit) in best.items():
            offer(q, (cost + 3, audit + "D"))
            if not dead:
                if q + role[:1] in ("s", "u", "su", "ua", "au"):
                    offer(role[:1], (cost + cut, audit + "K"))
                offer("a" if q == "u" else "u", (cost + 2 + cut, audit + "R"))
        best = gap(after)
    return min(best[q] for q in ("", "a") if q in best)


def test_repair_of_long_conversations(spark):
    rng = random.Random(9)
    rows = []
    for conv, n in (("long", 3000), ("longer", 5000), ("short", 300)):
        for turn in range(n):
            rows.append((conv, turn, rng.choice(list(INITIALS.values())), rng.choice([f"said {turn}.", f"cut {turn}", "Same.", " "])))
    rows += [("same", 1, "user", "Hi.")] * 500
    found = run_repair(spark, rows)
    for conv in ("long", "longer", "short", "same"):
        judgement, faults = judged([r[1:] for r in rows if r[0] == conv])
        assert found[conv][5:7] == least_by_strings(judgement)
        assert list(found[conv][1:4]) == [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    assert found["same"][:7] == (0, 0, 499, 0, 499, 1499, "K" + "D" * 499 + "I")


def test_repair_of_nulls_and_nothing(spark):
    none = [(None, None, None, None), (None, None, None, None), ("a", None, "user", None), ("a", 4, None, "Hm.")]
    found = run_repair(spark, none)
    assert found[None][:7] == (0, 2, 0, 0, 1, 6, "DD")
    assert found["a"][1] == 1 and found["a"][4:6] == (1, 6) and found["a"][6] == "DD"
    assert run_repair(spark, []) == {}


# Merkle manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h("".join(found[-1][k : k + 8])) for k in range(0, len(found[-1]), 8)])
    return found


def siblings(tree, at):
    for level in tree[:-1]:
        first = at // 8 * 8
        yield "".join(level[first:at]), "".join(level[at + 1 : first + 8])
        at //= 8


def brute_manifest(rows):
    by, found = {}, []
    for r in rows:
        by.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    langs = sorted(by, key=lambda c: (c is not None, (c or "").encode()))
    by = {c: sorted(by[c], key=lambda x: x[:3]) for c in langs}
    trees = {c: levels([x[2] for x in by[c]]) for c in langs}
    top = levels([trees[c][-1][0] for c in langs])
    for place, c in enumerate(langs):
        for at, (_, _, own, r) in enumerate(by[c]):
            path = [*siblings(trees[c], at), *siblings(top, place)]
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            folded = functools.reduce(lambda x, s: h(s[0] + x + s[1]), path, leaf(r, text))
            proof = h("".join(a + b for a, b in path))
            found.append((r["doc_id"], own, trees[c][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(found, key=repr)


@pytest.mark.parametrize(("n", "digits"), [(0, 3), (1, 3), (9, 1), (65, 1), (700, 1), (1100, 2), (600, 3)])
def test_manifest_equals_brute_force(spark, n, digits):
    rng = random.Random(n)
    rows = [
        {
            "doc_id": rng.choice([None, k, rng.randint(0, 50)]) if n != 600 else k,
            "source": rng.choice([None, "s", "é"]),
            "lang": rng.choice([None, "en", "en", "en", "de", "", "é", *(f"x{k}" for k in range(20))]) if n != 600 else "en",
            "n_chars": rng.choice([None, 3]),
            "text": rng.choice([None, "", "Ab" * rng.randint(0, 5), "É\n"]),
        }
        for k in range(n)
    ]
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = spark.createDataFrame(
        [tuple(r[c] for c in columns) for r in rows], "doc_id long, source string, lang string, n_chars long, text string"
    ).selectExpr("*", "1 AS rank", "2 AS hash", "3 AS path", "4 AS g", "5 AS block", "6 AS leaf")
    tried = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", queries.CAPITALS, queries.CAPITALS.lower()))
    found = merkle.manifest(docs.repartition(5), {"text": tried.otherwise(F.col("text"))}, digits=digits)
    assert sorted(map(tuple, found.drop("path").collect()), key=repr) == brute_manifest(rows)


def test_a_proof_fails_for_other_rows(spark):
    docs = spark.range(100).selectExpr("id AS doc_id", "'s' AS source", "'en' AS lang", "3 AS n_chars", "'abc' AS text")
    assert merkle.manifest(docs).filter("verified").count() == 100
    other = merkle.manifest(docs, {"n_chars": F.when(F.col("doc_id") == 5, 4).otherwise(F.col("n_chars"))})
    assert [r.doc_id for r in other.filter("NOT verified").collect()] == [5]
