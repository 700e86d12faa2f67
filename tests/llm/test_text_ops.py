"""Chat, BPE, decontamination, toxicity, quality and personal data."""

import base64
import itertools
import random
import re

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from mapstrata.llm import bpe, chat, decontam, pii, quality, toxicity
from mapstrata.llm.queries import vocabulary

DOCS = "doc_id long, text string"


def frame(spark, rows):
    made = spark.createDataFrame(rows, DOCS)
    return made.selectExpr("*", "1 AS id", "'a' AS _w", "2 AS _label", "3 AS _toxic_words", "4 AS _g").repartition(2)


# Chat

TURNS = "conv_id long, turn long, role string, text string"


def chats(spark, rows):
    made = chat.format_chats(spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS block", "2 AS said"), block_turns=2)
    made = made.withColumn("turns", chat.read_turns(F.col("formatted")))
    return {r.conv_id: r for r in made.withColumn("loss", chat.loss_text(F.col("segments"))).collect()}


@pytest.mark.parametrize("text", [
    "\\### Assistant: </turn> ok", "<turn>user\n", "\\b\\l\\n", "\\\\b<", "", None, "a\nb", "日本 😀", "</turn>\n<turn>assistant\nx",
])
def test_chat_round_trip(spark, text):
    rows = [(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "user\n<x>", text), (1, 3, "assistant", "z")]
    r = chats(spark, rows)[1]
    assert [tuple(t) for t in r.turns] == [(role, x or "") for _, _, role, x in rows]
    assert r.loss == (text or "") + "z" and r.formatted == "".join(s.text for s in r.segments)


@pytest.mark.parametrize("roles, valid", [
    (["user", "assistant"], True), (["system", "user", "assistant", "user"], True), (["user"] * 2, False),
    (["assistant"], False), (["user", "system"], False), (["user", "assistant"] * 5, True), (["user", None], False),
    (["user", "assistant"] * 2 + ["assistant"], False), (["!"], False), (["user", "tool", "user"], False),
])
def test_chat_states(spark, roles, valid):
    r = chats(spark, [(7, i, role, "t") for i, role in enumerate(roles)])[7]
    assert (r.valid, r.n_turns, r.first_fault is None) == (valid, len(roles), valid)


@pytest.mark.parametrize("roles, place", [
    (["user", "user"], 1), (["assistant"], 0), (["user", "assistant"] * 3 + ["system", "user"], 6), (["user", None], 1),
    (["system", "user", "assistant", "user", "user", "assistant"], 4), (["!", "user"], 0), (["user", "assistant"] * 4, None),
])
def test_chat_first_fault(spark, roles, place):
    assert chats(spark, [(7, i, role, "t") for i, role in enumerate(roles)])[7].first_fault == place


def test_chat_edges(spark):
    rows = [(None, 0, "user", "a"), (1, 5, "user", "b"), (1, 5, "user", "b"), (1, 5, "assistant", "c"), (1, None, "user", "first"), (1, -3, "x", "neg")]
    found = chats(spark, rows)
    assert [t.text for t in found[1].turns] == ["first", "neg", "c", "b", "b"] and found[None].n_turns == 1
    assert chats(spark, []) == {}


# BPE

def encoding():
    path, pattern = vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), ranks, path, pattern


def test_merge_of_long_words():
    encoder, ranks, *_ = encoding()
    rng = random.Random(1)
    for n in range(300):
        word = "".join(rng.choice(rng.choice(["abcdefghijklmnopqrstuvwxyz", "ACGT", "aab"])) for _ in range(1 + n))
        assert bpe.merge_long(word.encode(), ranks) == encoder.encode_ordinary(word)


@pytest.mark.parametrize("frequent, piece", [(0, 1 << 20), (30, 40)])
def test_bpe_like_the_library(spark, monkeypatch, frequent, piece):
    encoder, _, path, pattern = encoding()
    monkeypatch.setattr(bpe, "PIECE", piece)
    rng = random.Random(frequent)
    signs = "abcdefghij eénthsro ciónß 日本語, !?..--==  \n\t\r123456\"'sthe ing　​\x1c\x85😀aaa<|endoftext|>"
    texts = ["", None, "a" * 3000, " " * 500, "=-" * 300, "ab" * 99 + "\n" * 50, "it's I'll 'd", "the the", "the the"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 300))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "x y")]
    encoded = bpe.encode(frame(spark, rows), path, pattern, frequent=frequent, decoded=frequent > 0)
    found = (encoded if frequent else bpe.decode(encoded, path)).collect()
    assert len(found) == len(rows)
    known = dict(rows)
    for r in found:
        text = known[r.doc_id] or ""
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == encoder.encode_ordinary(text)
        assert bytes(r["bytes"]) == text.encode()


def test_bpe_words_by_every_way(monkeypatch):
    encoder, ranks, *_ = encoding()
    rng = random.Random(2)
    for bound in (0, 8, 64):
        monkeypatch.setattr(bpe, "WORD_BYTES", bound)
        for n in range(100):
            word = "".join(rng.choice("aabcdeinrst日é") for _ in range(1 + n))
            assert bpe.merge(word.encode(), ranks) == encoder.encode_ordinary(word)


def test_bpe_takes_one_pass_over_the_texts(spark):
    """Rare words are not folded by the plan, and a task has one Python worker; stretches are forgotten in between."""
    encoder, _, path, pattern = encoding()
    rows = [(i, " ".join(f"word{j % 7}x{i}, again{j}" for j in range(40))) for i in range(30)]
    made = bpe.encode(frame(spark, rows), path, pattern, frequent=20, decoded=True)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "aggregate(" not in plan
    found = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in made.collect()}
    assert found == {i: encoder.encode_ordinary(text) for i, text in rows}


# Decontamination

def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(0, 70))] for _ in range(2))
        assert decontam.edit_distance(a, b) == plain_distance(a, b)


def leaked(rng, items, vocabulary, edits):
    words = rng.choice(items).split()
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + rng.randrange(2)] = [rng.choice(vocabulary)] * rng.randrange(2)
    around = [rng.choice(vocabulary) for _ in range(rng.randrange(80))]
    at = rng.randrange(len(around) + 1)
    return " ".join(around[:at] + words + around[at:])


@pytest.mark.parametrize("block_bytes", [1 << 22, 400])
def test_leaks_equal_brute_force(spark, block_bytes):
    rng = random.Random(5)
    vocabulary_ = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choice(vocabulary_) for _ in range(rng.randint(1 if i < 3 else 8, 40))) for i in range(25)]
    texts = [leaked(rng, items, vocabulary_, rng.randrange(8)) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate([*texts, None, "", items[4].upper(), "w1"])] + [(0, texts[0]), (None, items[3])]
    bench = [(i, t) for i, t in enumerate(items)] + [(90, None), (91, "?!"), (4, items[4])]
    found = decontam.leaks(
        frame(spark, rows), spark.createDataFrame(bench, "item_id long, text string"), block_bytes=block_bytes
    ).collect()
    made = {(r.doc_id, r.item_id): r.distance for r in found}
    exact = {}
    for doc, text in rows:
        words = decontam.text_words(text)
        for item, t in bench:
            target = decontam.text_words(t)
            if doc is None or not words or not target:
                continue
            starts = range(max(1, len(words) - len(target) + 1))
            best = min(decontam.edit_distance(target, words[a : a + len(target)]) for a in starts)
            if best <= decontam.radius_of(len(target), 0.8):
                exact[doc, item] = best
    assert len(found) == len(made) and set(made) <= set(exact)
    assert len(made) >= 0.99 * len(exact) and len(exact) > 50
    assert all(made[k] >= exact[k] for k in made) and all(k in made for k, v in exact.items() if v == 0)
    kept = decontam.decontaminate(frame(spark, rows), spark.createDataFrame(bench, "item_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in made}
    none = decontam.leaks(frame(spark, rows), spark.createDataFrame([], "item_id long, text string"))
    assert none.collect() == [] and decontam.leaks(frame(spark, []), spark.createDataFrame(bench, "item_id long, text string")).collect() == []


# Toxicity

def best_segments(scores):
    """Maximal segments by their definition: the best one, then what is left and right of it."""
    best, at = 0, None
    for i in range(len(scores)):
        total = 0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-9:
                best, at = total, (i, j + 1)
    if at is None:
        return []
    a, b = at
    right = [(x + b, y + b, s) for x, y, s in best_segments(scores[b:])]
    return [*best_segments(scores[:a]), (a, b, best), *right]


def test_segments():
    rng = random.Random(3)
    for _ in range(400):
        scores = [rng.uniform(-3, 2.5) for _ in range(rng.randrange(0, 25))]
        found = toxicity.segments(np.array(scores, float))
        expected = best_segments(scores)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in expected]
        assert np.allclose([s for *_, s in found], [s for *_, s in expected])


def test_touching_blanks():
    """The quick test agrees with the pattern on every short text of these characters."""
    for n in range(6):
        for made in itertools.product(" a\n\t\xa0\x1cé", repeat=n):
            piece = "".join(made)
            assert bpe.touching(piece, piece.split(" ")) == (bpe.TOUCHING.search(piece) is not None), repr(piece)


def toxic_corpus(n=900):
    rng = random.Random(8)
    clean = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(150)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randint(5, 80))]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vilest", "wretch", "scorned"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad), int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus()
    table = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    docs = frame(spark, [*rows, (5000, None), (5001, ""), (5002, "1 2 !"), (None, "vilest wretch")])
    found = toxicity.score(docs, toxicity.fit(docs, table)).withColumn("held", toxicity.held_out("doc_id")).collect()
    truth = {i: bad for i, bad, _ in labels}
    right = [(r.score >= 0.7) == truth[r.doc_id] for r in found if r.held and r.doc_id in truth]
    assert len(right) > 200 and np.mean(right) > 0.97 and all(0 <= r.score <= 1 for r in found)
    assert all(r.score < 0.5 for r in found if r.doc_id in (5000, 5001, 5002))
    kept = toxicity.drop_toxic(docs, table)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if r.score < 0.7}


def test_texts_of_kept_rows_do_not_go_to_python(spark):
    """Only the words do: no Python stage returns the rows, whatever columns they have."""
    rows, labels = toxic_corpus(100)
    table = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    docs = frame(spark, [*rows, rows[1], (5000, None)]).withColumn("span", F.expr("named_struct('a', array(doc_id))"))
    kept = toxicity.drop_toxic(docs, table)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan
    scored = toxicity.score(docs, toxicity.fit(docs, table)).filter("score < 0.7")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in scored.collect())
    assert kept.filter("doc_id = 1").count() == 2 and kept.schema == docs.schema


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(None, 1, 0), (3, None, None)]])
def test_toxicity_without_labels(spark, labels):
    table = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    docs = frame(spark, [(1, "a b"), (2, None), (2, None)])
    assert [r.score < 0.5 for r in toxicity.score(docs, toxicity.fit(docs, table)).collect()] == [True] * 3
    assert quality.resample(docs, table).count() == 3 and quality.resample(frame(spark, []), table).collect() == []
    assert toxicity.drop_toxic(frame(spark, []), table).collect() == []


# Quality

def test_quality_on_held_out_rows(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        good = i % 4 != 0
        words = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(rng.randint(20, 60))]
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)))
        labels.append((i, int(good)))
    found = quality.resample(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    truth = dict(labels)
    assert abs(sum(r.selected for r in found) - 675) < 25
    assert np.mean([r.selected == bool(truth[r.doc_id]) for r in found]) > 0.95


@pytest.mark.parametrize("k", [0, 1, 7, 50, 199, 200, 300])
def test_top_k(spark, k):
    rng = random.Random(k)
    keys = [rng.choice([rng.random() * 10**9, 5.0, -1e-300, 2.5]) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(keys)), "id long, key double")
    chosen = {r.id for r in quality.top_k(rows, "key", k, steps=8).filter("selected").collect()}
    assert chosen == {i for _, i in sorted((-x, i) for i, x in enumerate(keys))[:k]}


@pytest.mark.parametrize("kind", ["long", "string"])
@pytest.mark.parametrize("k", [5, 10, 29, 30, 31, 70, 119, 120])
def test_top_k_at_a_tie_with_rows_without_ids(spark, monkeypatch, kind, k):
    data = [(i, 9.0) for i in range(5)] + [(None, 5.0)] * 25 + [(100 + i // 2, 5.0) for i in range(80)] + [(7, 1.0)] * 10
    rows = spark.createDataFrame(data, "id long, key double").selectExpr(f"CAST(id AS {kind}) AS id", "key").repartition(7)
    seen, collect = [], type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda df: seen.append(collect(df)) or seen[-1])
    chosen = quality.top_k(rows, "key", k, steps=8).filter("selected")
    assert max(len(x) for x in seen) <= 16
    monkeypatch.undo()
    order = sorted(((-key, i is not None, i or 0) for i, key in data))
    expected = [x for x in order if x <= order[k - 1]]
    assert sorted((-r.key, r.id is not None, int(r.id or 0)) for r in chosen.collect()) == expected


# Personal data

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain_spans(text):
    out = []
    for k, (name, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1]))
            if (
                name == "email" or name == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or name == "card" and 14 <= len(digits) <= 19 and total % 10 == 0
                or name == "phone" and 10 <= len(digits) <= 15
            ):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans():
    rng = random.Random(1)
    for _ in range(8000):
        text = "".join(rng.choice("ab1250..@@_+- ()%é") for _ in range(rng.randrange(0, 60)))
        assert pii.base_spans(text) == plain_spans(text)
    for _ in range(300):
        text = "".join(rng.choice("0123456789 -") for _ in range(400))
        assert pii.base_spans(text) == plain_spans(text)


def test_field_links_distant_values(spark):
    fill = "some words of no interest " * 200
    text = f"call +44 20 7946 0958 now. {fill} ask 44 20 7946 0958 or 1234 5678 90. mail a.b@c.org, {fill} a.b (at) c.org"
    rows = [(1, text), (2, "number 44 20 7946 0958"), (3, None), (4, ""), (1, text), (None, "x@y.zz")]
    docs = frame(spark, rows)
    found = pii.find(docs, pii.fit(docs)).collect()
    named = {r.doc_id: ([text[s.start : s.end] for s in r.base], [(s.kind, text[s.start : s.end]) for s in r.added]) for r in found if r.doc_id == 1}
    assert named[1][0] == ["+44 20 7946 0958", "a.b@c.org"]
    assert named[1][1] == [("phone", "44 20 7946 0958"), ("email", "a.b (at) c.org")]
    rest = {r.doc_id: (len(r.base), len(r.added)) for r in found}
    assert rest[2] == rest[3] == rest[4] == (0, 0) and rest[None] == (1, 0) and len(found) == 6


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    nodes = rng.normal(size=(4, 5))
    edges = [(0, 1, 1.5), (1, 2, 0.7), (2, 3, 2.0)]  # a tree, on which messages are exact
    total = np.zeros((4, 5))
    for labels in np.ndindex(*[5] * 4):
        weight = np.exp(sum(nodes[i, k] for i, k in enumerate(labels)) + sum(w for a, b, w in edges if labels[a] == labels[b]))
        for i, k in enumerate(labels):
            total[i, k] += weight
    found = pii.marginals(nodes, np.full(4, -1), edges)
    assert np.allclose(found, total / total.sum(axis=1, keepdims=True), atol=1e-2)


def test_long_runs_take_linear_time():
    text = "1" * 200_000 + " " + "a" * 200_000 + "@" + "b." * 100_000 + "+1" + " " * 200_000
    pii.candidates(text, pii.base_spans(text))


def exact_marginals(nodes, edges):
    """By all labellings."""
    n, k = nodes.shape
    total = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        score = sum(nodes[i, x] for i, x in enumerate(labels)) + sum(w for a, b, w in edges if labels[a] == labels[b])
        for i, x in enumerate(labels):
            total[i, x] += np.exp(score)
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("edges, off", [
    ([(0, 1, 2.0), (1, 2, 3.0), (1, 3, 1.0)], 1e-3),  # a tree
    ([(0, 1, 1.0), (1, 2, 1.0), (2, 0, 1.0)], 0.05), ([(0, 1, 2.0), (1, 2, 2.0), (2, 3, 2.0), (3, 0, 2.0)], 0.1),
    ([(a, b, 0.6) for a in range(5) for b in range(a)], 0.1),
])
def test_field_against_all_labellings(edges, off):
    for seed in range(5):
        nodes = np.random.default_rng(seed).normal(0, 1, (5, 3))
        found = pii.marginals(nodes, np.full(5, -1), edges)
        right = exact_marginals(nodes, edges)
        assert np.abs(found - right).max() < off
        assert ((found.argmax(1) == right.argmax(1)) | (np.sort(right)[:, -1] - np.sort(right)[:, -2] < 0.1)).all()


def planted_values(rng):
    """Texts with a certain span and, far away, a variant of it or an unlike value; where the variant is."""
    def digits(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def filler(n):
        return " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet", "order", "number", "call"]) for _ in range(n))

    area, line = digits(3), digits(4)
    phone, local = f"+1 ({area}) 555-{line}", f"({area}) 555-{line}"
    name, host = f"{rng.choice(['ann', 'bo', 'cy'])}{digits(2)}", f"mail{digits(1)}.example.com"
    card = next(c for c in ("4" + digits(15) for _ in range(1000)) if pii.luhn(c))
    at = rng.randrange(16)
    typo = card[:at] + str((int(card[at]) + 1) % 10) + card[at + 1 :]
    number = next(c for c in (digits(16) for _ in range(1000)) if not pii.luhn(c))
    sure, other, kind = rng.choice([
        (phone, local, "phone"), (phone, f"1 {area} 555 {line}", "phone"), (card, typo, "card"),
        (f"{name}@{host}", f"{name} at {host.replace('.', ' dot ')}", "email"), (f"{name}@{host}", f"{name} [at] {host}", "email"),
        (card, number, None), (phone, f"(212) 555-{digits(4)}", None), (f"{name}@{host}", "word at another.example.org", None), (phone, number, None),
    ])
    text = f"{filler(30)} {sure} {filler(400)} "
    return text + f"{other} {filler(5)}", (kind, len(text), len(text) + len(other)) if kind else None


def test_field_finds_variants_of_certain_values(spark):
    rng = random.Random(3)
    made = [planted_values(rng) for _ in range(300)]
    docs = frame(spark, [(i, text) for i, (text, _) in enumerate(made)])
    found = {r.doc_id: [tuple(x) for x in r.added] for r in pii.find(docs, pii.fit(docs)).collect()}
    right = sum(found[i] == [span] for i, (_, span) in enumerate(made) if span)
    assert right >= 0.95 * sum(span is not None for _, span in made)
    assert [found[i] for i, (_, span) in enumerate(made) if not span and found[i]] == []


def test_field_without_rows(spark):
    model = pii.fit(frame(spark, []))
    assert pii.find(frame(spark, [(1, None), (2, ""), (2, "")]), model).count() == 3
    assert np.abs(model.ratios).max() < 1e-9 and (model.weights >= 0).all()
