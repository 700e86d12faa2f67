"""Personal data by patterns and a skip-chain conditional random field.

Four patterns find spans that are certain.  Other places that look like one of
their kinds are candidates: numbers without the right mark or checksum, and
addresses whose sign is spelled out.  All of them are nodes of a field over the
document.  A node's potential comes from its shape and the words around it,
counted over the whole corpus; neighbours in the text share a weak potential,
and distant nodes with the same or a similar value a strong one: one digit off, other
spacing, the local form of a number, a spelled-out address.  Loopy message passing
makes labels agree, so a value that is certain in one place is found in the others,
however far away.

The weights of the links are fitted to the corpus, from the labels at both ends of each
link: the log odds that they agree, less those of two labels drawn at random.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
FEATURES = 1 << 14
#: Kinds of links, strongest first, and the pairs that agree and differ which are
#: counted before any of the corpus.
LINKS = {"is": (100, 1), "digit": (60, 1), "part": (60, 1), "name": (4, 1), "host": (1, 1), "chain": (1, 1)}
TYPES = list(LINKS)
#: Links that tell one value: a candidate at one end of such a link is no evidence against it.
TELLING = 3
NEAR = 40
ROUNDS = 12
SURE = 0.6
CONTEXT = 2.0

# The base patterns.  A look-behind keeps a pattern from trying every
# start inside one run, which would take quadratic time and finds nothing else.
LOCAL = "[A-Za-z0-9._%+-]"
MAIL_HEAD = re.compile(LOCAL + r"+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
MAIL = re.compile(f"(?<!{LOCAL})" + MAIL_HEAD.pattern)
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Candidates: spelled-out addresses, and numbers with at least seven digits.
AT = r"(?:@| ?[\[(<] ?(?:at|AT|@) ?[\])>] ?| (?:at|AT) )"
DOT = r"(?:\.| ?[\[(<] ?(?:dot|DOT|\.) ?[\])>] ?| (?:dot|DOT) )"
SPELLED = re.compile(rf"(?<!{LOCAL}){LOCAL}{{1,64}}{AT}[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}")
NUMBER = re.compile(r"(?<![0-9])\(?[0-9](?:[\x20().-]{0,2}[0-9])+")
WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    values = [int(c) for c in digits[::-1]]
    return (sum(values[0::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _mails(text: str):
    at = text.find("@")
    end = 0
    while at >= 0:
        # A match may begin right behind the last one, inside a run of local signs.
        found = MAIL_HEAD.match(text, end) if end else None
        found = found or MAIL.search(text, end)
        if not found:
            return
        yield found.span()
        end = found.end()
        at = text.find("@", end)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the certain spans, sorted."""
    spans = [(a, 0, b) for a, b in _mails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 3 or len(p.lstrip("0")) == 3 and int(p) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of places that look like personal data and touch no certain span."""
    found = []
    if "@" in text or " at" in text or "(at" in text or "[at" in text or "AT" in text:
        found += [m.span() for m in SPELLED.finditer(text)]
    found += [m.span() for m in NUMBER.finditer(text) if 7 <= sum("0" <= c <= "9" for c in m[0]) <= 19]
    out, at, free = [], 0, 0
    base = sorted((a, b) for a, _, b in base)
    reach = np.maximum.accumulate([b for _, b in base]) if base else []
    for a, b in sorted(found):
        while at < len(base) and base[at][0] < b:
            at += 1
        if a >= free and (at == 0 or reach[at - 1] <= a):
            out.append((a, b))
            free = b
    return out


def features(text: str, start: int, end: int) -> list[int]:
    """Hashes of the shape of a span and of the words next to it."""
    value = text[start:end]
    shape = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]", "0", value[:40]))
    left = WORD.findall(text[max(0, start - 30) : start])
    right = WORD.findall(text[end : end + 30])
    digits = sum("0" <= c <= "9" for c in value)
    names = (
        f"shape {shape}", f"digits {min(digits, 20)} {value[:1] == '+'}",
        f"left {left[-1].lower() if left else ''}", f"right {right[0].lower() if right else ''}",
    )
    return [xxhash.xxh32_intdigest(n) % FEATURES for n in names]


class Model(NamedTuple):
    """Log ratios of the features by label, and the weight of each kind of link."""

    ratios: np.ndarray
    weights: np.ndarray


def values_of(value: str) -> list[tuple[int, str]]:
    """(kind of link, key): spans that share a key are linked."""
    if any(c.isalpha() for c in value):
        plain = re.sub(r"[\s()\[\]<>]", "", re.sub(r"(?i)[\s(\[<]+at[\s)\]>]+", "@", re.sub(r"(?i)[\s(\[]+dot[\s)\]]+", ".", value))).lower()
        name, _, host = plain.partition("@")
        return [(0, plain)] + ([(3, f"name {name}"), (4, f"host {host}")] if host else [])
    digits = re.sub(r"[^0-9]", "", value)
    keys = [(0, digits)]
    if "." not in value and len(digits) >= 8:
        keys += [(1, f"{digits[:i]}_{digits[i + 1:]}") for i in range(len(digits))]
        keys.append((2, f"end {digits[-9:]}"))
    return keys


def links(spans: list[tuple[int, int]], text: str) -> list[tuple[int, int, int]]:
    """(node, node, kind of link): neighbours in the text, and each node with the last one
    before it that has a key of it, so that links grow with the nodes.

    Two nodes have one link, of the strongest kind.
    """
    out, last = [], {}
    for i, (a, b) in enumerate(spans):
        found = {}
        if i and a - spans[i - 1][1] <= NEAR:
            found[i - 1] = TYPES.index("chain")
        for kind, key in values_of(text[a:b]):
            if (at := last.get(key)) is not None:
                found[at] = min(kind, found.get(at, kind))
            last[key] = i
        out += [(at, i, kind) for at, kind in found.items()]
    return out


def marginals(nodes: np.ndarray, fixed: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Label probabilities by damped loopy message passing.

    ``nodes`` holds log potentials; ``fixed`` labels of certain nodes, else -1.
    An edge adds its weight where both ends have one label.
    """
    nodes = nodes.copy()
    known = fixed >= 0
    nodes[known] = -30.0
    nodes[known, fixed[known]] = 0.0
    if edges:
        a, b, w = (np.array(x) for x in zip(*edges))
        source, target, weight = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([w, w])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        messages = np.zeros((len(source), nodes.shape[1]))
        for _ in range(ROUNDS):
            belief = nodes.copy()
            np.add.at(belief, target, messages)
            cavity = belief[source] - messages[back]
            cavity -= cavity.max(axis=1, keepdims=True)
            p = np.exp(cavity)
            new = np.log(p.sum(axis=1, keepdims=True) + p * np.expm1(weight)[:, None])
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - messages).max()
            messages = 0.3 * messages + 0.7 * new
            if change < 1e-4:
                break
        np.add.at(nodes, target, messages)
    p = np.exp(nodes - nodes.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _possible(text: str | None) -> bool:
    return bool(text) and ("@" in text or " at" in text or "AT" in text or re.search("[0-9]", text) is not None)


def nodes_of(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, label) of the nodes of a text, sorted; label 0 is a candidate's."""
    more = candidates(text, base)
    return sorted([(a, b, k + 1) for a, k, b in base] + [(a, b, 0) for a, b in more])


def fit(docs: DataFrame, text_col="text") -> Model:
    """The model, counted over all texts.

    Certain spans count for their kind, candidates for none of them.  A link counts
    by whether the labels of its ends agree; one that tells the same value counts only
    between certain spans, each of which stands in for a masked one.  Repeated rows
    count as often as they are there; null and empty texts, and empty tables, add
    nothing, so the model then has the prior weights and no ratios.
    """

    def count(batches):
        held = np.zeros((FEATURES, len(LABELS)), np.int64)
        pairs = np.zeros((len(TYPES), 2), np.int64)
        for batch in small(batches):
            for text in batch.column(0).to_pylist():
                if not _possible(text):
                    continue
                nodes = nodes_of(text, base_spans(text))
                for a, b, label in nodes:
                    held[features(text, a, b), label] += 1
                for i, j, kind in links([(a, b) for a, b, _ in nodes], text) if len(nodes) > 1 else ():
                    left, right = nodes[i][2], nodes[j][2]
                    if kind >= TELLING or (left and right):
                        pairs[kind, int(left == right)] += 1
        at, label = np.nonzero(held)
        kind, same = np.nonzero(pairs)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([at, -1 - kind]).astype(np.int32)),
                pa.array(np.concatenate([label, same]).astype(np.int32)),
                pa.array(np.concatenate([held[at, label], pairs[kind, same]])),
            ],
            names=["feature", "label", "n"],
        )

    counted = (
        docs.select(text_col).mapInArrow(count, "feature int, label int, n long")
        .groupBy("feature", "label").agg(F.sum("n").alias("n")).collect()  # FEATURES * LABELS at most, and TYPES * 2
    )
    counts = np.zeros((FEATURES, len(LABELS)))
    pairs = np.array([LINKS[t][::-1] for t in TYPES], float)
    for feature, label, n in counted:
        if feature < 0:
            pairs[-1 - feature, label] += n
        else:
            counts[feature, label] = n
    totals = counts.sum(axis=0)
    # A label's share at a feature against its share overall, so that unseen ones say nothing.
    share = (counts + 5 * (totals + 1) / (totals.sum() + len(LABELS))) / (counts.sum(axis=1, keepdims=True) + 5)
    overall = (totals + 1) / (totals.sum() + len(LABELS))
    chance = (overall**2).sum()
    weights = np.log(pairs[:, 1] / pairs[:, 0]) - np.log(chance / (1 - chance))
    return Model(np.log(share) - np.log(overall), np.maximum(weights, 0.0))


def added_spans(text: str, base: list[tuple[int, int, int]], model: Model) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the candidates that the field labels as personal data."""
    spans = nodes_of(text, base)
    if not any(label == 0 for *_, label in spans):
        return []
    fixed = np.array([label or -1 for *_, label in spans])
    nodes = np.array([model.ratios[features(text, a, b)].sum(axis=0) for a, b, _ in spans])
    nodes = np.clip(nodes, -CONTEXT / 2, CONTEXT / 2)
    nodes[:, 0] += CONTEXT  # shape and context alone never decide: a linked node must agree
    edges = [(i, j, model.weights[kind]) for i, j, kind in links([(a, b) for a, b, _ in spans], text)]
    p = marginals(nodes, fixed, edges)
    best = p[:, 1:].argmax(axis=1)
    return [
        (a, int(best[i]), b) for i, (a, b, label) in enumerate(spans) if not label and p[i, 1 + best[i]] >= SURE
    ]


def find(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, base and added, arrays of (kind, start, end).

    Positions count code points, the end is exclusive.  base holds the spans of the
    patterns, which the field never removes; added those that it finds besides.
    Null and empty texts have none.  Repeated rows give equal rows; other columns
    are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def named(spans):
        return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(spans)]

    def run(batches):
        for batch in small(batches):
            base, added = [], []
            for text in batch.column(1).to_pylist():
                found = base_spans(text) if _possible(text) else []
                base.append(named(found))
                added.append(named(added_spans(text, found, sent.value)) if _possible(text) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, span), pa.array(added, span)], names=[id_col, "base", "added"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    spans = "array<struct<kind:string,start:int,end:int>>"
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, base {spans}, added {spans}")
