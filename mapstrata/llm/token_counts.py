"""Token counts of whole texts, huge ones in overlapping chunks that are spliced.

A text above ``chunk_chars`` is cut into chunks that overlap.  Each chunk is
encoded with offsets, wherever the shuffle puts it.  In an overlap both chunks
list the positions that are token boundaries of theirs and proven stable; the
counts are spliced at the first one that both list.  Where they share none, the
text is cut again with a wider overlap, up to the whole text.

A position is stable if the encoding on either side cannot depend on the other:
the vocabulary's split keeps blanks out of every word, matches a number alone, and
joins no letter to another sign but after an apostrophe; its normaliser composes
a character with following marks only; and no special string lies across it.

By the same proof, the stretches between the ASCII blanks of a shorter text are
encoded once for each task and distinct stretch.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import cut, small

CHUNK_CHARS = 1 << 15
OVERLAP = 128
LIMIT = 2048
#: Stretches that a task remembers the counts of.
REMEMBERED = 300_000
#: The split pattern and the normalisers that the proof holds for.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALISERS = {"NFC", "Replace", "Lowercase"}


def load_vocabulary(path: str) -> str:
    """The vocabulary file's text, checked to be one that the proof of stable boundaries holds for.

    It travels to the tasks whole, so executors need no copy of the file.
    """
    with open(path, encoding="utf-8") as file:
        text = file.read()
    spec = json.loads(text)
    normaliser, splits = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
    steps = normaliser.get("normalizers", [normaliser])
    split = (splits.get("pretokenizers") or [splits])[0]
    proven = (
        {s.get("type") for s in steps} <= NORMALISERS
        and all(s["pattern"] == {"Regex": r"\s+"} and s["content"] == " " for s in steps if s["type"] == "Replace")
        and (split.get("pattern"), split.get("behavior"), split.get("invert")) == ({"Regex": SPLIT}, "Removed", True)
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        and not any(any(c.isspace() for c in t["content"]) for t in spec["added_tokens"])
    )
    if not proven:
        raise ValueError(f"no stable boundaries are proven for the split and normaliser of {path}")
    return text


def _kind(c: str) -> str:
    """B for an ASCII blank, L, N, O as in the split pattern; empty where the normaliser may change that."""
    if c in " \t\n\v\f\r":
        return "B"
    if c < "\x80":
        return "L" if c.isalpha() else "N" if c.isdigit() else "O" if c > "\x1f" else ""
    plain = unicodedata.normalize("NFC", c).lower()
    kind = unicodedata.category(c)
    # A mark or a Korean vowel or final composes with what is before it.
    if plain != c.lower() or len(plain) != 1 or kind[0] in "MZC" or "ᄀ" <= c <= "ᇿ":
        return ""
    return kind[0] if kind[0] in "LN" else "O"


class Encoder:
    """The library's tokenizer of one vocabulary, and what it needs for splicing."""

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.margin = max(map(len, self.specials), default=1)
        self.known: dict[bytes, int] = {}

    def count_texts(self, texts: list[str]) -> list[int]:
        """Tokens of each text, of which every distinct stretch between blanks is encoded once."""
        cuts = [t.encode().split() for t in texts]  # bytes are split at ASCII blanks alone
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        fresh = {w for words in cuts for w in words if w not in known}
        fresh = list(fresh)
        for at in range(0, len(fresh), 5000):
            part = [w.decode() for w in fresh[at : at + 5000]]
            ends = np.cumsum([len(w) + 1 for w in part])
            starts, _ = self.offsets(" ".join(part))
            upto = np.searchsorted(starts, ends)
            known.update(zip(fresh[at : at + 5000], np.diff(upto, prepend=0).tolist(), strict=True))
        return [sum(map(known.__getitem__, words)) for words in cuts]

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the tokens, in characters."""
        found = np.array(self.tokenizer.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]

    def stable(self, text: str, low: int, high: int) -> list[int]:
        """Stable positions p of low <= p <= high, where ``text`` shows ``margin`` characters around all."""
        found = []
        inside = set()
        for special in self.specials:
            at = text.find(special, max(0, low - self.margin))
            while 0 <= at <= high:
                inside.update(range(at + 1, at + len(special)))
                at = text.find(special, at + 1)
        for p in range(max(low, 1), min(high, len(text) - 1) + 1):
            a, b = _kind(text[p - 1]), _kind(text[p])
            apart = a == "B" or b == "B" or (a and b and (a != b or a == "N") and not (b == "L" and text[p - 1] == "'"))
            if apart and p not in inside:
                found.append(p)
        return found

    def boundaries(self, text: str, starts, ends, low: int, high: int) -> list[tuple[int, int]]:
        """(p, tokens before p) of the stable token boundaries p."""
        found = []
        for p in self.stable(text, low, high):
            n = int(np.searchsorted(starts, p))
            if n == 0 or ends[n - 1] <= p:
                found.append((p, n))
        return found


PLACES = "array<struct<at:bigint,n:bigint>>"
CHUNK = "key bigint, chunk bigint, start bigint, total_chars bigint, text string"
COUNTED = f"key bigint, chunk bigint, n bigint, head {PLACES}, tail {PLACES}, last boolean"


def _cut_chunks(size: int, overlap: int):
    def run(batches):
        for batch in small(batches, 1):
            key, text = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            for chunk, start in enumerate(range(0, max(1, len(text)), size)):
                part = text[start : start + size + overlap]
                values = [[key], [chunk], [start], [len(text)], [part]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(values, [pa.int64()] * 4 + [pa.string()], strict=True)],
                    ["key", "chunk", "start", "total_chars", "text"],
                )

    return run


def _count_chunks(vocabulary: str, size: int, overlap: int):
    places = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))

    def run(batches):
        encoder = Encoder(vocabulary)
        for batch in small(batches, 8):
            rows = []
            for r in batch.to_pylist():
                text, start = r["text"], r["start"]
                starts, ends = encoder.offsets(text)
                low, high = encoder.margin, overlap - encoder.margin
                head = encoder.boundaries(text, starts, ends, low, high) if start else []
                last = start + size >= r["total_chars"]
                tail = [] if last else encoder.boundaries(text, starts, ends, size + low, size + high)
                if start + len(text) == r["total_chars"]:  # the end of the whole text is stable
                    head += [(len(text), len(starts))] if start and len(text) <= overlap else []
                    tail += [] if last else [(len(text), len(starts))]
                shift = lambda found: [{"at": start + p, "n": n} for p, n in found]  # noqa: B023, E731
                rows.append((r["key"], r["chunk"], len(starts), shift(head), shift(tail), last))
            kinds = [pa.int64(), pa.int64(), pa.int64(), places, places, pa.bool_()]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["key", "chunk", "n", "head", "tail", "last"],
            )

    return run


def _spliced(texts: DataFrame, vocabulary: str, size: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of ``texts`` (key, text); null where two chunks share no stable boundary."""
    counted = (
        texts.mapInArrow(_cut_chunks(size, overlap), CHUNK)
        .repartition("key", "chunk")
        .mapInArrow(_count_chunks(vocabulary, size, overlap), COUNTED)
    )
    order = Window.partitionBy("key").orderBy("chunk")
    # The first boundary that both sides of a cut list, and the tokens before it on either side.
    head, tail = F.lead("head").over(order), F.col("tail")
    at = F.array_min(F.array_intersect(tail["at"], head["at"]))

    def before(places, p):
        return F.get(places["n"], F.array_position(places["at"], p).cast("int") - 1)

    return (
        counted.withColumn("at", at)
        .withColumn("left", F.when(F.col("last"), F.col("n")).otherwise(before(tail, F.col("at"))))
        .withColumn("right", F.when(F.col("last"), 0).otherwise(before(head, F.col("at"))))
        .groupBy("key")
        .agg(
            F.when(F.count("*") == F.count(F.col("left") - F.col("right")), F.sum(F.col("left") - F.col("right")))
            .cast("long")
            .alias("n_tokens")
        )
    )


def count_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap: int = OVERLAP,
    limit: int = LIMIT,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_bytes, n_tokens, over_limit.

    ``path`` is a vocabulary file of the tokenizers library.  Tokens are those of its
    encoding of the whole text, without added special tokens, truncation or
    padding; special strings inside texts become special tokens, as the library
    does it by default.  over_limit tells if there are more than ``limit``.

    A null text counts as the empty one, of no tokens.  Repeated rows, and rows without
    an id, are counted one by one.  Other columns are not read.  An empty table
    gives an empty result.
    """
    vocabulary = load_vocabulary(path)
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the vocabulary
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    is_long = F.char_length("text") > chunk_chars

    def count_short(batches):
        encoder = Encoder(spec.value)
        for batch in small(batches, 100):
            n = encoder.count_texts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    size = F.octet_length("text").cast("long")
    counted = (
        rows.filter(~is_long).select("id", "text", size.alias("n_bytes"))
        .mapInArrow(count_short, f"id {id_type}, n_bytes bigint, n_tokens bigint")
    )
    left = cut(rows.filter(is_long).withColumn("key", F.monotonically_increasing_id()))
    while not left.isEmpty():
        # A chunk is kept longer than its overlap, so a round reads a text about once.
        chunk_chars = max(chunk_chars, 4 * overlap)
        found = cut(_spliced(left.select("key", "text"), vocabulary, chunk_chars, overlap))
        done = left.join(found.dropna(), "key").select("id", size.alias("n_bytes"), "n_tokens")
        counted = counted.unionByName(done)
        left = left.join(found.filter("n_tokens IS NULL").select("key"), "key", "left_semi")
        overlap *= 8
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
