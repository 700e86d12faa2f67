"""Byte-level BPE encoding and decoding with a public vocabulary.

The words of the corpus are counted, and the most frequent ones are encoded once
and sent to the tasks; their number is bounded by a parameter, which changes the
speed alone.  They are encoded by Spark higher-order functions: a fold over the
byte pieces of a word merges, in each step, the adjacent pieces of the lowest
rank, looked up in a rank map that is a literal of the plan.  The map is an
array of small maps, as a lookup in one large map would read all of it.

Rare words are merged in the Arrow batches of their texts, by the same steps on
plain lists, and those of more than WORD_BYTES bytes with a heap of pairs; the
ids are the same.  One pass over the texts does all this, so a task has one
Python worker and one copy of what was sent.
Decoding looks up the byte piece of each id and concatenates.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import sys
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small

MAP_BUCKETS = 1 << 16
FREQUENT = 400_000
WORD_BYTES = 64
PIECE = 1 << 20
NO_RANK = (1 << 31) - 1
#: Stretches that a task counts, or remembers the words of, at a time.
COUNTED = 150_000
REMEMBERED = 100_000
#: A text in which no other blank touches a space is split into words at its spaces.
TOUCHING = re.compile(r"\A | \Z| \s|\s ")
#: A text may be cut in front of a space between two characters that are not blank.
CUT = regex.compile(r"(?<=\S)(?= \S)")


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankMap:
    """The rank map as a literal: hexadecimal token to rank, in buckets by CRC32."""

    def __init__(self, ranks: dict[bytes, int], buckets: int = MAP_BUCKETS):
        table: list[dict[str, int]] = [{} for _ in range(buckets)]
        for token, rank in ranks.items():
            key = token.hex().upper()
            table[zlib.crc32(key.encode()) % buckets][key] = rank
        self.buckets = buckets
        self.literal = F.from_json(F.lit(json.dumps(table)), "array<map<string,int>>")

    def use(self, body) -> Column:
        """``body(lookup)``, in which all lookups read one copy of the literal."""

        def bound(table: Column) -> Column:
            def lookup(token: Column) -> Column:
                at = F.pmod(F.crc32(token.cast("binary")), F.lit(self.buckets)).cast("int")
                return F.try_element_at(F.get(table, at), token)

            return body(lookup)

        return _let(self.literal, bound)


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def encode_words(words: Column, table: RankMap) -> Column:
    """The ids of each of an array of words."""
    return table.use(lambda ranks: F.transform(words, lambda w: encode_word(w, ranks)))


def encode_word(word: Column, ranks) -> Column:
    """The ids of a word, as an array; ``ranks`` looks up a token in hexadecimal.

    The state is the pieces of the word and the rank of each piece with the next,
    NO_RANK for none.  A step merges the first pair of the lowest rank and looks up
    the two pairs that the merged piece is part of.
    """
    data = F.hex(F.encode(word, "UTF-8"))
    bytes_ = F.transform(
        F.sequence(F.lit(1), F.length(data) - 1, F.lit(2)), lambda i: F.substring(data, i, F.lit(2))
    )

    def rank(token):
        return F.coalesce(ranks(token), F.lit(NO_RANK))

    start = _let(
        bytes_,
        lambda pieces: F.struct(
            pieces.alias("pieces"),
            F.transform(
                F.slice(pieces, 1, F.size(pieces) - 1), lambda p, i: rank(F.concat(p, F.get(pieces, i + 1)))
            ).alias("found"),
        ),
    )

    def merged(state: Column, at: Column) -> Column:
        pieces, found = state["pieces"], state["found"]

        def with_made(made):
            before = F.when(at > 1, F.array(rank(F.concat(F.get(pieces, at - 2), made))))
            after = F.when(at < F.size(found), F.array(rank(F.concat(made, F.get(pieces, at + 1)))))
            none = F.array().cast("array<int>")
            return F.struct(
                F.concat(
                    F.slice(pieces, 1, at - 1), F.array(made), F.slice(pieces, at + 2, F.size(pieces))
                ).alias("pieces"),
                F.concat(
                    F.slice(found, 1, F.greatest(at - 2, F.lit(0))),
                    before.otherwise(none),
                    after.otherwise(none),
                    F.slice(found, at + 2, F.size(found)),
                ).alias("found"),
            )

        return _let(F.concat(F.get(pieces, at - 1), F.get(pieces, at)), with_made)

    def step(state: Column) -> Column:
        best = F.coalesce(F.array_min(state["found"]), F.lit(NO_RANK))
        return _let(
            best,
            lambda low: F.when(low == NO_RANK, state).otherwise(
                _let(F.array_position(state["found"], low).cast("int"), lambda at: merged(state, at))
            ),
        )

    rounds = F.sequence(F.lit(1), F.greatest(F.length(data) / 2 - 1, F.lit(1)).cast("int"))
    folded = F.aggregate(rounds, start, lambda state, _: step(state), lambda state: state["pieces"])
    return (
        F.when(F.length(data) == 0, F.array().cast("array<int>"))
        .when(ranks(data).isNotNull(), F.array(ranks(data)))
        .otherwise(F.transform(folded, ranks))
    )


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word of any length, in time L log L: the heap holds pairs by rank
    and place; a pair whose pieces have changed is skipped."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))  # of the piece that starts here; 0 once it is merged away
    before = list(range(-1, n - 1))
    heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, at, stop = heapq.heappop(heap)
        middle = end[at]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[at], end[middle] = stop, 0
        if stop < n:
            before[stop] = at
            if (rank := ranks.get(word[at : end[stop]])) is not None:
                heapq.heappush(heap, (rank, at, end[stop]))
        if (last := before[at]) >= 0 and (rank := ranks.get(word[last:stop])) is not None:
            heapq.heappush(heap, (rank, last, stop))
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at : end[at]]])
        at = end[at]
    return out


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word: the first pair of the lowest rank is merged in each step."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > WORD_BYTES:
        return merge_long(word, ranks)
    get = ranks.get
    pieces = [word[i : i + 1] for i in range(len(word))]
    found = [get(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
    while found and (low := min(found)) != NO_RANK:
        at = found.index(low)
        pieces[at : at + 2] = [made := pieces[at] + pieces[at + 1]]
        del found[at]
        if at:
            found[at - 1] = get(pieces[at - 1] + made, NO_RANK)
        if at < len(found):
            found[at] = get(made + pieces[at + 1], NO_RANK)
    return [ranks[piece] for piece in pieces]


def pieces_of(text: str):
    """The text in parts of about PIECE characters, cut where no word goes across."""
    at = 0
    while len(text) - at > PIECE:
        found = CUT.search(text, at + PIECE)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def stretches(text: str):
    """(stretches, whether a space goes before each) of a text, in order, whose
    words are those of the text.

    Where spaces stand alone each begins a word, so a stretch starts there; the
    same stretches come again and again.
    """
    for piece in pieces_of(text):
        found = piece.split(" ")
        if touching(piece, found):
            yield [piece], False
        else:
            yield found[:1], False
            yield found[1:], True


def touching(piece: str, found: list[str]) -> bool:
    """Whether TOUCHING is in a piece, which ``found`` has split at its spaces.

    Without other blanks than spaces and line ends, the only ones that are
    printable once a line end is a space, this takes no look at each character.
    """
    if "" in found:
        return piece != ""
    if "\n " in piece or " \n" in piece:
        return True
    return not piece.replace("\n", " ").isprintable() and TOUCHING.search(piece) is not None


def frequent_words(docs: DataFrame, text_col: str, pattern: str, most: int) -> DataFrame:
    """At most ``most`` words: those that occur at least so often that no more do."""

    def count(batches):
        find = regex.compile(pattern).findall
        plain, spaced, held = Counter(), Counter(), Counter()

        def rows():
            for stretch, n in plain.items():
                for word in find(stretch):
                    held[word] += n
            for stretch, n in spaced.items():
                for word in find(f" {stretch}"):
                    held[word] += n
            made = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"]
            )
            for counter in (plain, spaced, held):
                counter.clear()
            return made

        for batch in small(batches):
            for text in batch.column(0).to_pylist():
                for found, after_space in stretches(text or ""):
                    if after_space:
                        spaced.update(found)
                    else:
                        plain.update(found)
            if len(plain) + len(spaced) > COUNTED:
                yield rows()
        yield rows()

    counts = (
        docs.select(text_col).mapInArrow(count, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
        .filter((F.col("n") > 1) & (F.octet_length("word") <= WORD_BYTES))
    )
    counts = cut(counts)  # read twice below
    rows = counts.groupBy(F.least("n", F.lit(100_000)).alias("n")).count().orderBy(F.desc("n")).collect()
    total, least = 0, sys.maxsize
    for n, k in rows:
        total += k
        if total > most:
            break
        least = n
    return counts.filter(F.col("n") >= least).select("word")


def encode(
    docs: DataFrame, rank_path: str, pattern: str, id_col="doc_id", text_col="text",
    frequent: int = FREQUENT, decoded: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ids (binary, little-endian unsigned 32 bit),
    and with ``decoded`` also bytes, which the ids decode to.

    Words are the matches of ``pattern``; each is encoded separately, without
    special tokens.  ``frequent`` bounds the words that are sent to tasks and does
    not change the ids.  Null counts as the empty text, which has no ids; repeated
    rows are encoded alike; other columns are not read.
    """
    spark = docs.sparkSession
    ranks = load_ranks(rank_path)
    find = regex.compile(pattern).findall
    known, alone = {}, {}  # alone: the words of a space and a stretch, without the space
    if frequent:
        chosen = frequent_words(docs, text_col, pattern, frequent).repartition("word")
        ids = F.get(encode_words(F.array("word"), RankMap(ranks)), F.lit(0))
        # Written first, so that all tasks work at once and the driver reads one partition at a time.
        for row in cut(chosen.select("word", ids.alias("ids"))).toLocalIterator():
            made, word = array("I", row.ids).tobytes(), row.word
            if word[:1] == " " and find(word) == [word]:
                alone[word[1:]] = made
            else:
                known[word] = made
    sent = spark.sparkContext.broadcast((known, alone, ranks, id_pieces(ranks) if decoded else []))
    del known, alone

    def run(batches):
        known, alone, ranks, pieces = sent.value
        find = regex.compile(pattern).findall
        remembered: dict[str, bytes] = {}  # of stretches after a space

        def rare(word: str) -> bytes:
            return array("I", merge(word.encode(), ranks)).tobytes()

        def coded(stretch: str) -> bytes:
            found = find(stretch)
            return b"".join([(alone.get(w[1:]) if w[:1] == " " else None) or known.get(w) or rare(w) for w in found])

        def spaced(stretch: str) -> bytes:
            made = coded(f" {stretch}")
            if len(stretch) < WORD_BYTES:
                if len(remembered) >= REMEMBERED:
                    remembered.clear()
                remembered[stretch] = made
            return made

        def ids_of(text: str) -> bytes:
            parts = []
            for found, after_space in stretches(text):
                if after_space:
                    parts += [alone.get(s) or remembered.get(s) or spaced(s) for s in found]
                else:
                    parts += map(coded, found)
            return b"".join(parts)

        for batch in small(batches):
            out = [ids_of(text or "") for text in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(out, pa.binary())]
            if decoded:
                columns.append(pa.array([decode_ids(x, pieces) for x in out], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "ids", "bytes"][: len(columns)])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary" + ", bytes binary" * decoded)


def id_pieces(ranks: dict[bytes, int]) -> list[bytes]:
    """The byte piece of each id."""
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return pieces


def decode_ids(ids: bytes, pieces: list[bytes]) -> bytes:
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def decode(encoded: DataFrame, rank_path: str, id_col="doc_id", ids_col="ids") -> DataFrame:
    """Adds ``bytes`` (binary): the byte pieces of all ids, concatenated."""
    pieces = id_pieces(load_ranks(rank_path))
    sent = encoded.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        for batch in small(batches):
            data = [decode_ids(x or b"", sent.value) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names=[id_col, ids_col, "bytes"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, `{ids_col}` binary, bytes binary")
