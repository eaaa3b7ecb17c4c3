"""Documents to sequences of tokens, packed by minimum bin slack.

Tokens are counted once, in tasks. What packing needs is only how many pieces there are of
each length, at most one number per length up to that of a sequence. Minimum bin slack runs
on that table: the longest length left is taken, a bitset subset-sum over the lengths left
finds the fullest sequence with it, and the combination is removed as often as the counts
allow, which is what repeating the search would do. Every removal uses up a length, so there
are no more combinations than lengths, however large the corpus is.

Pieces then find their places alone: a piece's rank among those of its length decides the
combination, the copy of it and the slot. Ranks come from counts per length and bucket, so
that no length is gathered in one task.
"""

from __future__ import annotations

import json
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from advisory_lake.llm.bpe import byte_letters
from advisory_lake.llm.shared import id_and_text, slices, worker_cache, written

SEQUENCE_TOKENS = 2048
PIECES_PER_BUCKET = 100_000
SLICE_BYTES = 4 << 20
CACHED_CHUNKS = 150_000  # about 30 MB in a worker
LONGEST_CACHED = 64
_MARKS = ".,;:!?*&%$#|"


# ---------------------------------------------------------------- tokens


class ByteTokenizer:
    """A byte-level BPE tokenizer file, with the ids of short stretches remembered.

    Between two words the file's pattern always cuts before a single space, and around a single
    line feed, when no other white space touches them. Texts are taken apart there, and each
    stretch is encoded once; texts with other white space or added tokens go to the library whole.
    """

    def __init__(self, path: str):
        import re

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if all(c in byte_of for c in token)}
        added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        ranks = {token: i for token, i in ranks.items() if i not in added.values()}
        self.added = list(added)
        self.merge = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.odd = re.compile(r"\s\s|[^\S \n]|^\s|\s$")
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit numbers."""
        if any(token in text for token in self.added):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if self.odd.search(text):
            return self._ids(text)
        known, parts = self.known.get, []
        for n, line in enumerate(text.split("\n")):
            first, *others = line.split(" ")
            if n:
                parts.append(known("\n") or self._stretch("\n"))
            if first:
                parts.append(known(first) or self._stretch(first))
            for word in others:
                word = " " + word
                parts.append(known(word) or self._stretch(word))
        return b"".join(parts)

    def _ids(self, text: str) -> bytes:
        return array("I", self.merge.encode_ordinary(text)).tobytes()

    def _stretch(self, text: str) -> bytes:
        stem = text.rstrip(_MARKS)
        if stem and stem != text and stem[-1].isalnum():
            # letters and digits never share a token with the marks after them
            return self._known(stem) + self._known(text[len(stem) :])
        return self._known(text)

    def _known(self, text: str) -> bytes:
        ids = self.known.get(text)
        if ids is None:
            ids = self._ids(text)
            if len(text) <= LONGEST_CACHED:
                if len(self.known) >= CACHED_CHUNKS:
                    self.known.clear()
                self.known[text] = ids
        return ids


def byte_tokenizer(path: str) -> ByteTokenizer:
    """One per worker process."""
    cache = worker_cache("packing")
    if path not in cache:
        cache[path] = ByteTokenizer(path)
    return cache[path]


def pieces_of(docs: DataFrame, path: str, limit: int = SEQUENCE_TOKENS, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's tokens and its end token.

    Documents longer than ``limit`` are cut so that all pieces but the first are full.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        tail = array("I", [end]).tobytes()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                columns: list[list] = [[] for _ in names]
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = byte_tokenizer(path).encode(text or "") + tail
                    total = len(ids) // 4
                    start, size, piece = 0, total % limit or min(limit, total), 0
                    while start < total:
                        row = (doc_id, piece, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]))
                        for column, value in zip(columns, row):
                            column.append(value)
                        start, size, piece = start + size, limit, piece + 1
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return id_and_text(docs).mapInArrow(run, "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG")


# ---------------------------------------------------------------- combinations


def fullest(lengths: list[int], counts: dict[int, int], limit: int) -> list[int]:
    """The combination with the longest length whose sum comes closest to ``limit``.

    ``lengths`` are those with a count, longest first. Bit s of a set says that some
    combination sums to s; the sets after each step lead back to one combination.
    """
    chosen = [lengths[0]]
    room = limit - lengths[0]
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in lengths:
        copies = counts[length] - (length == lengths[0])
        copies = min(copies, room // length)
        taken = 1
        while copies > 0:  # bundles of 1, 2, 4, ... copies
            bundle = min(taken, copies)
            after = (reach | reach << (bundle * length)) & mask
            if after != reach:
                steps.append((length, bundle, reach))
                reach = after
            copies -= bundle
            taken *= 2
        if reach >> room:
            break
    total = reach.bit_length() - 1
    for length, bundle, before in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * bundle
            total -= bundle * length
    return chosen


def combinations(counts: dict[int, int], limit: int = SEQUENCE_TOKENS) -> list[tuple[list[int], int]]:
    """(lengths, how often) until every piece is in a sequence."""
    counts = {length: n for length, n in counts.items() if n > 0}
    lengths = sorted(counts, reverse=True)
    made = []
    while lengths:
        chosen = fullest(lengths, counts, limit)
        used = {length: chosen.count(length) for length in set(chosen)}
        often = min(counts[length] // n for length, n in used.items())
        made.append((chosen, often))
        for length, n in used.items():
            counts[length] -= n * often
        lengths = [length for length in lengths if counts[length]]
    return made


def places(made: list[tuple[list[int], int]]) -> pd.DataFrame:
    """For each length, in order of rank: the ranks a combination takes (from low on), the
    first of its sequences, the pieces of the length per sequence, and the offsets of those."""
    rows, low, sequence = [], {}, 0
    for chosen, often in made:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in chosen:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, own in offsets.items():
            rows.append((length, low.get(length, 0), sequence, own))
            low[length] = low.get(length, 0) + len(own) * often
        sequence += often
    return pd.DataFrame(rows, columns=["length", "low", "sequence", "offsets"])


# ---------------------------------------------------------------- places


def packed(docs: DataFrame, path: str, limit: int = SEQUENCE_TOKENS, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece.

    Null and empty texts are their end token alone. Every row is packed, also without doc_id
    and when it repeats another; other columns do not matter. Sequences hold at most ``limit``
    tokens and are filled without gaps from 0.
    """
    pieces = written(pieces_of(docs, path, limit, end), "pieces")
    # one row per length at most: bounded by the length of a sequence, not by the corpus
    table = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {row.length: row.n for row in table}
    found = places(combinations(counts, limit))
    by_length = {length: group.reset_index(drop=True) for length, group in found.groupby("length")}

    buckets = max(1, -(-sum(counts.values()) // PIECES_PER_BUCKET))
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    dealt = pieces.withColumn("bucket", bucket)
    sizes = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("own", F.row_number().over(within) - 1).join(ahead, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("own") + F.col("ahead")).alias("rank"))

    def place(batches):
        for batch in batches:
            lengths, ranks = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                rows = by_length[int(length)]
                which = np.searchsorted(rows["low"].to_numpy(), ranks[own], side="right") - 1
                per = rows["offsets"].map(len).to_numpy()[which]
                copy, slot = np.divmod(ranks[own] - rows["low"].to_numpy()[which], per)
                sequence[own] = rows["sequence"].to_numpy()[which] + copy
                slots = rows["offsets"].to_list()
                offset[own] = [slots[w][s] for w, s in zip(which, slot)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        place,
        "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG, sequence_id LONG, offset LONG",
    )
