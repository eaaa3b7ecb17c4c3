"""Removal of passages that repeat across documents, with a count-min prefilter.

A window is 50 consecutive words of a document. Counting every window of a corpus exactly
would shuffle all of them, so a first pass counts one anchor per stretch instead: the run of
16 words with the smallest number among the 35 such runs inside a window. Equal windows have
equal anchors, so an anchor occurs in at least as many documents as any window that has it.

1. Tasks count their anchors in count-min sketches, sharded by anchor and kept sparse.
   The sketches of a shard are summed; sums never underestimate.
2. Anchors meet their shard's merged sketch in a stream sorted by shard, so that no group is
   held whole. Those estimated to occur in two documents are kept, all others are unique.
3. Windows with a kept anchor, and only these, are grouped exactly by 96 bits of their words,
   and lose their words where a document with a smaller id has the same window.

Documents with equal texts are compared once: all but the first lose every word.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from advisory_lake.llm.shared import id_and_text, slices, text_key, written
from advisory_lake.llm.words import U64, Words, as_long, mixed, words_of

WINDOW_WORDS = 50
ANCHOR_WORDS = 16
SPAN = WINDOW_WORDS - ANCHOR_WORDS + 1  # anchors that a window chooses from
DEPTH, WIDTH = 2, 1 << 20  # rows and cells of a shard's sketch
ANCHORS_PER_SHARD = 1 << 18
SALTS = 16  # streams that look up one shard
SLICE_BYTES = 2 << 20
_NO = np.iinfo(np.int64).max


def _anchors(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The number of every anchor run, and for each window start the place of its anchor: the
    leftmost of the smallest. Windows that cross texts are included."""
    runs = words.sequences(ANCHOR_WORDS)
    n = len(words.numbers) - WINDOW_WORDS + 1
    if n <= 0:
        return runs, np.empty(0, np.int64)
    # smallest over SPAN neighbours, by doubling; the place rides along
    best, place, width = runs, np.arange(len(runs)), 1
    while width < SPAN:
        step = min(width, SPAN - width)
        right = best[step:] < best[:-step]
        place = np.where(right, place[step:], place[:-step])
        best = np.where(right, best[step:], best[:-step])
        width += step
    return runs, place[:n]


def _window_starts(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that lie within one text, and their text."""
    counts = np.maximum(words.counts() - WINDOW_WORDS + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    ahead = np.cumsum(counts) - counts
    return words.first[:-1][owner] + np.arange(len(owner)) - ahead[owner], owner


def _digest(words: Words, i: int, keep: np.ndarray | None = None) -> str:
    """SHA-256 of the kept words of text i, joined by one space."""
    a, b = words.first[i], words.first[i + 1]
    starts, ends = words.starts[a:b], words.ends[a:b]
    if keep is not None:
        starts, ends = starts[keep], ends[keep]
    if not len(starts):
        return hashlib.sha256().hexdigest()
    if keep is None and (starts[1:] - ends[:-1] == 1).all():
        plain = words.data[starts[0] : ends[-1]].copy()
        plain[ends[:-1] - starts[0]] = 32
        return hashlib.sha256(plain).hexdigest()
    raw = words.data.tobytes()
    return hashlib.sha256(b" ".join([raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())])).hexdigest()


def _first_look(docs: DataFrame) -> DataFrame:
    """For each row: number of words, SHA-256 of the word sequence, its anchors."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words = words_of(part.column(1))
                runs, place = _anchors(words)
                starts, owner = _window_starts(words)
                chosen = place[starts]
                first = np.ones(len(chosen), bool)
                first[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
                chosen, owner = chosen[first], owner[first]
                offsets = np.searchsorted(owner, np.arange(len(words.first))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(as_long(runs[chosen])))
                at = (chosen - words.first[owner]).astype(np.int32)
                places = pa.ListArray.from_arrays(pa.array(offsets), pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(words.counts().astype(np.int64)),
                        pa.array([_digest(words, i) for i in range(len(part))], pa.string()),
                        lists,
                        places,
                    ],
                    names=["doc_id", "text_key", "n_words", "all_sha256", "anchors", "places"],
                )

    return docs.mapInArrow(
        run,
        "doc_id LONG, text_key LONG, n_words LONG, all_sha256 STRING, "
        "anchors ARRAY<LONG>, places ARRAY<INT>",
    )


def _cells(anchors: np.ndarray) -> np.ndarray:
    """The cell of each anchor in each row of its shard's sketch, rows one after another."""
    return np.stack([mixed(anchors, 7 + row) % U64(WIDTH) + U64(row * WIDTH) for row in range(DEPTH)])


def _shard(anchors: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(anchors, 3) % U64(shards)).astype(np.int64)


def _partition_sketches(looked: DataFrame, shards: int) -> DataFrame:
    """Sparse sketches of a batch of documents by shard: cells in order and their counts."""

    def run(batches):
        for batch in batches:
            lists = batch.column(0)
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            anchors = lists.flatten().to_numpy().view(U64)
            if not len(anchors):
                continue
            by = np.lexsort((anchors, owner))  # an anchor counts once for each document
            anchors, owner = anchors[by], owner[by]
            new = np.ones(len(anchors), bool)
            new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
            anchors = anchors[new]
            shard = _shard(anchors, shards)
            cells = (_cells(anchors) + (shard * DEPTH * WIDTH).astype(U64)).reshape(-1)
            cells, counts = np.unique(cells, return_counts=True)
            of, cell = np.divmod(cells, U64(DEPTH * WIDTH))
            cuts = np.flatnonzero(np.diff(of, prepend=of[0] ^ U64(1), append=of[-1] ^ U64(1)))
            rows = list(zip(cuts[:-1], cuts[1:]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(of[a]) for a, _ in rows], pa.int64()),
                    pa.array([cell[a:b].astype(np.uint32).tobytes() for a, b in rows], pa.binary()),
                    pa.array([np.minimum(counts[a:b], 2).astype(np.uint8).tobytes() for a, b in rows], pa.binary()),
                ],
                names=["shard", "cells", "counts"],
            )

    return looked.mapInArrow(run, "shard LONG, cells BINARY, counts BINARY")


def _merged_sketches(partial: DataFrame) -> DataFrame:
    """Per shard, a bit for every cell whose sum over all sketches is two or more. A group is
    the sparse sketches of one shard, whose size the number of shards bounds."""

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        # two counts are told from one; more need not be told apart
        total = np.zeros(DEPTH * WIDTH, np.uint8)
        for cells, counts in zip(frame["cells"], frame["counts"]):
            at = np.frombuffer(cells, np.uint32)
            total[at] = np.minimum(total[at] + np.frombuffer(counts, np.uint8), 2)
        return pd.DataFrame({"shard": [key[0]], "repeated": [np.packbits(total == 2).tobytes()]})

    return partial.groupBy("shard").applyInPandas(merge, "shard LONG, repeated BINARY")


def _estimated_repeated(looked: DataFrame, sketches: DataFrame, shards: int) -> DataFrame:
    """(doc_id, text_key, places) of anchors whose estimate is two or more."""
    def explode(batches):
        for batch in batches:
            lists, places = batch.column(2), batch.column(3)
            rows = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            anchors = lists.flatten().to_numpy()
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_shard(anchors.view(U64), shards)),
                    batch.column(0).take(taken),
                    batch.column(1).take(taken),
                    pa.array(anchors),
                    places.flatten(),
                ],
                names=["shard", "doc_id", "text_key", "anchor", "place"],
            )

    anchors = looked.select("doc_id", "text_key", "anchors", "places").mapInArrow(
        explode, "shard LONG, doc_id LONG, text_key LONG, anchor LONG, place INT"
    )
    asked = anchors.withColumn("salt", F.pmod("text_key", F.lit(SALTS))).withColumn("repeated", F.lit(None).cast("binary"))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    bits = sketches.withColumn("salt", salts).select("shard", "salt", "repeated")
    stream = bits.unionByName(asked, allowMissingColumns=True)
    # a sketch comes before the anchors that ask it
    stream = stream.repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("repeated").isNull())

    def look_up(batches):
        bits = None
        for batch in batches:
            shard_salt = batch.column(0).to_numpy() * SALTS + batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(shard_salt)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                part = batch.slice(a, b - a)
                if part.column(2)[0].is_valid:
                    bits = np.unpackbits(np.frombuffer(part.column(2)[0].as_py(), np.uint8))
                    part = part.slice(1)
                if not len(part):
                    continue
                cells = _cells(part.column(5).to_numpy().view(U64))
                seen = bits[cells[0].astype(np.int64)].astype(bool)
                for row in cells[1:]:
                    seen &= bits[row.astype(np.int64)].astype(bool)
                yield part.select(["doc_id", "text_key", "place"]).filter(pa.array(seen))

    return stream.select("shard", "salt", "repeated", "doc_id", "text_key", "anchor", "place").mapInArrow(
        look_up, "doc_id LONG, text_key LONG, place INT"
    )


def _candidate_windows(texts: DataFrame) -> DataFrame:
    """Windows whose anchor is estimated repeated: 96 bits of their words, owner and start."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words = words_of(part.column(1))
                _, place = _anchors(words)
                starts, owner = _window_starts(words)
                lists = part.column(3)
                flat = lists.flatten().to_numpy()
                of = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
                kept = np.zeros(len(words.numbers) + 1, bool)
                kept[words.first[of] + flat] = True
                wanted = kept[place[starts]]
                starts, owner = starts[wanted], owner[wanted]
                taken = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(as_long(words.sequences(WINDOW_WORDS, 0)[starts])),
                        pa.array((words.sequences(WINDOW_WORDS, 1)[starts] >> U64(32)).astype(np.int64)),
                        part.column(0).take(taken),
                        part.column(2).take(taken),
                        pa.array((starts - words.first[owner]).astype(np.int32)),
                    ],
                    names=["h1", "h2", "doc_id", "own_key", "start"],
                )

    return texts.select("doc_id", "text", "own_key", "places").mapInArrow(
        run, "h1 LONG, h2 LONG, doc_id LONG, own_key LONG, start INT"
    )


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows (doc_id, text_key, n_words, all_sha256, copy) and the window starts to remove
    (doc_id, text_key, starts). ``copy`` marks texts that a smaller doc_id has whole."""
    keyed = id_and_text(docs).withColumn("text_key", text_key())
    looked = written(_first_look(keyed), "anchors")
    spark: SparkSession = docs.sparkSession

    total = looked.agg(F.sum(F.size("anchors"))).first()[0] or 0
    shards = max(1, -(-total // ANCHORS_PER_SHARD))
    sketches = written(_merged_sketches(_partition_sketches(looked.select("anchors"), shards)), "sketches")
    flagged = _estimated_repeated(looked, sketches, shards)
    by_text = flagged.where("doc_id is not null").groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("places"))

    # texts that are whole copies: only the smallest doc_id goes on
    same = looked.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= WINDOW_WORDS))
    firsts = same.groupBy("all_sha256", "n_words").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("n > 1").select(F.unhex("all_sha256").alias("whole"), "n_words", "first_id")
    # texts that can have no copy are joined on a key of their own, so that they are spread as well
    short = F.col("n_words") < WINDOW_WORDS
    key = F.when(short, F.encode(F.hex(F.xxhash64("doc_id", "text_key")), "UTF-8")).otherwise(F.unhex("all_sha256"))
    rows = looked.select("doc_id", "text_key", "n_words", "all_sha256", key.alias("whole"))
    rows = rows.join(firsts, ["whole", "n_words"], "left")
    rows = written(
        rows.select(
            "doc_id", "text_key", "n_words", "all_sha256", F.coalesce(F.expr("doc_id > first_id"), F.lit(False)).alias("copy")
        ),
        "rows",
    )
    asked = by_text.join(rows.where("not copy").select("doc_id", "text_key").distinct(), ["doc_id", "text_key"])
    # windows name their text by doc_id alone unless the id has several texts
    several = rows.groupBy("doc_id").agg((F.min("text_key") < F.max("text_key")).alias("several")).where("several")
    asked = asked.join(several, "doc_id", "left").withColumn("own_key", F.expr("if(several, text_key, 0)"))
    asked = written(asked.drop("several"), "asked")

    texts = keyed.where("doc_id is not null").join(asked, ["doc_id", "text_key"])
    # made twice, for counting and for marking: cheaper than keeping them, the texts move once
    windows = _candidate_windows(texts)
    least = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    gone = windows.join(least.where("n > 1").drop("n"), ["h1", "h2"]).where("doc_id > least")
    starts = gone.groupBy("doc_id", "own_key").agg(F.collect_set("start").alias("starts"))
    keys = asked.select("doc_id", "own_key", "text_key")
    return rows, starts.join(keys, ["doc_id", "own_key"]).select("doc_id", "text_key", "starts")


def _kept_words(part: pa.RecordBatch, words: Words, starts: pa.Array) -> list[np.ndarray | None]:
    """For each text which words stay, None for all of them."""
    result: list[np.ndarray | None] = []
    for i, count in enumerate(words.counts()):
        if not starts[i].is_valid:
            result.append(None)
            continue
        at = np.asarray(starts[i].as_py(), np.int64)
        edges = np.zeros(count + 1, np.int64)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + WINDOW_WORDS, -1)
        result.append(np.cumsum(edges[:-1]) == 0)
    return result


def removed_words(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row.

    A word goes when a window over it also starts in a document with a smaller doc_id; windows
    are those of the input. Null and empty texts have no words; texts of fewer words than a
    window lose none. Rows without doc_id lose nothing and take nothing from others, nor do rows
    with equal doc_id from each other. Repeated rows give repeated rows; other columns do not
    matter.
    """
    rows, gone = repeats(docs)
    texts = id_and_text(docs).withColumn("text_key", text_key()).join(gone, ["doc_id", "text_key"])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words = words_of(part.column(1))
                kept = _kept_words(part, words, part.column(3))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array([int((~k).sum()) for k in kept], pa.int64()),
                        pa.array([_digest(words, i, k) for i, k in enumerate(kept)], pa.string()),
                    ],
                    names=["doc_id", "text_key", "n_removed", "sha256"],
                )

    cut = texts.select("doc_id", "text", "text_key", "starts").mapInArrow(
        run, "doc_id LONG, text_key LONG, n_removed LONG, sha256 STRING"
    )
    found = rows.join(cut.dropDuplicates(["doc_id", "text_key"]), ["doc_id", "text_key"], "left")
    nothing = hashlib.sha256().hexdigest()
    return found.select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.lit(nothing)).otherwise(F.coalesce("sha256", "all_sha256")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The same rows and columns with repeated passages cut out of ``text``.

    The kept words of a text that loses some are joined by one space; other texts stay as they
    are, null ones too.
    """
    rows, gone = repeats(docs)
    copies = rows.where("copy").select("doc_id", "text_key", F.lit(None).cast("array<int>").alias("starts"))
    cuts = gone.unionByName(copies).dropDuplicates(["doc_id", "text_key"])
    cuts = cuts.select(
        F.col("doc_id").alias("_cut_id"), F.col("text_key").alias("_cut_key"), F.col("starts").alias("_cut_starts")
    )
    own = (F.col("doc_id").cast("long") == F.col("_cut_id")) & (text_key() == F.col("_cut_key"))
    joined = docs.join(cuts, own, "left")
    cut = F.when(F.col("_cut_id").isNotNull(), _shorten("text", "_cut_starts")).otherwise(F.col("text"))
    return joined.withColumn("text", cut).drop("_cut_id", "_cut_key", "_cut_starts")


@F.pandas_udf(StringType())
def _shorten(texts: pd.Series, starts: pd.Series) -> pd.Series:
    return pd.Series([_shortened(t, s) for t, s in zip(texts, starts)], dtype=object)


def _shortened(text: str | None, starts) -> str:
    """Without starts nothing stays."""
    if text is None or starts is None:
        return ""
    words = text.encode().split()
    keep = np.ones(len(words), bool)
    for start in starts:
        keep[start : start + WINDOW_WORDS] = False
    return b" ".join([w for w, k in zip(words, keep) if k]).decode()
