"""Periodic runs of words, found by uniting suffixes in the order of their common prefixes.

A run is a stretch of words with smallest period q that no neighbouring word extends. Each text
has its suffixes sorted; neighbours in that order and their longest common prefixes (LCP) are the
edges of a path. As in Kruskal's algorithm the edges are taken from the longest to the shortest,
and each unites two classes of suffixes. A class keeps its places in order. Two places i < j that
become neighbours when classes unite at an LCP of l have exactly l words in common from there on,
so that [i, j + l) has the period j - i. Every run of two periods or more is seeded in this way by
its start and the place one period later: a place between the two with l common words or more
would give the run a smaller period. For the same reason j - i is the smallest period of what a
seed gives, and the seeds whose preceding words differ are the runs, each once.

A run of ``least_words`` words and ``least_powers`` periods has a seed of at least ``_least_common``
common words. Suffixes that share fewer with any other suffix of their text seed nothing and are
not sorted.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from advisory_lake.llm.shared import id_and_text, slices
from advisory_lake.llm.words import Words, mixed, words_of

LEAST_WORDS, LEAST_POWERS = 24, 3
SLICE_BYTES = 2 << 20
RUNS = "ARRAY<STRUCT<start: LONG, length: LONG, period: LONG>>"

Run = tuple[int, int, int]  # start, length, period


def _least_common(least_words: int, least_powers: int) -> int:
    """Common words from a run's start and from one period later: its length less its period."""
    return min(max(least_words, least_powers * q) - q for q in range(1, least_words + 1))


def _repeating(words: Words, length: int) -> np.ndarray:
    """Places where a stretch of so many words begins that occurs elsewhere in its text."""
    numbers = words.sequences(length)
    owner = np.searchsorted(words.first, np.arange(len(numbers)), side="right") - 1
    inside = np.flatnonzero(np.arange(len(numbers)) + length <= words.first[owner + 1])
    keys = mixed(numbers[inside] ^ mixed(owner[inside], 21), 22)
    by = np.argsort(keys)
    same = keys[by][1:] == keys[by][:-1]
    twice = np.zeros(len(by), bool)
    twice[1:] |= same
    twice[:-1] |= same
    return np.sort(inside[by[twice]])


def _sorted_suffixes(ids: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """``places`` in the order of the suffixes of ``ids`` that begin there. Each shares ``width``
    ids with another one; ids end with a 0, which is nowhere else."""
    # what stands ``width`` further on decides among equal beginnings, so it is ranked as well
    both = np.unique(np.concatenate([places, places + width]))
    columns = ids[np.minimum(both[:, None] + np.arange(width), len(ids) - 1)]
    by = np.lexsort(columns.T[::-1])
    new = np.ones(len(both), bool)
    new[1:] = (columns[by[1:]] != columns[by[:-1]]).any(axis=1)
    rank = np.zeros(len(ids), np.int64)  # place of the first of equals
    rank[both[by]] = np.maximum.accumulate(np.where(new, np.arange(len(both)), 0))
    while True:
        held = rank[places]
        order = np.argsort(held, kind="stable")
        tied = held[order][1:] == held[order][:-1]
        if not tied.any():
            return places[order]
        open_ = np.zeros(len(places), bool)
        open_[1:] |= tied
        open_[:-1] |= tied
        at = places[order[open_]]
        after = rank[at + width]
        by = np.lexsort((after, rank[at]))
        at, after = at[by], after[by]
        group = rank[at]
        first = np.ones(len(at), bool)
        first[1:] = group[1:] != group[:-1]
        part = first.copy()
        part[1:] |= after[1:] != after[:-1]
        here = np.arange(len(at))
        start = np.maximum.accumulate(np.where(first, here, 0))
        rank[at] = group + np.maximum.accumulate(np.where(part, here, 0)) - start
        width *= 2


def _common_prefixes(ids: list[int], suffixes: list[int], least: int) -> list[int]:
    """LCP of each suffix with the one before it in their order, 0 when below ``least``. The
    suffix that begins a word later has at most one common word less, as long as what is left
    puts its partner among the sorted ones; so the whole takes time in proportion to the words."""
    before = dict(zip(suffixes[1:], suffixes))
    found, common, last = {}, 0, -2
    for i in sorted(before):
        common = common - 1 if i == last + 1 and common > least else 0
        j = before[i]
        while ids[i + common] == ids[j + common]:
            common += 1
        found[i], last = common, i
    return [found[i] if found[i] >= least else 0 for i in suffixes[1:]]


def _united(small: list[int], large: list[int]) -> list[tuple[int, int]]:
    """Put the places of one class into the other; the pairs that become neighbours."""
    pairs, last = [], len(small) - 1
    for k, place in enumerate(small):
        at = bisect_left(large, place)
        if at and (k == 0 or small[k - 1] < large[at - 1]):
            pairs.append((large[at - 1], place))
        if at < len(large) and (k == last or small[k + 1] > large[at]):
            pairs.append((place, large[at]))
    if 16 * len(small) > len(large):
        large += small
        large.sort()  # two rising stretches, which the sort merges
    else:
        for place in small:
            insort(large, place)
    return pairs


def runs_in(ids: np.ndarray, places: np.ndarray, least_words: int, least_powers: int) -> list[Run]:
    """The runs of one text by start, then period. ``ids`` are those of its words, ended by a 0;
    ``places`` are all from which a seed's common words occur elsewhere."""
    least = _least_common(least_words, least_powers)
    suffixes = _sorted_suffixes(ids, places, least).tolist()
    words = ids.tolist()
    common = _common_prefixes(words, suffixes, least)
    root = list(range(len(suffixes)))
    members = [[place] for place in suffixes]
    runs = []
    for edge in sorted(range(len(common)), key=common.__getitem__, reverse=True):
        level = common[edge]
        if not level:
            break
        ends = []
        for node in (edge, edge + 1):
            while root[node] != node:
                root[node] = root[root[node]]
                node = root[node]
            ends.append(node)
        large, small = sorted(ends, key=lambda node: len(members[node]), reverse=True)
        root[small] = large
        for i, j in _united(members[small], members[large]):
            period = j - i
            length = period + level
            if length >= least_words and length >= least_powers * period and (i == 0 or words[i - 1] != words[j - 1]):
                runs.append((i, length, period))
        members[small] = []
    return sorted(runs, key=lambda run: (run[0], run[2]))


def runs_of(words: Words, least_words: int = LEAST_WORDS, least_powers: int = LEAST_POWERS) -> dict[int, list[Run]]:
    """The runs of each text that has any."""
    places = _repeating(words, _least_common(least_words, least_powers))
    found = {}
    cuts = np.searchsorted(places, words.first)
    for text in np.flatnonzero(np.diff(cuts)):
        a, b = words.first[text], words.first[text + 1]
        _, ids = np.unique(words.numbers[a:b], return_inverse=True)
        own = places[cuts[text] : cuts[text + 1]] - a
        if runs := runs_in(np.append(ids + 1, 0), own, least_words, least_powers):
            found[int(text)] = runs
    return found


def without_runs(text: str, runs: list[Run]) -> str:
    """The words joined by one space, of every run its first period only."""
    words = text.encode().split()
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [word for word, kept in zip(words, keep) if kept]
    return b" ".join(words).decode()


def periodic_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_powers: int = LEAST_POWERS) -> DataFrame:
    """doc_id, n_words, runs (start, length, period in words, by start, then period) and collapsed,
    the text without what repeats in a run, words joined by one space.

    A run has at least ``least_words`` words and ``least_powers`` periods. Words are runs of bytes
    other than space and the control characters 9 to 13, taken as they are. Every row gives a row,
    also rows that repeat another and rows without doc_id; null and empty texts have no words, no
    runs and collapse to the empty text. Other columns do not matter. A text is worked on whole,
    in memory that follows its number of words.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words = words_of(part.column(1))
                found = runs_of(words, least_words, least_powers)
                texts = part.column(1).to_pylist()
                listed = [[dict(zip(("start", "length", "period"), r)) for r in found.get(i, [])] for i in range(len(texts))]
                struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(words.counts().astype(np.int64)),
                        pa.array(listed, pa.list_(struct)),
                        pa.array([without_runs(text or "", found.get(i, [])) for i, text in enumerate(texts)], pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return id_and_text(docs).mapInArrow(run, f"doc_id LONG, n_words LONG, runs {RUNS}, collapsed STRING")


def strongest(runs: Column) -> Column:
    """The run with the most periods, by the exact quotient; ties go to the smaller start, then to
    the smaller period. Null when there is none."""

    def better(kept: Column, run: Column) -> Column:
        # runs come by start, then period, so that only more periods win
        return F.when(
            kept.isNull() | (run["length"] * kept["period"] > kept["length"] * run["period"]), run
        ).otherwise(kept)

    return F.aggregate(runs, F.lit(None).cast("STRUCT<start: LONG, length: LONG, period: LONG>"), better)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run, and SHA-256 of the list of runs and of the collapsed text."""
    best = strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, chosen by the CRC-32 of doc_id, repeat a stretch of
    their words from some place to the end. Rows without doc_id stay as they are."""
    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = id_and_text(docs).withColumn("drawn", drawn)
    planted = F.col("drawn") % 10 == 0
    # every step is a column of its own, so that texts are split once
    rows = rows.withColumn("words", F.when(planted, F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")))
    rows = rows.withColumn("n", F.coalesce(F.size("words"), F.lit(-1)))
    rows = rows.withColumn("g", F.expr("drawn div 10"))
    rows = rows.withColumn("a", F.expr("if(n > 0, cast(g % n as int), 0)"))
    rows = rows.withColumn("p", F.expr("1 + cast((n - a) div (3 + g % 8) as int)"))
    tail = "slice(flatten(array_repeat(slice(words, a + 1, p), cast(1 + (n - a) div p as int))), 1, n - a)"
    changed = F.expr(f"concat_ws(' ', concat(slice(words, 1, a), {tail}))")
    return rows.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))
