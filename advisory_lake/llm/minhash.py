"""Near duplicates: SuperMinHash signatures, banding, exact verification, components.

A document is the set of its five-word shingles. Documents with equal sets become one node.
SuperMinHash gives every shingle a random order of the signature's places; rank plus a random
fraction is the value it offers to each place, and a document stops as soon as all its places
hold values below the next rank. Bands of the signature name buckets; pairs from a bucket are
links only when the full sets agree. See ``near_duplicates`` for how buckets are searched
without forming all their pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from advisory_lake.llm.components import connected_components
from advisory_lake.llm.shared import id_and_text, slices, text_key, written
from advisory_lake.llm.words import U64, as_long, mixed, words_of

SHINGLE_WORDS = 5
BANDS, ROWS = 32, 5  # a pair shares no band once in 10**8 at a similarity of 0.85, 3 times in 10**6 at 0.80
PLAIN_RANKS = 6  # ranks whose places are traced back; later ones keep the orders
SHINGLES_AT_ONCE = 65_536
SLICE_BYTES = 2 << 20

_EMPTY = U64(0xFFFFFFFFFFFFFFFF)
_LOW = U64(0xFFFFFFFF)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle numbers of each text; fewer words than a shingle make one."""
    words = words_of(texts, lower=True)
    runs = {length: words.sequences(length) for length in range(1, SHINGLE_WORDS + 1)}
    sets = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        length = min(b - a, SHINGLE_WORDS)
        sets.append(np.unique(runs[length][a : b - length + 1]) if length else np.empty(0, U64))
    return sets


def signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    """SuperMinHash of each set: rank in the upper 32 bits, fraction in the lower."""
    result = np.full((len(sets), places), _EMPTY)
    start = 0
    while start < len(sets):
        stop, held = start, 0
        while stop < len(sets) and (held == 0 or held + len(sets[stop]) <= SHINGLES_AT_ONCE):
            held += len(sets[stop])
            stop += 1
        _sign(sets[start:stop], result[start:stop], places)
        start = stop
    return result


def _sign(sets: list[np.ndarray], result: np.ndarray, places: int) -> None:
    sizes = [len(s) for s in sets]
    shingles = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = result.reshape(-1)
    picked: list[np.ndarray] = []
    order = None
    for rank in range(places):
        if rank:
            open_sets = (result >> U64(32)).max(axis=1) >= U64(rank)
            going = open_sets[owner]
            if not going.any():
                return
            if not going.all():
                shingles, owner = shingles[going], owner[going]
                picked = [p[going] for p in picked]
                order = order[going] if order is not None else None
        draw = mixed(shingles, rank + 1)
        pick = rank + (((draw & _LOW) * U64(places - rank)) >> U64(32)).astype(np.int64)
        if rank < PLAIN_RANKS:
            place = pick.copy()
            for earlier in range(rank - 1, -1, -1):
                place[place == picked[earlier]] = earlier
            picked.append(pick)
        else:
            rows = np.arange(len(shingles))
            if order is None:
                order = np.tile(np.arange(places, dtype=np.int16), (len(shingles), 1))
                for earlier, before in enumerate(picked):
                    order[rows, before], order[rows, earlier] = order[rows, earlier], order[rows, before]
                picked = []
            place = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, rank]
        np.minimum.at(flat, owner * places + place, (draw >> U64(32)) | U64(rank << 32))


def band_numbers(signed: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A number for each band of each signature."""
    parts = signed.reshape(len(signed), bands, rows)
    numbers = np.zeros((len(signed), bands), U64)
    for row in range(rows):
        numbers = mixed(numbers ^ parts[:, :, row], row)
    return numbers


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, text_key, n_shingles, a 128-bit digest (s1, s2) of the set, its band numbers."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(part.column(1))
                some = [i for i, s in enumerate(sets) if len(s)]
                numbers = np.zeros((len(sets), bands), U64)
                if some:
                    numbers[some] = band_numbers(signatures([sets[i] for i in some], bands * rows), bands, rows)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                digests = np.frombuffer(b"".join(digests), U64).reshape(-1, 2)
                offsets = np.arange(0, len(sets) * bands + 1, bands, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array([len(s) for s in sets], pa.int64()),
                        *(pa.array(as_long(d.copy())) for d in digests.T),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(as_long(numbers.reshape(-1)))),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "s1", "s2", "bands"],
                )

    columns = id_and_text(docs).select("doc_id", "text", text_key().alias("text_key"))
    return columns.mapInArrow(
        run, "doc_id LONG, text_key LONG, n_shingles LONG, s1 LONG, s2 LONG, bands ARRAY<LONG>"
    )


def _shingle_arrays(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([as_long(s) for s in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "shingles"],
                )

    return docs.mapInArrow(run, "doc_id LONG, shingles ARRAY<LONG>")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and kept for every row.

    Two documents are linked when 100 * intersection >= percent * union of their sets.
    component_id is the smallest doc_id reachable over links, kept is doc_id = component_id.

    A document can only be linked through shingles that some other document of a bucket has, so
    those with too many of their own leave first, and pairs that cannot reach the similarity are
    not formed. In every bucket one document, the leader, is compared with all others, so that a
    bucket of copies costs one comparison each. Documents of buckets that still hold several
    components then meet by their rarest shingles: two documents that are similar enough have one
    of these in common (see ``_rare_pairs``), so that no pair that could join two components is
    left out, and near copies whose edits differ never meet.

    Null, empty and blank texts have the empty set, are linked with nothing and kept. Rows
    without doc_id take part in no link, have no component_id and are kept. Rows that repeat a
    doc_id are judged by their own text. Other columns do not matter.
    """
    signed = written(sketch(docs), "signatures")
    linkable = signed.where("doc_id is not null and n_shingles > 0")
    nodes = written(
        linkable.groupBy("s1", "s2", "n_shingles").agg(
            F.min("doc_id").alias("node"), F.first("bands").alias("bands")
        ),
        "nodes",
    )
    buckets = nodes.select("node", "n_shingles", F.posexplode("bands").alias("band", "number"))
    shared = buckets.groupBy("band", "number").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = written(buckets.join(shared.drop("members"), ["band", "number"]), "buckets")

    candidates = members.select(F.col("node").alias("doc_id")).distinct()
    texts = id_and_text(docs).join(candidates, "doc_id")
    sets = written(_shingle_arrays(texts), "sets")

    members = written(_linkable(members, sets, percent), "buckets")

    leaders = members.groupBy("band", "number").agg(F.min_by(_pivot(), F.struct(_alone(), "node")).alias("pivot"))
    links = written(_verified(_pairs(members, leaders, percent), sets, percent), "links")
    labels = connected_components(links)
    more = written(_verified(_rare_pairs(_unsettled(members, labels, leaders), sets, percent), sets, percent), "links")
    if not more.isEmpty():
        labels = connected_components(written(links.union(more), "links"))

    named = nodes.select("s1", "s2", "n_shingles", "node")
    named = named.join(labels, "node", "left").select(
        "s1", "s2", "n_shingles", F.coalesce("component", "node").alias("component_id")
    )
    empty = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    # a number of its own for every row without links, so that these rows are spread as well
    key = F.when(empty, F.xxhash64("doc_id", "text_key")).otherwise(F.col("s1"))
    rows = signed.drop("bands").withColumn("s1", key).withColumn("n", F.when(~empty, F.col("n_shingles")))
    found = rows.join(named.withColumnRenamed("n_shingles", "n"), ["s1", "s2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select(
        "doc_id",
        "text_key",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _pivot():
    return F.struct("node", "n_shingles", "shared")


def _alone():
    """Shingles that no other candidate has. Pivots with few of them come first: the text that
    others are copies of has none, and joins them all at once."""
    return (F.col("n_shingles") - F.col("shared")).alias("alone")


def _linkable(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members with ``shared``, the number of their shingles that any other candidate has; those
    that share too few for any link are left out. A shingle of one document has one owner, so
    grouping by shingle is enough."""
    each = sets.select("doc_id", F.explode("shingles").alias("shingle"))
    alone = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("node")).where("n = 1")
    several = sets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    several = several.select(F.col("doc_id").alias("node"))  # ids with several texts own nothing alone
    alone = alone.groupBy("node").agg(F.count(F.lit(1)).alias("alone")).join(several, "node", "left_anti")
    counted = members.join(alone, "node", "left").withColumn("shared", F.expr("n_shingles - coalesce(alone, 0)"))
    return counted.where(F.col("shared") * 100 >= F.col("n_shingles") * percent).drop("alone")


def _pairs(members: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b), a < b, of leaders with members of their bucket whose sizes and shares
    allow a link."""
    possible = (
        (F.col("node") != F.col("pivot.node"))
        & (F.col("n_shingles") * 100 >= F.col("pivot.n_shingles") * percent)
        & (F.col("pivot.n_shingles") * 100 >= F.col("n_shingles") * percent)
        # no more can be common than either of them shares with anyone
        & (F.least("shared", "pivot.shared") * (100 + percent) >= (F.col("n_shingles") + F.col("pivot.n_shingles")) * percent)
    )
    pairs = members.join(leaders, ["band", "number"]).where(possible)
    return pairs.select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - both
    return pairs.join(right, "b").join(left, "a").where(both * 100 >= union * percent).select("a", "b").distinct()


def _unsettled(members: DataFrame, labels: DataFrame, leaders: DataFrame) -> DataFrame:
    """(node, component) of the documents in buckets that hold several components and, outside the
    largest of these, documents that have been compared with the leader only."""
    labelled = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = leaders.select("band", "number", F.col("pivot.node").alias("leader"))
    labelled = labelled.join(first, ["band", "number"]).withColumn("open", F.col("node") != F.col("leader"))
    parts = labelled.groupBy("band", "number", "component").agg(
        F.count(F.lit(1)).alias("size"), F.count_if("open").alias("n_open")
    )
    whole = parts.groupBy("band", "number").agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum("n_open").alias("all_open"),
        F.max(F.struct("size", "n_open", "component")).alias("largest"),
    )
    going = whole.where("parts > 1 and all_open > largest.n_open").select("band", "number")
    return written(labelled.join(going, ["band", "number"]).select("node", "component").distinct(), "unsettled")


def _rare_pairs(unsettled: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b), a < b, of different components, with every pair that is similar enough.

    All sets are put in one order, from the rarest shingle to the most frequent. Sets of m and n
    shingles need c common ones, percent / (100 + percent) of m + n. The first of these in the
    order is among the first m - c + 1 shingles of the one and the first n - c + 1 of the other,
    since c - 1 more come after it in both. So documents meet by shingles in such places only.
    Within a shingle the members of its largest component do not look for each other.
    """
    own = sets.join(unsettled.select(F.col("node").alias("doc_id"), "component"), "doc_id")
    own = own.select("doc_id", F.xxhash64("shingles").alias("variant"), F.size("shingles").alias("n"), "component", "shingles")
    each = own.select("doc_id", "variant", "n", "component", F.explode("shingles").alias("shingle"))
    counted = each.join(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")), "shingle")
    order = Window.partitionBy("doc_id", "variant").orderBy("holders", "shingle")
    placed = counted.withColumn("place", F.row_number().over(order) - 1)
    # a partner has percent of the shingles at least
    first = placed.where(f"holders > 1 and place <= n - (n * {percent} + 99) div 100")
    first = written(first.select("shingle", "doc_id", "n", "component", "place"), "rare")

    parts = first.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = parts.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("parts"), F.max_by("component", F.struct("size", "component")).alias("largest")
    )
    members = first.join(largest.where("parts > 1").drop("parts"), "shingle")
    probes = members.where("component <> largest").select(
        "shingle", F.col("doc_id").alias("other"), F.col("n").alias("m"), F.col("component").alias("from_component"), F.col("place").alias("at")
    )
    common = f"((m + n) * {percent} + {99 + percent}) div {100 + percent}"
    pairs = probes.join(members, "shingle").where(
        f"component <> from_component and at <= m - {common} and place <= n - {common}"
    )
    return pairs.select(F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b")).distinct()
