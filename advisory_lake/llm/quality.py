"""Quality rules: plain text measures, and the perplexity of an n-gram language model.

The model is a modified Kneser-Ney model of runs of five letters for each language. Spark counts
the runs of all documents and derives discounts, context sums and probabilities with grouped sums
and joins; letters are whole code points, no count is pruned, and the model grows with the corpus.
It is stored as sorted arrays of 64-bit hashes with their logarithms, cut by hash into shards of
about 2**18. Texts never carry the model about: each group of files asks once for every run it
has, the questions stream past the shards in order, and the answers are filed by group. A document
is rejected when its perplexity is outside the band of its language, which the perplexities of all
its documents set.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from advisory_lake.llm.shared import ship_package, slices, worker_cache, written
from advisory_lake.llm.words import as_long, mixed, words_of
from advisory_lake.session import run_folder
from advisory_lake.sources.stores import arrow_uri

ORDER = 5
SHARD_ROWS = 1 << 18  # runs of a shard of the model, about
GROUP_DOCS = 1 << 16  # documents of a group of files, about
HELD_RUNS = 1_000_000  # distinct runs a counting task holds before it hands them on
GROUPS_AT_ONCE = 2  # groups whose answers a worker keeps
SALTS = 8
BAND, SHORT_TEXT = 7.0, 300.0  # median deviations from the median, more for short texts
LEAST_DEVIATION = 0.005
LEAST_WORDS, REPEAT_WORDS, MOST_REPEATED = 20, 8, 30
PIECE_BYTES = 1 << 20
SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\v\f\r"


# ---------------------------------------------------------------- letters


def runs_of(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct runs of ``order`` letters as rows of code points, how often each occurs, for
    every letter the row of the run that ends there, and the letters of each text. Texts begin
    after ``order`` - 1 line feeds."""
    lead = "\n" * (order - 1)
    codes = np.frombuffer("".join([lead + text for text in texts]).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(text) for text in texts], np.int64)
    firsts = np.cumsum(sizes + order - 1) - (sizes + order - 1)
    places = np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    if not len(places):
        return np.empty((0, order), np.uint32), np.empty(0, np.int64), places, sizes
    # letters become their ranks in the piece, and runs numbers to that base
    rank = np.zeros(int(codes.max()) + 1, np.int64)
    rank[codes] = 1
    width = int(rank.sum())
    rank = np.cumsum(rank) - 1
    letters, values = rank[codes], width
    numbers = letters[places]
    for k in range(1, order):
        if values > (1 << 62) // width:  # ranks in place of numbers that would grow too long
            known, numbers = np.unique(numbers, return_inverse=True)
            values = len(known)
        numbers, values = numbers * width + letters[places + k], values * width
    by = np.argsort(numbers)
    ordered = numbers[by]
    new = np.ones(len(by), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(new)
    own = np.empty(len(by), np.int64)
    own[by] = np.cumsum(new) - 1
    return codes[places[by[starts]][:, None] + np.arange(order)], np.diff(np.append(starts, len(by))), own, sizes


def hashed(runs: np.ndarray, language: str) -> np.ndarray:
    """64-bit hashes of rows of code points, other ones for each language."""
    seed = int.from_bytes(hashlib.blake2b(language.encode(), digest_size=8).digest(), "little")
    found = np.full(len(runs), seed, np.uint64)
    for k in range(runs.shape[1]):
        found = mixed(found ^ runs[:, k].astype(np.uint64), 100 + k)
    return found


def _strings(runs: np.ndarray) -> list[str]:
    whole, order = runs.astype("<u4").tobytes().decode("utf-32-le"), runs.shape[1]
    return [whole[i : i + order] for i in range(0, len(whole), order)]


def _language() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")


def grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, text, lang, piece): every document belongs to the group
    of its file, whatever the splits of a scan are. Rows that come from no file are written first."""
    ship_package(docs.sparkSession)
    file = F.input_file_name()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), _language())
    n, homeless = docs.select(file.alias("file")).agg(F.count(F.lit(1)), F.count_if(F.col("file") == "")).first()
    if homeless:
        rows = written(rows, "texts")
    groups = max(1, -(-n // GROUP_DOCS))
    return rows.withColumn("piece", F.pmod(F.xxhash64(file), F.lit(groups)))


def _pieces(batches):
    """Small parts of the batches, their texts, and the rows of each group and language."""
    for batch in batches:
        for part in slices(batch, "text", PIECE_BYTES):
            texts = part.column(1).to_pylist()
            own: dict[tuple[int, str], list[int]] = {}
            for i, key in enumerate(zip(part.column(3).to_pylist(), part.column(2).to_pylist())):
                own.setdefault(key, []).append(i)
            yield part, texts, own


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Hashes, runs and counts of several pieces as those of one."""
    hashes, runs, n = (np.concatenate(column) for column in zip(*parts))
    by = np.argsort(hashes)
    hashes = hashes[by]
    starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(by) else by
    return hashes[starts], runs[by[starts]], np.add.reduceat(n[by], starts) if len(by) else n


def _rows(held: dict[tuple[int, str], list[tuple[np.ndarray, ...]]]):
    for (group, language), parts in held.items():
        hashes, runs, n = _summed(parts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(n), group, np.int64)), pa.array([language] * len(n), pa.string()), pa.array(_strings(runs), pa.string()),
                pa.array(as_long(hashes)), pa.array(n.astype(np.int64)),
            ],
            names=["piece", "lang", "gram", "hash", "n"],
        )


def run_counts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(piece, lang, gram, hash, n): the runs of each group, each once or a few times."""

    def counted(batches):
        held: dict[tuple[int, str], list[tuple[np.ndarray, ...]]] = {}
        size = 0
        for _, texts, own in _pieces(batches):
            for key, at in own.items():
                runs, n, _, _ = runs_of([texts[i] for i in at], order)
                held.setdefault(key, []).append((hashed(runs, key[1]), runs, n))
                size += len(runs)
            if size > HELD_RUNS:
                held = {key: [_summed(parts)] for key, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                if 2 * size > HELD_RUNS:  # that many different ones
                    yield from _rows(held)
                    held, size = {}, 0
        yield from _rows(held)

    return rows.select("doc_id", "text", "lang", "piece").mapInArrow(counted, "piece LONG, lang STRING, gram STRING, hash LONG, n LONG")


# ---------------------------------------------------------------- modified Kneser-Ney


def _ratio(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))


def _discounts(counts: DataFrame) -> DataFrame:
    """Per language what to take from counts of one, two and more, from the numbers of n-grams
    that occur one to four times. Where those are too few for the estimate it stays within 0
    and the count."""
    of = counts.groupBy("lang").agg(*[F.count_if(F.col("n") == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.coalesce(F.col("n1") / F.nullif(F.col("n1") + 2 * F.col("n2"), F.lit(0.0)), F.lit(0.0))
    for k in (1, 2, 3):
        estimate = k - (k + 1) * y * _ratio(f"n{k + 1}", f"n{k}")
        of = of.withColumn(f"d{k}", F.when(F.col(f"n{k}") > 0, F.greatest(F.lit(0.0), F.least(F.lit(float(k)), estimate))).otherwise(F.lit(0.5)))
    return of.select("lang", "d1", "d2", "d3")


def _level(counts: DataFrame, lower: DataFrame | None) -> DataFrame:
    """(lang, gram, p) of one order, given that of the order below."""
    discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    cut = counts.join(_discounts(counts), "lang").withColumn("d", discount)
    cut = cut.withColumn("context", F.expr("substring(gram, 1, length(gram) - 1)"))
    contexts = cut.groupBy("lang", "context").agg(F.sum("n").cast("double").alias("total"), F.sum("d").alias("taken"))
    contexts = contexts.withColumn("gamma", F.col("taken") / F.col("total"))
    own = cut.join(contexts, ["lang", "context"])
    if lower is None:  # the order below the lowest: all letters alike, and one for unknown ones
        letters = counts.groupBy("lang").agg((1 / (F.count(F.lit(1)) + 1)).alias("below"))
        own = own.join(letters, "lang")
    else:
        own = own.withColumn("suffix", F.substring("gram", 2, ORDER))
        own = own.join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"])
    p = (F.col("n") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("below")
    return own.select("lang", "gram", p.alias("p"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, p) of all counted runs of the highest order. Shorter runs count by the number
    of letters before them."""
    by_order = {order: counts}
    for k in range(order - 1, 0, -1):
        shorter = by_order[k + 1].select("lang", F.substring("gram", 2, order).alias("gram"))
        by_order[k] = written(shorter.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n")), "grams")
    lower = None
    for k in range(1, order + 1):
        lower = written(_level(by_order[k], lower), "probabilities")
    return lower


def store(model: DataFrame, order: int = ORDER) -> tuple[str, int]:
    """Write the model as sorted hashes with the logarithms of their probabilities, a folder for
    each shard; returns the folder and how many leading bits of a hash name its shard."""
    bits = max(0, (model.count() - 1) // SHARD_ROWS).bit_length()

    def cells(batches):
        for batch in batches:
            languages, grams = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            runs = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(-1, order)
            found = np.zeros(len(grams), np.uint64)
            for language in sorted(set(languages)):
                own = languages == language
                found[own] = hashed(runs[own], language)
            yield pa.RecordBatch.from_arrays(
                [pa.array(as_long(found)), pa.array(np.log(batch.column(2).to_numpy()).astype(np.float32))], names=["hash", "value"]
            )

    path = run_folder(model.sparkSession, "language-model")
    rows = model.select("lang", "gram", "p").mapInArrow(cells, "hash LONG, value FLOAT").withColumn("shard", shard_of("hash", bits))
    rows.repartition("shard").sortWithinPartitions("shard", "hash").write.partitionBy("shard").parquet(path)
    return path, bits


def shard_of(column: str, bits: int) -> Column:
    return F.shiftrightunsigned(F.col(column), 64 - bits) if bits else F.lit(0).cast("long")


def _read(folder: str, key: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in order and their values."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    table = pq.read_table(f"{base}/{key}={number}", columns=["hash", "value"], filesystem=store, partitioning=None)
    cells, values = table.column("hash").to_numpy(), table.column("value").to_numpy()
    by = np.argsort(cells, kind="stable")
    return cells[by], values[by]


def _found(cells: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(cells, wanted), len(cells) - 1)
    if not (cells[at] == wanted).all():
        raise LookupError("a run of the corpus is not in what was counted; the input has changed")
    return values[at]


def answered(counts: DataFrame, models: str, bits: int) -> str:
    """Write the logarithm of every run of every group, a folder for each group."""
    uri = arrow_uri(models)

    def run(batches):
        for batch in batches:
            shard, piece, cell = (batch.column(i).to_numpy() for i in range(3))
            new = np.ones(len(cell), bool)  # several tasks may have asked for a group
            new[1:] = (cell[1:] != cell[:-1]) | (piece[1:] != piece[:-1])
            shard, piece, cell = shard[new], piece[new], cell[new]
            values = np.zeros(len(cell), np.float32)
            for number in np.unique(shard).tolist():
                kept = worker_cache(f"quality-shards {uri}")
                if number not in kept:
                    kept.clear()
                    kept[number] = _read(uri, "shard", number)
                own = shard == number
                values[own] = _found(*kept[number], cell[own])
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(cell), pa.array(values)], names=["piece", "hash", "value"])

    path = run_folder(counts.sparkSession, "answers")
    asked = counts.select(shard_of("hash", bits).alias("shard"), "piece", "hash")
    asked = asked.repartition("shard", F.pmod("piece", F.lit(SALTS))).sortWithinPartitions("shard", "piece", "hash")
    found = asked.mapInArrow(run, "piece LONG, hash LONG, value FLOAT")
    found.repartition("piece", F.pmod("hash", F.lit(SALTS))).sortWithinPartitions("piece", "hash").write.partitionBy("piece").parquet(path)
    return path


def _answers(uri: str, group: int) -> tuple[np.ndarray, np.ndarray]:
    kept = worker_cache(f"quality {uri}")
    if group not in kept:
        while len(kept) >= GROUPS_AT_ONCE:
            del kept[next(iter(kept))]
        kept[group] = _read(uri, "piece", group)
    return kept[group]


# ---------------------------------------------------------------- measures and verdict


def _repeated(numbers: np.ndarray) -> int:
    """Words in windows that occur twice or more; ``numbers`` are those of the windows."""
    if len(numbers) < 2:
        return 0
    by = np.sort(numbers)
    twice = np.unique(by[1:][by[1:] == by[:-1]])
    if not len(twice):
        return 0
    at = np.minimum(np.searchsorted(twice, numbers), len(twice) - 1)
    edges = np.zeros(len(numbers) + REPEAT_WORDS + 1, np.int64)
    hits = np.flatnonzero(twice[at] == numbers)
    np.add.at(edges, hits, 1)
    np.add.at(edges, hits + REPEAT_WORDS, -1)
    return int((np.cumsum(edges) > 0).sum())


def _measures(texts: pa.Array) -> list[list[int]]:
    words = words_of(texts)
    runs = words.sequences(REPEAT_WORDS)
    rows = []
    for text, a, b in zip(texts.to_pylist(), words.first[:-1], words.first[1:]):
        lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
        blanks = sum(map(text.count, _BLANKS))
        symbols = sum(map(text.count, SYMBOLS))
        repeated = _repeated(runs[a : b - REPEAT_WORDS + 1]) if b - a >= REPEAT_WORDS else 0
        rows.append([int(b - a), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated])
    return rows


def measured(rows: DataFrame, answers: str, order: int = ORDER) -> DataFrame:
    """The measures of every document and the mean surprise of its letters, in nats."""
    uri = arrow_uri(answers)
    names = ["doc_id", "lang", "n_chars", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "surprise"]

    def run(batches):
        for part, texts, own in _pieces(batches):
            surprise = np.zeros(len(texts))
            for (group, language), at in own.items():
                runs, _, letters, sizes = runs_of([texts[i] for i in at], order)
                if len(runs):
                    values = _found(*_answers(uri, group), as_long(hashed(runs, language))).astype(np.float64)
                    sums = np.concatenate([[0.0], np.cumsum(values[letters])])
                    ends = np.cumsum(sizes)
                    surprise[at] = -(sums[ends] - sums[ends - sizes]) / np.maximum(sizes, 1)
            plain = np.array(_measures(part.column(1)), np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array([len(t) for t in texts], pa.int64()), *(pa.array(c) for c in plain.T), pa.array(surprise)],
                names=names,
            )

    return rows.select("doc_id", "text", "lang", "piece").mapInArrow(
        run,
        "doc_id LONG, lang STRING, n_chars LONG, n_words LONG, word_chars LONG, n_symbols LONG, n_dup_lines LONG, "
        "n_repeat_words LONG, surprise DOUBLE",
    )


def bands(rows: DataFrame) -> DataFrame:
    """(lang, middle, deviation): the median surprise and the median distance from it, over all
    documents that pass the plain rules. Surprise is rounded, so that a group has few values."""
    passing = rows.where("not base_failed").select("lang", F.round("surprise", 3).alias("surprise"))
    middles = passing.groupBy("lang").agg(F.percentile("surprise", F.lit(0.5)).alias("middle"))
    away = passing.join(middles, "lang").withColumn("away", F.round(F.abs(F.col("surprise") - F.col("middle")), 4))
    return away.groupBy("lang").agg(F.first("middle").alias("middle"), F.percentile("away", F.lit(0.5)).alias("deviation"))


def judged(docs: DataFrame, band: float = BAND) -> DataFrame:
    """doc_id, n_words, the measures, base_failed, kept, perplexity, lower and upper bound.

    ``kept`` is false for documents with fewer than 20 words or more than 30 % of them in
    repeated eight-word windows, and for those outside their language's band, whose width is
    ``band`` median deviations, more for texts of few letters. Null texts count as empty; null
    languages are one language. A language without a passing document rejects nothing more.
    Every row gives a row; columns other than doc_id, text and lang do not matter.
    """
    texts = grouped(docs)
    counts = written(run_counts(texts), "runs")
    model = kneser_ney(written(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams"))
    answers = answered(counts, *store(model))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = written(measured(texts, answers).withColumn("base_failed", failed), "measures")
    found = rows.join(bands(rows), "lang", "left")
    width = band * F.greatest("deviation", F.lit(LEAST_DEVIATION)) * F.sqrt(1 + SHORT_TEXT / F.greatest("n_chars", F.lit(1)))
    lower, upper = F.exp(F.col("middle") - width), F.exp(F.col("middle") + width)
    found = found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.exp("surprise").alias("perplexity"), lower.alias("lower"), upper.alias("upper"),
    )
    inside = F.coalesce(F.col("perplexity").between(F.col("lower"), F.col("upper")), F.lit(True))
    return found.withColumn("kept", ~F.col("base_failed") & inside)
