"""Periodic runs against a search of every period from every place."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pyarrow as pa
import pytest

from advisory_lake.llm import periodic, queries
from advisory_lake.llm.words import words_of

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_runs(words, least_words=24, least_powers=3):
    found = []
    for q in range(1, len(words) // least_powers + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(least_words, least_powers * q):
                own = words[start : start + length]
                if not any(all(own[k] == own[k + p] for k in range(length - p)) for p in range(1, q)):
                    found.append((start, length, q))
            i += 1 if i == start else 0
    return sorted(found, key=lambda run: (run[0], run[2]))


@pytest.mark.parametrize("least", [(24, 3), (4, 2)])
def test_runs_of_random_words(least):
    rng = random.Random(3)
    some = 0
    for _ in range(300):
        letters, words = rng.choice([1, 2, 3, 30]), []
        for _ in range(rng.randrange(1, 9)):
            words += [rng.randrange(letters) for _ in range(rng.randrange(1, 13))] * rng.choice([1, 1, 2, 3, 4, 9])
        texts = [" ".join(f"w{w}" for w in words), "w0 w0", None, ""]
        found, want = periodic.runs_of(words_of(pa.array(texts)), *least), plain_runs(words, *least)
        assert found.get(0, []) == want
        some += len(want)
    assert some > 100


def test_long_texts():
    for words in (["a"] * 50_000, [f"w{i % 999}" for i in range(50_000)], ["x"] + ["a", "b"] * 20_000 + ["a"] * 300):
        [found] = periodic.runs_of(words_of(pa.array([" ".join(words)]))).values()
        assert found[0][2] == len(set(words[1:]))
        assert all(words[k] == words[k + q] for start, length, q in found for k in range(start, start + length - q))


def expected(doc_id, text):
    words = WORD.findall((text or "").encode())
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    keep = [True] * n
    for start, length, q in runs:
        keep[start + q : start + length] = [False] * (length - q)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{l},{q}\n" for s, l, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for w, k in zip(words, keep) if k)).hexdigest(),
    )


NAMES = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def test_the_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) < 6000").collect()
    found = {r.doc_id: tuple(r[n] for n in NAMES) for r in queries.op11_periodic_runs(spark, SMALL).collect()}
    assert len(found) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(found[r.doc_id] == expected(r.doc_id, r.text) for r in rows)
    assert any(run[1] for run in found.values())


def test_odd_rows(spark):
    planted = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (None, None), (1, None), (2, ""), (3, " \t\n\x0b"), (4, "a " * 30), (4, "a " * 30), (5, "é " * 40 + "x"),
            (planted[0], None), (planted[1], " "), (planted[2], "one"), (planted[3], text + "\n\t" + text)]
    docs = spark.createDataFrame([(i, t, "1", "2", "3") for i, t in rows], "doc_id LONG, text STRING, runs STRING, n STRING, words STRING")
    found = periodic.digests(periodic.periodic_runs(periodic.with_planted_runs(docs))).collect()
    assert sorted((tuple(r[n] for n in NAMES) for r in found), key=str) == sorted((expected(*r) for r in rows), key=str)
    assert periodic.digests(periodic.periodic_runs(docs.limit(0))).collect() == []
    whole = {r.doc_id: (r.n_words, r.collapsed) for r in periodic.periodic_runs(docs).where("doc_id in (2, 3, 4)").collect()}
    assert whole == {2: (0, ""), 3: (0, ""), 4: (30, "a")}


def test_the_strongest_run_is_chosen_by_the_exact_quotient(spark):
    schema = f"doc_id LONG, n_words LONG, runs {periodic.RUNS}, collapsed STRING"
    # 100/33 and 3 + 1/34 agree to the thousandth; equal quotients go to the smaller start, then period
    rows = [(1, 0, [(0, 103, 34), (5, 100, 33)], ""), (2, 0, [(2, 40, 10), (2, 80, 20), (9, 24, 6)], ""), (3, 0, [], "")]
    found = {r.doc_id: (r.start, r.length, r.period, r.exponent_milli) for r in periodic.digests(spark.createDataFrame(rows, schema)).collect()}
    assert found == {1: (5, 100, 33, 3030), 2: (2, 40, 10, 4000), 3: (None,) * 4}
