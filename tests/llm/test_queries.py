"""The registered queries on the test tables: against SQL, or against plain Python."""

import hashlib
import re
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from harness import duck, duck_rows, spark_rows
from tokenizers import Tokenizer

from advisory_lake.llm import html, queries, sql

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def rows_of(spark, name, tables_dir=SMALL):
    return queries.all_queries()[name](spark, tables_dir).collect()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
@pytest.mark.parametrize("name", sorted(sql.all_sql()))
def test_query_equals_sql(spark, name, scale):
    tables_dir = f"/root/testdata/sf{scale}"
    assert spark_rows(queries.all_queries()[name](spark, tables_dir)) == duck_rows(duck(tables_dir), sql.all_sql()[name])


def plain_measures(text):
    words = WORD.findall((text or "").encode())
    n = len(words)
    windows = [tuple(words[i : i + 8]) for i in range(n - 7)]
    counts, marked = Counter(windows), [False] * n
    for i, window in enumerate(windows):
        if counts[window] > 1:
            marked[i : i + 8] = [True] * 8
    lines = [line for line in (text or "").split("\n") if WORD.search(line.encode())]
    return (
        n, sum(len(w.decode()) for w in words), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
        sum(marked), n < 20 or 100 * sum(marked) > 30 * n,
    )


def test_quality_measures(spark, documents):
    found = rows_of(spark, "op3_quality_rules")
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    assert {r.doc_id: tuple(r[n] for n in names) for r in found} == {d.doc_id: plain_measures(d.text) for d in documents}
    assert all(r.kept == (not r.base_failed and r.lower <= r.perplexity <= r.upper) for r in found if r.lower is not None)
    assert any(not r.kept and not r.base_failed for r in rows_of(spark, "op3_quality_rules", "/root/testdata/sf0.01"))


def test_packing(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = rows_of(spark, "op4_best_fit_packing")
    want = []
    for d in documents:
        ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [0]
        start, size, piece = 0, len(ids) % 2048 or 2048, 0
        while start < len(ids):
            want.append((d.doc_id, piece, start, size, zlib.crc32(array("I", ids[start : start + size]).tobytes())))
            start, size, piece = start + size, 2048, piece + 1
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(want)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(r.length for r in found) // 2048) + 1


def test_main_text_is_the_marked_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in rows_of(spark, "op5_html_extraction"):
        blocks = html.blocks_of(pages[r.page_id].html)
        kept = html.marked_labels(blocks)
        assert r.text == "\n".join(b.text for b, k in zip(blocks, kept) if k) and r.url == pages[r.page_id].url
        assert r.n_chars == len(r.text)


def test_repeated_windows(spark, documents):
    least, words = {}, {d.doc_id: WORD.findall((d.text or "").encode()) for d in documents}
    for doc_id, own in words.items():
        for k in range(len(own) - 49):
            window = b" ".join(own[k : k + 50])
            least[window] = min(least.get(window, doc_id), doc_id)
    want = {}
    for doc_id, own in words.items():
        keep = [True] * len(own)
        for k in range(len(own) - 49):
            if least[b" ".join(own[k : k + 50])] < doc_id:
                keep[k : k + 50] = [False] * 50
        kept = b" ".join(w for w, k in zip(own, keep) if k)
        want[doc_id] = (len(own), keep.count(False), hashlib.sha256(kept).hexdigest())
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows_of(spark, "op6_substring_dedup")}
    assert found == want and any(removed for _, removed, _ in want.values())


def test_secret_base_spans(spark, documents):
    assign = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
    for r in rows_of(spark, "op7_secret_scans"):
        text = next(d.text for d in documents if d.doc_id == r.doc_id)
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        shown = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for _, k, _ in spans) for kind in range(3)]
        assert set(filter(None, shown.split(","))) <= set(r.spans.split(","))


def test_near_duplicates_of_the_table(spark, documents):
    sets = []
    for d in documents:
        words = WORD.findall((d.text or "").encode().lower() if (d.text or "").isascii() else _lower(d.text))
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    top = list(range(len(sets)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 100 * min(len(sets[a]), len(sets[b])) >= 85 * max(len(sets[a]), len(sets[b]), 1):
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    top[max(x, y)] = min(x, y)
    want = {d.doc_id: (len(sets[i]), documents[root(i)].doc_id) for i, d in enumerate(documents)}
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows_of(spark, "op8_minhash_near_duplicates")}
    assert found == want


def _lower(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())


def test_encoding_equals_the_library(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows_of(spark, "op9_bpe_round_trip")}
    for d in documents:
        ids = tokenizer.encode(d.text, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert found[d.doc_id] == (
            len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        )


def test_toxicity_on_held_out_rows(spark):
    tables_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{tables_dir}/labels.parquet").collect()}
    found = rows_of(spark, "op10_toxicity", tables_dir)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    held = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    caught = sum(p and t for p, t in held)
    assert caught >= 0.85 * sum(t for _, t in held)
    assert sum(p and not t for p, t in held) <= 0.03 * sum(not t for _, t in held)


