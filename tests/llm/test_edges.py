"""Nulls, empty tables, repeated rows, ties and clashing columns, operator by operator."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from advisory_lake.llm import bpe, html, minhash, packing, quality, secrets, substring, topk, toxicity, warc

DOCS = "doc_id LONG, text STRING, lang STRING, starts STRING, kept STRING, n_words STRING, score STRING, rank STRING"
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def odd(spark):
    """Rows that an operator must take as they come."""
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [
        (None, "a b c"), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "x"), (5, long), (5, long), (6, long),
        (6, "other text of the same id"), (7, "é" * 5000), (8, "\u0000\u001c\u0085 odd ﻿"), (9, long.upper()),
    ]
    extra = ("en", "s", "k", "n", "sc", "r")
    return spark.createDataFrame([(i, t, *extra) for i, t in rows], DOCS)


OVER_DOCUMENTS = {
    "quality": quality.judged,
    "packing": lambda docs: packing.packed(docs, BYTES),
    "substring": substring.removed_words,
    "secrets": secrets.scan,
    "minhash": minhash.near_duplicates,
    "bpe": lambda docs: bpe.round_trips(docs, WORDS),
}


@pytest.mark.parametrize("name", sorted(OVER_DOCUMENTS))
def test_every_row_has_a_result(odd, name):
    found = [r.doc_id for r in OVER_DOCUMENTS[name](odd).collect()]
    want = [r.doc_id for r in odd.collect()]
    if name == "packing":
        assert set(found) == set(want)
    else:
        assert sorted(found, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", sorted(OVER_DOCUMENTS))
def test_empty_table(odd, name):
    assert OVER_DOCUMENTS[name](odd.limit(0)).collect() == []


def test_clashing_columns_stay(odd):
    for changed in (substring.without_repeats(odd), secrets.redact(odd)):
        assert changed.columns == odd.columns
        assert changed.count() == odd.count()
    texts = {(r.doc_id, r.text) for r in substring.without_repeats(odd).collect()}
    assert (6, "") in texts and (6, "other text of the same id") in texts and (1, None) in texts


def test_near_duplicates_of_odd_rows(odd):
    found = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()]
    assert (None, 1, None, True) in found and (None, 0, None, True) in found
    assert found.count((5, 2996, 5, True)) == 2 and (6, 2996, 5, False) in found and (9, 2996, 5, False) in found
    assert (1, 0, 1, True) in found and (3, 0, 3, True) in found


def test_near_duplicates_keep_chains_and_lose_no_link(spark):
    """Copies that drift apart: neighbours are linked, ends are not, in many shared buckets."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(120)]
    rows, words = [], passage + [f"a{i}" for i in range(80)]
    for i in range(60):
        rows.append((1000 + i, " ".join(words)))
        words = [*words]
        words[120 + rng.randrange(80)] = f"n{i}"
    rows += [(2000 + i, " ".join(passage + [f"u{i}_{k}" for k in range(40)])) for i in range(60)]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: root(i) for i in sets}


def test_superminhash_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    common = rng.integers(0, 2**63, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([common, rng.integers(0, 2**63, 100, dtype=np.uint64)])) for _ in range(2)]
    signed = minhash.signatures([*sets, sets[0][:1], sets[0][:7]], 480)
    assert abs((signed[0] == signed[1]).mean() - 300 / 500) < 0.08
    assert (signed != minhash._EMPTY).all()
    # each place of a single shingle's signature has a rank of its own
    assert sorted((signed[2] >> np.uint64(32)).tolist()) == list(range(480))
    alone = minhash.signatures([sets[1]], 480)
    assert (alone[0] == signed[1]).all()


def test_windows_that_overlap_and_repeat(spark):
    base = [f"b{i}" for i in range(130)]
    rows = [
        (1, " ".join(base)), (2, "x " + " ".join(base[:49]) + " y"), (3, "\n".join(base[20:75]) + " tail"),
        (4, " ".join(["z"] * 200)), (5, " ".join(["z"] * 60)), (None, " ".join(base)), (1, " ".join(base)),
    ]
    found = substring.removed_words(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    removed = sorted((r.doc_id or 0, r.n_removed) for r in found)
    assert removed == [(0, 0), (1, 0), (1, 0), (2, 0), (3, 55), (4, 0), (5, 60)]
    kept = next(r.kept_sha256 for r in found if r.doc_id == 3)
    assert kept == hashlib.sha256(b"tail").hexdigest()


def test_top_k_ties_nulls_and_repeats(spark):
    one, nan = [1.0, 0.0], float("nan")
    rows = [(50, one), (3, one), (1, one), (2, one), (9, [0.5, 0.5]), (7, None), (8, [1.0, None]), (10, [nan, 1.0]), (None, one), (11, [1.0]), (100, [1.0]), (3, one)]
    vectors = topk.whole_vectors(spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>"))
    found = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 4).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == [
        (50, 1, 1, 65536), (50, 2, 2, 65536), (50, 3, 3, 65536), (50, 4, 3, 65536), (100, 1, 11, 65536)
    ]
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).collect() == []


def test_ball_tree_search_equals_all_products():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    rows = np.floor(rng.normal(0, 40, (700, 6)))
    rows[:200] = rows[0]
    shard = pd.DataFrame({"vec_id": np.arange(700), "vector": list(rows)})
    best = topk.search(rows[::50], np.arange(0, 700, 50), np.full(14, -np.inf), shard, 5)
    for q, own in zip(range(0, 700, 50), best):
        scores = (rows @ rows[q]).astype(int)
        want = sorted(((-s, i) for i, s in enumerate(scores.tolist()) if i != q))[:5]
        assert own == [(-s, i) for s, i in want]
    big = np.array([[2.0**40, 3.0], [2.0**22, 1.0]])
    assert topk.inner_products(big[:1], big[1:])[0, 0] == 2**62 + 3


def test_archives(spark, folder):
    same = "x" * 150
    rows = [(5, "u\r\nv é", same), (3, None, same), (3, "w", same), (None, "w", same), (7, "a", None), (8, "b", ""), (10, "c", "short"), (11, "c", "short"), (None, "q", "y" * 200)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id LONG, url STRING, html STRING, digest STRING")
    found = sorted(((r.page_id or -1, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archived_pages(pages).collect()))
    assert found == sorted([
        (5, 150, "revisit", 3), (3, 150, "response", None), (3, 150, "response", None), (-1, 150, "revisit", 3),
        (7, 0, "response", None), (8, 0, "response", None), (10, 5, "response", None), (11, 5, "response", None), (-1, 200, "response", None),
    ])
    assert warc.archived_pages(pages.limit(0)).collect() == []
    warc.write_archive(pages, f"{folder}/a")
    asked = warc.read_archive(spark, f"{folder}/a", "record_type", "target_uri", "http_length").where("record_type = 'revisit' and target_uri like 'u%'")
    assert [tuple(r) for r in asked.collect()] == [("revisit", "u\r\nv é", 150)]
    assert "PushedFilters: [IsNotNull(record_type), IsNotNull(target_uri), EqualTo(record_type,revisit), StringStartsWith(target_uri,u)]" in (
        asked._jdf.queryExecution().toString() + _formatted(asked)
    )


def _formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_foreign_archives(spark, folder):
    """Members without their length, and no compression at all."""
    import gzip
    from pathlib import Path

    records = [warc.record_bytes(warc.Record(i, f"http://h/{i}", "d", b"p" * (i * 70_000), None)) for i in range(4)]
    Path(f"{folder}/one.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    Path(f"{folder}/two.warc").write_bytes(b"".join(records))
    found = warc.read_archive(spark, folder, "record_id", "payload").collect()
    assert sorted((r.record_id, len(r.payload)) for r in found) == sorted(2 * [(f"<urn:page:{i}>", i * 70_000) for i in range(4)])
    some = warc.read_archive(spark, folder, "record_id", "http_length").where("record_id = '<urn:page:3>'").collect()
    assert [r.http_length for r in some] == [210_000, 210_000]


def test_pages_without_text(spark):
    rows = [(1, "u", None), (1, "u", None), (2, None, ""), (None, "v", "<p>"), (4, "w", "<article><p>One &amp; two\n three</p><p>Four five six seven.</p></article><footer>&copy; x</footer>")]
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in html.main_text(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")).collect()}
    assert found[1, "u"] == found[2, None] == found[None, "v"] == ("", 0)
    assert found[4, "w"] == ("One & two three\nFour five six seven.", 36)
    assert html.main_text(spark.createDataFrame([], "page_id LONG, url STRING, html STRING")).collect() == []


def test_labeller_gradients():
    import numpy as np

    rng = np.random.default_rng(1)
    labeller = html.Labeller.new(3)
    labeller.weights = {k: v.astype(float) for k, v in labeller.weights.items()}
    rows, there = html.padded([rng.normal(size=(n, html.PATH_WIDTH + html.WORD_WIDTH + html.MEASURES)) for n in (3, 5, 2)])
    labels = (rng.random(there.shape) < 0.5).astype(float)

    def loss():
        p = labeller.probabilities(rows, there)
        return -np.where(there, labels * np.log(p) + (1 - labels) * np.log(1 - p), 0).sum() / there.sum()

    for name, grad in labeller.gradients(rows, there, labels).items():
        weight = labeller.weights[name]
        for _ in range(20):
            at = tuple(rng.integers(0, s) for s in weight.shape)
            old, ends = weight[at], []
            for step in (1e-4, -1e-4):
                weight[at] = old + step
                ends.append(loss())
            weight[at] = old
            assert abs((ends[0] - ends[1]) / 2e-4 - grad[at]) < 1e-4


def test_layouts_never_seen(spark):
    """Pages of other layouts than the tables have."""
    maker, wrong, total = html._Maker("one two three four five six".split(), 99), 0, 0
    pages = [maker.page() for _ in range(60)]
    labeller = html.train(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    kept = html.labelled(labeller, [html.blocks_of(page) for page, _ in pages])
    for (_, known), own in zip(pages, kept):
        wrong += sum(bool(a) != bool(b) for a, b in zip(known, own))
        total += len(known)
    assert wrong <= 0.03 * total


def test_top_k_over_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 30)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    rng = random.Random(11)
    rows = [(i, [float(rng.randint(-9, 9)) for _ in range(6)]) for i in range(260)]
    rows += [(400 + i, rows[i][1]) for i in range(20)]  # ties
    vectors = spark.createDataFrame(rows, "vec_id LONG, vector ARRAY<DOUBLE>")
    found = topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 5).collect()
    want = set()
    for query, asked in rows:
        if query % 20 == 0:
            scores = sorted((-int(sum(a * b for a, b in zip(asked, v))), i) for i, v in rows if i != query)
            want |= {(query, rank, i, -score) for rank, (score, i) in enumerate(scores[:5], 1)}
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_secrets_by_structure():
    import base64
    import json

    def der(tag, *parts):
        body = b"".join(parts)
        size = bytes([len(body)]) if len(body) < 128 else bytes([0x80 | len(n := len(body).to_bytes(2).lstrip(b"\0"))]) + n
        return bytes([tag]) + size + body

    rsa = der(0x30, der(2, b"\0"), *[der(2, b"\x01" * n) for n in (128, 3, 128, 64, 64, 64, 64, 64)])
    pkcs8 = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86"), der(5)), der(4, rsa))
    dsa = der(0x30, der(2, b"\0"), *[der(2, b"\x01" * n) for n in (128, 20, 128, 128, 20)])

    def field(data):
        return len(data).to_bytes(4) + data

    public = field(b"ssh-ed25519") + field(b"p" * 32)
    openssh = b"openssh-key-v1\0" + field(b"none") * 2 + field(b"") + (1).to_bytes(4) + field(public) + field(b"abcdabcd" + b"k" * 64)
    false = b"openssh-key-v1\0" + field(b"none") + b"not a key at all" * 4
    assert secrets.confirmed_spans(base64.b64encode(false).decode()) == []
    assert secrets.confirmed_spans(base64.b64encode(openssh[:-1]).decode()) == []
    assert secrets.confirmed_spans(base64.b64encode(openssh.replace(b"abcdabcd", b"abcdabce")).decode()) == []
    for key in (rsa, pkcs8, dsa, openssh):
        text = base64.b64encode(key).decode()
        for before in ("KEY=", "https://host/?k=", "key: '"):
            assert secrets.confirmed_spans(f"{before}{text} end") == [(len(before), 3, len(before) + len(text))]
        for ends in ("\n", "\r\n", "\\n", "\n   "):
            wrapped = ends.join(text[i : i + 64] for i in range(0, len(text), 64))
            assert secrets.confirmed_spans(f"see {wrapped}{ends}end of it") == [(4, 3, 4 + len(wrapped))]
            assert secrets.confirmed_spans(f"see {wrapped[:-8]}{ends}end of it") == []
    lines = "\n".join(base64.b64encode(b"\x07" * 160).decode()[i : i + 64] for i in range(0, 216, 64))
    for headers, known in (("Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC," + "0F" * 16, True), ("Proc-Type: 4,ENCRYPTED", False), ("", False)):
        pem = f"-----BEGIN RSA PRIVATE KEY-----\n{headers}\n\n{lines}\n-----END RSA PRIVATE KEY-----"
        assert secrets.confirmed_spans(pem) == ([(0, 3, len(pem))] if known else [])
    for key in (rsa, pkcs8, dsa, openssh):
        text = base64.b64encode(key).decode()
        assert secrets.confirmed_spans(f"say {text} end") == [(4, 3, 4 + len(text))]
        pem = f"-----BEGIN PRIVATE KEY-----\n{text}\n-----END PRIVATE KEY-----"
        assert secrets.confirmed_spans(pem) == [(0, 3, len(pem))]
    assert secrets.confirmed_spans(rsa.hex()) == [(0, 3, 2 * len(rsa))]
    assert secrets.confirmed_spans(base64.b64encode(rsa[:-1]).decode()) == []
    assert secrets.confirmed_spans(base64.b64encode(b"just a long text in base64, and no key at all").decode()) == []
    part = [base64.urlsafe_b64encode(json.dumps(d).encode()).decode().rstrip("=") for d in ({"alg": "HS256"}, {"sub": "1"}, {"no": 1})]
    signature = base64.urlsafe_b64encode(b"s" * 32).decode().rstrip("=")
    token = f"{part[0]}.{part[1]}.{signature}"
    assert [s for s in secrets.confirmed_spans(f"t {token}") if s[1] == 4] == [(2, 4, 2 + len(token))]
    assert [s for s in secrets.confirmed_spans(f"{part[2]}.{part[1]}.{signature}") if s[1] == 4] == []
    assert secrets._masked("a token = 0123456789abcdef b", "#") == "a # b"


@pytest.mark.parametrize("block, long_word", [(bpe.BLOCK, bpe.LONG_WORD), (40, 7)])
def test_encoding_of_odd_texts(monkeypatch, block, long_word):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "BLOCK", block)
    monkeypatch.setattr(bpe, "LONG_WORD", long_word)
    bpe.word_tokenizer(WORDS).pieces.clear()
    rng = random.Random(5)
    letters = "aabbcdeeeinorstth éßñ你😀́ ​ \x1c\x85.'S,İΣς0123 \n\t<|>"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 80))) for _ in range(600)]
    texts += ["".join(rng.choices("abcehinorst", k=rng.randint(100, 4000))) for _ in range(10)]
    texts += ["a" * 3000, "an" * 2000, "<|endoftext|>Hello<|startoftext|> x", "", " ", "it's I'LL", "é" * 2000, "=-" * 900]
    words, byte = Tokenizer.from_file(WORDS), Tokenizer.from_file(BYTES)
    for text in texts:
        steps = [*bpe.word_tokenizer(WORDS).stream(text)]
        ids, shown = zip(*steps) if steps else ((), ())
        want = words.encode(text, add_special_tokens=False).ids
        assert b"".join(ids) == b"".join(i.to_bytes(4, "little") for i in want)
        assert b" ".join(shown).decode() == words.decode(want, skip_special_tokens=False)
        want = byte.encode(text, add_special_tokens=False).ids
        assert packing.byte_tokenizer(BYTES).encode(text) == b"".join(i.to_bytes(4, "little") for i in want)


def test_sections_of_long_words(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "LONG_WORD", 5)
    rng, words = random.Random(6), Tokenizer.from_file(WORDS)
    letters = "aéstrelldmv\'\'\'\'109.!?-\u0301\u0327\u00a0ß你"
    for _ in range(1500):
        text = "".join(rng.choices(letters, k=rng.randint(6, 60)))
        bpe.word_tokenizer(WORDS).pieces.clear()
        want = words.encode(text, add_special_tokens=False).ids
        assert b"".join(i for i, _ in bpe.word_tokenizer(WORDS).stream(text)) == b"".join(i.to_bytes(4, "little") for i in want)


def text_of_kind(kind, n):
    rng = random.Random(n)
    if kind == "one run of letters":
        return "".join(rng.choices("aeinorst", k=n))
    if kind == "one word of many parts":
        return "".join(rng.choices("aeinorst0.", k=n))
    if kind == "added tokens":
        return "<|endoftext|>" * (n // 13)
    return {"words": " ", "odd blanks": "\u00a0"}[kind].join("".join(rng.choices("aeinorst", k=5)) for _ in range(n // 6))


@pytest.mark.parametrize("kind", ["words", "one run of letters", "one word of many parts", "odd blanks", "added tokens"])
def test_memory_does_not_follow_the_text(kind):
    import tracemalloc

    tokenizer, peaks = bpe.word_tokenizer(WORDS), []
    for n in (100_000, 400_000):
        given, seen, decoder = text_of_kind(kind, n), 0, bpe.Decoder(b" ")
        tokenizer.pieces.clear()  # what is remembered has a bound of its own
        tokenizer.parts.clear()
        tracemalloc.start()
        for ids, shown in tokenizer.stream(given):
            seen += len(ids) // 4
            decoder.push(shown)
            tokenizer.pieces.clear()
            tokenizer.parts.clear()
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert seen > n // 20
    copies = {"one run of letters": 3}.get(kind, 1)  # of the text; a list of its symbols would be eight more
    assert peaks[1] - peaks[0] < copies * 300_000 + 300_000, peaks


def test_transducer_holds_a_bounded_number_of_symbols():
    merges = bpe.word_tokenizer(WORDS).merges
    rng = random.Random(2)
    for length in (50, 700, 3000):
        symbols = list(bpe.word_tokenizer(WORDS)._symbols("".join(rng.choices("abcdeinorst", k=length))))
        transducer, tokens = bpe.Transducer(merges, chunk=3), []
        for symbol in symbols:
            tokens += transducer.push([symbol])
            assert len(transducer.held) <= merges.lookahead + max(merges.width.values())
        assert [*tokens, *transducer.finish()] == merges.merged(list(symbols))


def test_decoder_waits_for_whole_characters():
    decoder = bpe.Decoder()
    text = "é你😀"
    assert "".join(decoder.push(bytes([b])) for b in text.encode()) + decoder.finish() == text
    broken = bpe.Decoder()
    assert broken.push(b"a\xe4\xbd") + broken.finish() == "a�"


def test_minimum_bin_slack():
    rng = random.Random(8)
    counts = {rng.randint(1, 100): rng.randint(1, 50) for _ in range(60)}
    made = packing.combinations(counts, 100)
    used = {}
    for chosen, often in made:
        assert sum(chosen) <= 100
        for length in chosen:
            used[length] = used.get(length, 0) + often
    assert used == counts and len(made) <= len(counts)
    # no packing has fewer sequences than this bound (Martello and Toth)
    def least(small):
        full = sum(v for k, v in counts.items() if k > 100 - small)
        halves = {k: v for k, v in counts.items() if 50 < k <= 100 - small}
        rest = sum(k * v for k, v in counts.items() if small <= k <= 50)
        room = sum((100 - k) * v for k, v in halves.items())
        return full + sum(halves.values()) + max(0, -(-(rest - room) // 100))

    assert sum(often for _, often in made) <= 1.02 * max(least(small) for small in range(51)) + 1
    assert packing.combinations({}, 100) == []
    assert sorted(packing.fullest([60, 50, 40, 7], {60: 1, 50: 2, 40: 1, 7: 9}, 100)) == [40, 60]


def test_perplexity_is_that_of_plain_kneser_ney(spark):
    import math
    from collections import Counter

    texts = ["abra cadabra " * 3, "a bad cab", "brave new abracadabra", "dada", "zz", "b" * 40]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id LONG, text STRING, lang STRING")
    order = quality.ORDER
    runs = [[10] * (order - 1) + [*map(ord, t)] for t in texts]
    counts = {order: Counter(tuple(s[i : i + order]) for s in runs for i in range(len(s) - order + 1))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    below = {}
    for k in range(1, order + 1):
        n = Counter(counts[k].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
        cut = {j: min(max(j - (j + 1) * y * n[j + 1] / n[j], 0), j) if n[j] else 0.5 for j in (1, 2, 3)}
        total, taken = Counter(), Counter()
        for g, c in counts[k].items():
            total[g[:-1]] += c
            taken[g[:-1]] += cut[min(c, 3)]
        below = {
            g: (c - cut[min(c, 3)] + taken[g[:-1]] * (1 / (len(counts[1]) + 1) if k == 1 else below[g[1:]])) / total[g[:-1]]
            for g, c in counts[k].items()
        }
    want = {i: math.exp(-sum(math.log(below[tuple(s[j : j + order])]) for j in range(len(t))) / len(t)) for i, (s, t) in enumerate(zip(runs, texts))}
    for r in quality.judged(docs).collect():
        assert r.perplexity == pytest.approx(want[r.doc_id], rel=1e-4)


def test_shards_and_groups_change_no_perplexity(spark, tmp_path, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(5).write.parquet(str(tmp_path / "docs"))
    want = {r.doc_id: r for r in quality.judged(docs).collect()}
    for name, value in (("SHARD_ROWS", 3000), ("GROUP_DOCS", 70), ("HELD_RUNS", 20_000)):
        monkeypatch.setattr(quality, name, value)
    for r in quality.judged(spark.read.parquet(str(tmp_path / "docs"))).collect():
        assert r.perplexity == pytest.approx(want[r.doc_id].perplexity, rel=1e-6) and r.kept == want[r.doc_id].kept


def test_runs_of_many_letters_are_told_apart():
    from collections import Counter

    rng = random.Random(3)
    texts = ["".join(chr(rng.randint(33, 55000)) for _ in range(20_000)), "ab\u0000\u0000" * 50, "", "x"]
    runs, n, letters, sizes = quality.runs_of(texts)
    lead = "\n" * (quality.ORDER - 1)
    plain = [(lead + t)[i : i + quality.ORDER] for t in texts for i in range(len(t))]
    grams = quality._strings(runs)
    assert sizes.tolist() == [20_000, 200, 0, 1] and [grams[i] for i in letters] == plain
    assert dict(zip(grams, n.tolist())) == Counter(plain)


def test_toxic_words_with_gaps(spark):
    tables_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{tables_dir}/{n}.parquet") for n in ("documents", "labels"))
    judge = toxicity.Judge(toxicity.train(docs, labels))
    clean = "The and of that with from this was are for on by in it as at be is to a. " * 3
    scores = judge.scores([clean, clean + "you idiot and moron", clean + "id-iot mooron", clean + "i d i o t m.o.r.o.n", "", None])
    assert scores[0] < 0.5 and scores[4] < 0.5 and scores[5] < 0.5
    assert (scores[1:4] > 0.5).all()


def test_toxicity_without_labels(odd, spark):
    found = toxicity.scored(odd, spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [False, False]
    labels = spark.createDataFrame([(5, 1, 1), (6, 1, 0), (4, 1, None), (4, 1, 0)], "doc_id LONG, quality INT, toxic INT")
    assert toxicity.scored(odd.limit(0), labels).collect() == []


def test_kernel_tolerates_gaps():
    near = toxicity.kernel(["idiot", "idioot", "id-iot", "garden"], ["idiot"])[:, 0]
    assert near[0] == pytest.approx(1) and near[1] > 0.7 and near[2] > 0.5 and near[3] < 0.05


def test_kernel_values_follow_from_the_subsequences():
    def plain(text):
        found, marked = Counter(), f"\x02{text}\x03"
        for a in range(len(marked)):
            for j in range(2, toxicity.SPAN):
                for b in range(a + 1, min(a + j, len(marked))):
                    if a + j < len(marked):
                        found[marked[a], marked[b], marked[a + j]] += toxicity.DISCOUNT ** (j - 2)
        return found

    texts = ["", "a", "eel", "thattionble", "eel", "aaaaaaaaaa", "\U0010ffff\ud800\U0010ffff東東", "x" * 300]
    found = [plain(text) for text in texts]
    norm = [sum(v * v for v in some.values()) ** 0.5 or 1 for some in found]
    values = [[sum(v * b[k] for k, v in a.items()) / n / m for b, m in zip(found, norm)] for a, n in zip(found, norm)]
    assert np.allclose(toxicity.kernel(texts, texts), values, atol=1e-12)


def test_a_form_of_a_word_is_judged_once(monkeypatch):
    model = toxicity.fit({"idiot": 1.0, "moron": 1.0}, {"garden": 1.0, "house": 1.0})
    model.curve = np.array([1.0, 1.0, 1.0, 0.0])
    asked, plain = [], toxicity.Model.decisions
    monkeypatch.setattr(toxicity.Model, "decisions", lambda self, words: asked.extend(words) or plain(self, words))
    texts = ["The garden, the house. garden", "don't id-iot (idiot) a_b " + "x" * 50, "m o r o n garden! the", "", None]
    judge = toxicity.Judge(model)
    rows = judge.features(texts)
    assert len(asked) == len(set(asked)) and "garden" in asked
    assert not any(len(word) > toxicity.LONGEST_CACHED for word in judge.known)
    for text, row in zip(texts[:3], rows):
        words = set(toxicity.words_in(text))
        every = [[toxicity.stripped(w), toxicity._MARKS.sub("", w)] for w in words]
        assert row[0] == pytest.approx(np.clip(max(plain(model, some).max() for some in every), -1, 1))
    asked.clear()
    again = judge.features(texts)
    assert np.allclose(again, rows) and asked == ["x" * 50]
    judge.features(["garden? GARDEN..."])
    assert asked == ["x" * 50]


def test_spelled_out_words():
    for text in ["i d i o t", "so i d  i o t", "a b c", "a b c d", "x\u2003y\x1cz\u00a0w e", "ab i d i o t cd e f", "😀 a 東 b"]:
        lowered = text.lower()
        spelled = ["".join(some.split()) for some in toxicity._SPELLED.findall(lowered)]
        assert toxicity.words_in(text) == lowered.split() + spelled


def test_pipeline_stages(spark):
    tables_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{tables_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.written(stage(spark, docs, tables_dir), "test")
        if name != "packing":
            assert after.columns == columns
            assert after.where("n_chars <> length(text)").count() == 0
            assert after.count() <= docs.count()
        if name == "near duplicates":
            kept = {r.doc_id for r in minhash.near_duplicates(docs, corpus_pipeline.NEAR_PERCENT).where("kept").collect()}
            assert {r.doc_id for r in after.collect()} == kept
        if name == "repeated passages":
            want = {r.doc_id: r.kept_sha256 for r in substring.removed_words(docs).collect()}
            assert {r.doc_id: hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest() for r in after.collect()} == want
        if name == "secrets":
            assert all(not secrets.confirmed_spans(r.text) for r in after.collect())
        docs = after
    assert sorted(map(tuple, corpus_pipeline.run(spark, tables_dir).select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(
        map(tuple, docs.select("doc_id", "piece", "length", "ids_crc32").collect())
    )


def test_pipeline_drops_near_copies_from_four_fifths(spark):
    """Pairs just below, at and above 0.80, and between 0.80 and 0.85, against all pairs."""
    rows, sets = [], {}
    for pair, (n_words, changed) in enumerate([(94, 10), (104, 8), (104, 9), (104, 10), (104, 11), (104, 12), (104, 13), (404, 43), (404, 45)]):
        words = [f"w{pair}_{k}" for k in range(n_words)]
        for copy, own in enumerate((words, words[:-changed] + [f"x{pair}_{k}" for k in range(changed)])):
            text = " ".join(own)
            rows.append((10 * pair + copy, text, "en", "s", len(text)))
            sets[10 * pair + copy] = {tuple(own[k : k + 5]) for k in range(n_words - 4)}
    similar = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    assert sum(0.8 <= s < 0.85 for s in similar.values()) == 5
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == set(sets) - {b for (_, b), s in similar.items() if s >= 0.8}


ARTICLE = "<article><p>One two.</p><p>Three four.</p></article>"


@pytest.mark.parametrize(
    "before, after",
    [
        ("<html><head><title>t</title><body>", "</body></html>"),
        ("<html><head><meta charset=utf-8><title>t</title><script>a='<p>b</p>'</script>", ""),
        ("<head><style>p {}</style></head><body>", "</body>"),
        *[(f"<{tag} class='x'>", "") for tag in "noscript template select svg iframe object canvas math".split()],
        ("<svg><path></p>", "<svg><text>no text</text></svg>"),
        ("<svg><title>t</svg>", "<object>no <object>text</object> here</object>"),
        ("<svg><svg><text>no</text></svg><text>text</text></svg>", "<script>to the end " + ARTICLE),
        ("<canvas/><svg-icon></svg-icon>", "<textarea>to the end " + ARTICLE),
    ],
)
def test_pages_that_leave_elements_open(before, after):
    assert [b.text for b in html.blocks_of(before + ARTICLE + after)] == ["One two.", "Three four."]


def test_formulas_are_text(spark):
    page = "<head><title>t</title><article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>"
    [row] = html.main_text(spark.createDataFrame([(1, "u", page)], "page_id LONG, url STRING, html STRING")).collect()
    assert row.text == "So x=2 holds."


def test_private_keys_inside_json(spark):
    import base64
    import json

    key = b"openssh-key-v1\0" + (4).to_bytes(4) + b"none" + bytes(range(256)) * 3
    body = base64.encodebytes(key).decode().strip()
    pem = f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----\n"
    once = json.dumps({"private_key": pem, "client": "c"})
    for text in (once, json.dumps(once), json.dumps({"private_key": pem.replace("\n", "\r\n")})):
        start, end = text.index("-----BEGIN"), text.index("KEY-----", text.index("-----END")) + len("KEY-----")
        docs = spark.createDataFrame([(1, text)], "doc_id LONG, text STRING")
        [found], [after] = secrets.scan(docs).collect(), secrets.redact(docs).collect()
        assert found.n_private_key == 1 and f"private_key:{start}:{end}" in found.spans.split(",")
        assert after.text == text[:start] + "[REDACTED]" + text[end:]
    assert secrets.confirmed_spans(once.replace(body[:40], "not a key" * 5)) == []


def _thue_morse(n):
    """Sequences that polynomials modulo a power of two cannot tell from their complement."""
    return [i.bit_count() % 2 for i in range(n)]


def test_sequences_that_defeat_polynomials_are_told_apart(spark):
    some = _thue_morse(4096)
    texts = {
        1: " ".join("a" if bit else "b" for bit in some) + " end",
        2: " ".join("b" if bit else "a" for bit in some) + " end",
        3: "".join("a" if bit else "b" for bit in some[:2048]) + " one two three four five",
        4: "".join("b" if bit else "a" for bit in some[:2048]) + " one two three four five",
        5: "".join("ab"[bit] for bit in some[:2048]),
        6: "".join("ba"[bit] for bit in some[:2048]),
    }
    # windows of 50 are common to texts 1 and 2, so a plain one tells what each keeps
    seen = {tuple(texts[1].split()[k : k + 50]) for k in range(4048)}
    own, keep = texts[2].split(), [True] * 4097
    for k in range(4048):
        if tuple(own[k : k + 50]) in seen:
            keep[k : k + 50] = [False] * 50
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    removed = {r.doc_id: r.n_removed for r in substring.removed_words(docs).collect()}
    assert removed == {1: 0, 2: keep.count(False), 3: 0, 4: 0, 5: 0, 6: 0}
    cut = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    assert cut[2].split() == [w for w, k in zip(own, keep) if k] and cut[1] == texts[1]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).where("doc_id > 2").collect()}
    assert found == {3: (2, 3), 4: (2, 4), 5: (1, 5), 6: (1, 6)}


def test_sequence_numbers_are_those_of_equal_words():
    import pyarrow as pa

    from advisory_lake.llm.words import LONG_BYTES, words_of

    rng = random.Random(8)
    pool = ["a", "ab", "x" * 8, "x" * 9, "y" * LONG_BYTES, "y" * (LONG_BYTES + 1), "é", "ab\u0000", "\u0000"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(70))) for _ in range(40)]
    words = words_of(pa.array([*texts, None, ""]))
    flat = [w for t in texts for w in t.split(" ") if w]
    for length in (1, 2, 3, 5, 8, 16, 50):
        for which in (0, 1):
            known = {}
            numbers = words.sequences(length, which)
            assert len(numbers) == len(flat) - length + 1
            for k, number in enumerate(numbers.tolist()):
                assert known.setdefault(tuple(flat[k : k + length]), number) == number
            assert len(set(known.values())) == len(known)
