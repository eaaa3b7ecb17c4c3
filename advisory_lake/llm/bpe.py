"""Byte-pair encoding as a streaming transducer with bounded lookahead, and its decoder.

The merge list fixes how far text to the right can change tokens to the left: an effect moves
one token to the left only through a merge of a later rank that wants the token which an
earlier one has freed, taken or built. ``sufficient_lookahead`` is the longest such chain. A
transducer holds that many symbols and a chunk; tokens that end before them are stable and
leave, so memory does not grow with the length of a word.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame

from advisory_lake.llm.secrets import ddl
from advisory_lake.llm.shared import id_and_text, per_row

CHUNK = 512  # symbols read between two emissions of a long word
CACHED_PIECES = 500_000  # distinct pieces a worker remembers, then it starts anew
BLOCK = 1 << 16  # characters of a text that are split into words at once
TOKENS_AT_ONCE = 4096  # words, or tokens of a long word, that leave in one step
LONG_WORD = 4096  # characters from which a word is taken in sections
LONGEST_CACHED = 64  # characters of a piece that is remembered

_PLAIN_BLANK = re.compile(r"[ \t\r\n]")
_CUT = re.compile(
    r"(?<=[a-zA-Z])(?=[!-&(-/:-@\[-`{-~])|(?<=[!-&(-/:-@\[-`{-~])(?=[a-zA-Z])|(?=[0-9])|(?<=[0-9])(?=[!-~])"
)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class Merges:
    """Ranks and results of the merges over token ids."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]]):
        self.vocab = vocab
        self.pairs: dict[int, tuple[int, int]] = {}
        self.none = (1 << 62, -1)
        ordered = []
        for rank, (left, right) in enumerate(merges):
            a, b, made = vocab[left], vocab[right], vocab[left + right]
            self.pairs.setdefault((a << 32) | b, (rank, made))
            ordered.append((a, b, made))
        self.lookahead = sufficient_lookahead(ordered)

    def merged(self, symbols: list[int]) -> list[int]:
        """All merges, lowest rank first and leftmost first."""
        if len(symbols) > 48:
            return self._merged_long(symbols)
        find, none = self.pairs.get, self.none
        ranks = [find((a << 32) | b, none) for a, b in pairwise(symbols)]
        while ranks:
            best = min(ranks)
            if best is none:
                break
            i = ranks.index(best)
            symbols[i : i + 2] = [best[1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = find((best[1] << 32) | symbols[i + 1], none)
            if i:
                ranks[i - 1] = find((symbols[i - 1] << 32) | best[1], none)
        return symbols

    def _merged_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap, for long pieces."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [
            (found[0], i, found[1], symbols[i], symbols[i + 1])
            for i in range(n - 1)
            if (found := self.pairs.get((symbols[i] << 32) | symbols[i + 1])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            _, i, made, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = made, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n:
                    found = self.pairs.get((symbols[left] << 32) | symbols[right])
                    if found is not None:
                        heapq.heappush(heap, (found[0], left, found[1], symbols[left], symbols[right]))
        return [s for s in symbols if s >= 0]


def sufficient_lookahead(merges: list[tuple[int, int, int]]) -> int:
    """Symbols to the right of a token end after which it cannot change.

    For each merge, the furthest place to its left that it can influence: its left part, and
    then a later merge whose right part is that left part (freed or taken) or the token made.
    Ranks rise along a chain, so one pass from the last merge to the first finds the longest.
    """
    width: dict[int, int] = {}
    for a, b, made in merges:
        width[made] = width.get(a, 1) + width.get(b, 1)
    furthest: dict[int, int] = {}
    longest = 0
    for a, b, made in reversed(merges):
        reach = width.get(a, 1) + max(furthest.get(a, 0), furthest.get(made, 0))
        furthest[b] = max(furthest.get(b, 0), reach)
        longest = max(longest, reach)
    return longest + max(width.values(), default=1)


class Transducer:
    """Takes symbols, gives tokens as soon as no later symbol can change them."""

    def __init__(self, merges: Merges, chunk: int = CHUNK):
        self.merges, self.chunk, self.held = merges, chunk, []

    def push(self, symbols: Iterable[int]) -> Iterator[int]:
        limit = self.merges.lookahead + self.chunk
        for symbol in symbols:
            self.held.append(symbol)
            if len(self.held) >= limit:
                yield from self._stable()

    def _stable(self) -> Iterator[int]:
        tokens = self.merges.merged(list(self.held))
        free, at = len(self.held) - self.merges.lookahead, 0
        for token in tokens:
            size = self.merges.width[token]
            if at + size > free:
                break
            yield token
            at += size
        self.held = self.held[at:]

    def finish(self) -> Iterator[int]:
        yield from self.merges.merged(list(self.held))
        self.held = []


class Decoder:
    """Bytes of tokens to text, step by step: what does not end a character waits for the next
    bytes, what is no UTF-8 becomes U+FFFD. Tokens are joined by ``between``."""

    def __init__(self, between: bytes = b""):
        self.state, self.between, self.started = codecs.getincrementaldecoder("utf-8")("replace"), between, False

    def push(self, tokens: bytes) -> str:
        """Text of one token, or of several that are joined already."""
        lead, self.started = self.between if self.started else b"", True
        return self.state.decode(lead + tokens)

    def finish(self) -> str:
        return self.state.decode(b"", True)


class WordTokenizer:
    """A tokenizer file of kind BPE with word ends, read as its library reads it."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.merges = Merges(model["vocab"], map(tuple, model["merges"]))
        self.merges.width = _widths(model, self.suffix)
        added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.added = added
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")
        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.odd_blank = re.compile("[\x1c-\x1f]")  # white space for str.split() alone
        self.blank, self.word = regex.compile(r"\s+"), regex.compile(r"\S+")
        texts = {i: token for token, i in model["vocab"].items()} | {i: token for token, i in added.items()}
        self.texts = [texts[i].encode() if i in texts else None for i in range(max(texts) + 1)]
        letters = byte_letters()
        self.letters = [letters[b] for b in range(256)]
        self.ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
        self.pieces: dict[str, tuple[bytes, bytes]] = {}
        self.parts: dict[str, list[int]] = {}

    def stream(self, text: str) -> Iterator[tuple[bytes, bytes]]:
        """Ids as little-endian 32-bit numbers and the tokens' bytes with a space between them, as a
        tokenizer file without a decoder asks, in steps of some BLOCK characters or TOKENS_AT_ONCE
        tokens. Lists hold what belongs to one step, however long the text or a word is."""
        get = self.pieces.get
        for block in blocks(text):
            ids, shown = [], []
            for span in self._spans(block):
                if len(ids) >= TOKENS_AT_ONCE:
                    yield b"".join(ids), b" ".join(shown)
                    ids, shown = [], []
                if span in self.added:
                    ids.append(self.added[span].to_bytes(4, "little"))
                    shown.append(self.texts[self.added[span]])
                    continue
                for word in self._words(span):
                    known = get(word)
                    if known is None:
                        if len(word) > LONG_WORD:
                            if ids:
                                yield b"".join(ids), b" ".join(shown)
                                ids, shown = [], []
                            yield from self._long(word)
                            continue
                        known = self._piece(word)
                    if known[0]:
                        ids.append(known[0])
                        shown.append(known[1])
                        if len(ids) >= TOKENS_AT_ONCE:
                            yield b"".join(ids), b" ".join(shown)
                            ids, shown = [], []
            if ids:
                yield b"".join(ids), b" ".join(shown)

    def _spans(self, block: str) -> Iterator[str]:
        """Added tokens, and the text between them."""
        if "<" not in block or not any(token in block for token in self.added):
            yield block
            return
        start = 0
        for token in self.added_pattern.finditer(block):
            yield block[start : token.start()]
            yield token[0]
            start = token.end()
        yield block[start:]

    def _words(self, span: str) -> Iterable[str]:
        if len(span) > 2 * BLOCK:  # of a text without plain blanks
            return (word[0] for word in self.word.finditer(span))
        return self.blank.split(span) if self.odd_blank.search(span) else span.split()

    def _long(self, word: str) -> Iterator[tuple[bytes, bytes]]:
        """A word of any length, each of its parts through the transducer."""
        ids, shown = array("I"), []
        for section in sections(word):
            for part in self._parts(section):
                for token in self._tokens(part):
                    ids.append(token)
                    shown.append(self.texts[token])
                    if len(shown) >= TOKENS_AT_ONCE:
                        yield ids.tobytes(), b" ".join(shown)
                        ids, shown = array("I"), []
        if shown:
            yield ids.tobytes(), b" ".join(shown)

    def _parts(self, piece: str) -> Iterator[str]:
        """Parts that are merged each on its own, letters standing for bytes."""
        if piece.isascii() and piece.isprintable():
            return (part[0] for part in self.ascii.finditer(piece.lower()))
        return (part for part, _ in self.split(self.normalize(piece)))

    def _piece(self, piece: str) -> tuple[bytes, bytes]:
        """Ids and token bytes of text without white space."""
        ids = array("I")
        for part in self._parts(piece):
            ids.extend(self._tokens(part))
        known = ids.tobytes(), b" ".join([self.texts[i] for i in ids])
        if len(piece) <= LONGEST_CACHED:
            if len(self.pieces) >= CACHED_PIECES:
                self.pieces.clear()
            self.pieces[piece] = known
        return known

    def _tokens(self, part: str) -> Iterable[int]:
        """Tokens of one part. A part of no more than LONGEST_CACHED letters is shorter than the
        lookahead, so that a transducer would hold it to its end: its tokens are remembered."""
        if len(part) > LONGEST_CACHED:
            transducer = Transducer(self.merges)
            return chain(transducer.push(self._symbols(part)), finishing(transducer))
        known = self.parts.get(part)
        if known is None:
            known = self.merges.merged(list(self._symbols(part)))
            if len(self.parts) >= CACHED_PIECES:
                self.parts.clear()
            self.parts[part] = known
        return known

    def _symbols(self, part: str) -> Iterator[int]:
        """The vocabulary has no token for unknown letters; they give nothing."""
        get, last = self.merges.vocab.get, len(part) - 1
        for i, letter in enumerate(part):
            symbol = get(letter if i < last else letter + self.suffix)
            if symbol is not None:
                yield symbol


def finishing(transducer: Transducer) -> Iterator[int]:
    """What the transducer still holds, asked for when all else has been taken."""
    yield from transducer.finish()


def blocks(text: str) -> Iterator[str]:
    """The text in pieces of about BLOCK characters, cut before a blank that all pattern languages
    take for one; a stretch without such a blank stays whole."""
    start = 0
    while start < len(text):
        found = _PLAIN_BLANK.search(text, start + BLOCK)
        stop = found.start() if found else len(text)
        yield text[start:stop] if start or stop < len(text) else text
        start = stop


def sections(word: str) -> Iterator[str]:
    """A long word in pieces of about LONG_WORD characters. It is cut where neither normalization
    nor the split into parts looks across: between an ASCII letter and an ASCII mark other than the
    apostrophe, beside an ASCII digit. A run of letters stays whole."""
    start = 0
    while start < len(word):
        found = _CUT.search(word, start + LONG_WORD)
        stop = found.start() if found else len(word)
        yield word[start:stop]
        start = stop


def _widths(model: dict, suffix: str) -> dict[int, int]:
    """Symbols that each token covers."""
    width = dict.fromkeys(model["vocab"].values(), 1)
    for left, right in model["merges"]:
        vocab = model["vocab"]
        width[vocab[left + right]] = width[vocab[left]] + width[vocab[right]]
    return width


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process."""
    return WordTokenizer(path)


_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every whole text: the number of tokens and digests of ids and text.

    Null and empty texts have no tokens. Every row gives a row; columns other than doc_id and
    text do not matter. ``path`` is a tokenizer file that every executor has. Besides the text
    itself and copies of its longest run of letters, memory does not follow the text's length.
    """

    def digests(doc_id, text):
        n_tokens, ids, decoder, decoded = 0, hashlib.sha256(), Decoder(b" "), hashlib.sha256()
        for packed, shown in word_tokenizer(path).stream(text or ""):
            n_tokens += len(packed) // 4
            ids.update(packed)
            decoded.update(decoder.push(shown).encode())
        decoded.update(decoder.finish().encode())
        return doc_id, n_tokens, ids.hexdigest(), decoded.hexdigest()

    return id_and_text(docs).mapInArrow(per_row(digests, _ROWS), ddl(_ROWS))


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids themselves as an array."""
    rows = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encoded(doc_id, text):
        return doc_id, array("i", b"".join(packed for packed, _ in word_tokenizer(path).stream(text or ""))).tolist()

    return id_and_text(docs).mapInArrow(per_row(encoded, rows), "doc_id BIGINT, ids ARRAY<INT>")
