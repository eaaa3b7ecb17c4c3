"""Main text of web pages, chosen block by block with a recurrent labeller.

A page becomes the sequence of its leaf blocks: runs of text between block-level tags. A
bidirectional LSTM in numpy reads a vector for each block (hashed tags and class names of its
path, hashed words, a few measures) and labels every block with the whole page as context.

There are no labels for pages, so training makes its own, from a bounded sample of the pages:
sampled pages whose markup says which part is the article, and pages put together here from
words of the sample in many layouts, whose every block has a known label.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisory_lake.llm.shared import ship_package, slices
from advisory_lake.llm.words import words_of

TRAIN_PAGES = 200  # pages that training looks at
MADE_PAGES = 480
EPOCHS = 14
PATH_WIDTH, WORD_WIDTH, MEASURES, STATES = 64, 24, 8, 24
PAGES_AT_ONCE = 64
SLICE_BYTES = 4 << 20

#: Elements of the language by the way their text is shown.
UNPARSED = "script style title textarea".split()  # hold no elements; without an end tag the rest of the page is theirs
HIDDEN = "noscript template select svg iframe object canvas".split()  # without an end tag they hide nothing
BLOCKS = (
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead tr ul"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
#: Elements and class words that say what a part of a page is.
BOILERPLATE_TAGS = "nav footer aside form header menu dialog button".split()
BOILERPLATE_CLASSES = (
    "ad ads advert advertisement banner sponsored promo cookie cookies consent notice popup modal newsletter subscribe "
    "signup sidebar menu nav navigation navbar breadcrumb breadcrumbs header masthead footer copyright legal "
    "comment comments reply replies disqus discussion share sharing social related recommended widget toolbar login search"
).split()
ARTICLE_TAGS = "article main".split()
ARTICLE_CLASSES = "article content post entry story body text main page".split()

_BLOCK_SET, _VOID_SET, _HIDDEN_SET = frozenset(BLOCKS), frozenset(VOID), frozenset(HIDDEN)
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<unparsed>{'|'.join(UNPARSED)})(?=[\s/>])(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*(?<!/)>.*?(?:</(?P=unparsed)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*)>"
    r"|<[!?/a-zA-Z][^<>]*(?:>|\Z|(?=<))",
    re.DOTALL | re.IGNORECASE,
)
_HIDDEN_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<unparsed>{'|'.join(UNPARSED)})(?=[\s/>])(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*(?<!/)>.*?</(?P=unparsed)\s*>"
    rf"|<(?P<close>/?)(?P<tag>{'|'.join(HIDDEN)})(?=[\s/>])(?P<attributes>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*)>",
    re.DOTALL | re.IGNORECASE,
)
_HIDES = re.compile(rf"</(?:{'|'.join(HIDDEN)})[\s>]", re.IGNORECASE)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[^a-z0-9]+")


@dataclass
class Block:
    path: tuple[str, ...]  # tags and class words from the outside in
    text: str
    linked: int  # characters inside links


# ---------------------------------------------------------------- pages to blocks


@lru_cache(maxsize=4096)
def _element(tag: str, attributes: str) -> tuple[str, ...]:
    names = [part for found in _NAMES.findall(attributes) for part in _PARTS.split("".join(found).lower()) if part]
    return (tag, *(f".{name}" for name in names))


def _hidden_ends(page: str) -> dict[int, int]:
    """Where hidden elements that have an end tag begin and end. An end tag is that of the last
    element of its name before it that is still open."""
    ends: dict[int, int] = {}
    if not _HIDES.search(page):
        return ends
    waiting: dict[str, list[int]] = {tag: [] for tag in HIDDEN}
    for match in _HIDDEN_TAG.finditer(page):
        if match["tag"] is None:
            continue
        tag = match["tag"].lower()
        if not match["close"]:
            if not match["attributes"].endswith("/"):
                waiting[tag].append(match.start())
        elif waiting[tag]:
            ends[waiting[tag].pop()] = match.end()
    return ends


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks in page order; markup, scripts, styles and comments are no text.

    The head hides nothing of its own: what may stand in it has no text or is hidden anyway, and
    anything else ends it, with or without its end tag, and belongs to the body.
    """
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    linked, at, links = 0, 0, 0

    def close_block():
        nonlocal linked
        text = " ".join(entities.unescape("".join(pieces)).split())
        if text:
            found.append(Block(tuple(name for _, names in stack for name in names), text, linked))
        pieces.clear()
        linked = 0

    page = page or ""
    hidden_ends = _hidden_ends(page)
    while match := _MARKUP.search(page, at):
        if match.start() > at:
            piece = page[at : match.start()]
            pieces.append(piece)
            linked += len(piece) if links else 0
        at = match.end()
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "head":
            close_block()
            continue
        if tag in _HIDDEN_SET:
            at = hidden_ends.get(match.start(), at)  # past its end tag
            continue
        if match["close"]:
            if tag in _BLOCK_SET:
                close_block()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    links -= sum(name == "a" for name, _ in stack[depth:])
                    del stack[depth:]
                    break
            continue
        if tag in _BLOCK_SET:
            close_block()
            if stack and _ends(stack, tag):
                depth = _ends(stack, tag)
                links -= sum(name == "a" for name, _ in stack[-depth:])
                del stack[-depth:]
        elif tag == "br":
            pieces.append(" ")
        if tag not in _VOID_SET and not match["attributes"].endswith("/"):
            stack.append((tag, _element(tag, match["attributes"])))
            links += tag == "a"
    if at < len(page):
        pieces.append(page[at:])
        linked += len(page) - at if links else 0
    close_block()
    return found


def _ends(stack: list, tag: str) -> int:
    """How many open elements a new block element ends: an open paragraph, or an item before it."""
    for depth, (name, _) in enumerate(reversed(stack), 1):
        if name == "p" or (name == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option")):
            return depth
        if name in _BLOCK_SET:
            return 0
    return 0


# ---------------------------------------------------------------- blocks to vectors


@lru_cache(maxsize=65_536)
def _place(name: str) -> int:
    return zlib.crc32(name.encode())


def vectors(blocks: list[Block]) -> np.ndarray:
    """A row for each block of one page."""
    rows = np.zeros((len(blocks), PATH_WIDTH + WORD_WIDTH + MEASURES), np.float32)
    if not blocks:
        return rows
    for row, block in zip(rows, blocks):
        for name in block.path:
            place = _place(name)
            row[place % PATH_WIDTH] += 1.0 if place >> 16 & 1 else -1.0
        for name in block.path[-2:]:
            row[_place("end" + name) % PATH_WIDTH] += 0.5
    words = words_of(pa.array([block.text for block in blocks]), lower=True)
    counts = np.maximum(words.counts(), 1)
    owner = np.repeat(np.arange(len(blocks)), words.counts())
    np.add.at(rows, (owner, PATH_WIDTH + (words.numbers % np.uint64(WORD_WIDTH)).astype(np.int64)), 1.0)
    rows[:, PATH_WIDTH : PATH_WIDTH + WORD_WIDTH] /= np.sqrt(counts)[:, None] * 2
    sizes = np.array([len(block.text) for block in blocks], np.float32)
    ends = np.array([block.text[-1] in ".!?:;…" for block in blocks])
    measures = rows[:, PATH_WIDTH + WORD_WIDTH :]
    measures[:, 0] = np.log1p(sizes) / 5
    measures[:, 1] = np.minimum(np.array([block.linked for block in blocks]) / np.maximum(sizes, 1), 1)
    measures[:, 2] = ends
    measures[:, 3] = np.log1p(counts) / 4
    measures[:, 4] = (np.arange(len(blocks)) + 0.5) / len(blocks)
    measures[:, 5] = np.log1p(len(blocks)) / 5
    measures[:, 6] = [len(block.path) / 10 for block in blocks]
    measures[:, 7] = [any(c in block.text for c in "©|·»") for block in blocks]
    return rows


# ---------------------------------------------------------------- the labeller


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with a logistic output for every step."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @classmethod
    def new(cls, seed: int = 7) -> Labeller:
        rng = np.random.default_rng(seed)
        width = PATH_WIDTH + WORD_WIDTH + MEASURES + STATES + 1
        weights = {}
        for way in ("ahead", "back"):
            w = rng.normal(0, 1 / np.sqrt(width), (width, 4 * STATES))
            w[-1] = 0
            w[-1, STATES : 2 * STATES] = 1  # remember at first
            weights[way] = w.astype(np.float32)
        weights["out"] = rng.normal(0, 0.2, (2 * STATES + 1,)).astype(np.float32)
        return cls(weights)

    def _run(self, way: str, rows: np.ndarray, there: np.ndarray, keep: list | None):
        """States of one direction; rows are (steps, pages, width), there marks real steps."""
        weight = self.weights[way]
        steps, pages, width = rows.shape
        fed = rows.reshape(-1, width) @ weight[:width] + weight[-1]
        fed = fed.reshape(steps, pages, -1)
        recurrent = weight[width:-1]
        state = memory = np.zeros((pages, STATES), np.float32)
        out = np.zeros((steps, pages, STATES), np.float32)
        for t in range(steps) if way == "ahead" else range(steps - 1, -1, -1):
            z = fed[t] + state @ recurrent
            gates = _sigmoid(z[:, : 3 * STATES])
            i, f, o = gates[:, :STATES], gates[:, STATES : 2 * STATES], gates[:, 2 * STATES :]
            g = np.tanh(z[:, 3 * STATES :])
            here = there[t][:, None]
            after = f * memory + i * g
            squashed = np.tanh(after)
            if keep is not None:
                keep.append((t, state, memory, i, f, o, g, squashed))
            state = np.where(here, o * squashed, state)
            memory = np.where(here, after, memory)
            out[t] = state
        return out

    def probabilities(self, rows: np.ndarray, there: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(way, rows, there, None) for way in ("ahead", "back")], axis=2)
        return _sigmoid(both @ self.weights["out"][:-1] + self.weights["out"][-1])

    def gradients(self, rows: np.ndarray, there: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss, by going back through time."""
        kept: dict[str, list] = {"ahead": [], "back": []}
        outs = {way: self._run(way, rows, there, kept[way]) for way in kept}
        both = np.concatenate([outs["ahead"], outs["back"]], axis=2)
        error = np.where(there, _sigmoid(both @ self.weights["out"][:-1] + self.weights["out"][-1]) - labels, 0)
        error = (error / max(there.sum(), 1)).astype(np.float32)
        found = {"out": np.append(np.einsum("tp,tps->s", error, both), error.sum()).astype(np.float32)}
        width = rows.shape[2]
        for n, way in enumerate(kept):
            weight = self.weights[way]
            own = error[:, :, None] * self.weights["out"][n * STATES : (n + 1) * STATES]
            slopes = np.zeros((*error.shape, 4 * STATES), np.float32)
            d_state = d_memory = np.zeros((rows.shape[1], STATES), np.float32)
            grad = np.zeros_like(weight)
            for t, state, memory, i, f, o, g, squashed in reversed(kept[way]):
                here = there[t][:, None]
                d_out = np.where(here, d_state + own[t], 0)
                d_after = np.where(here, d_memory, 0) + d_out * o * (1 - squashed**2)
                z = slopes[t]
                z[:, :STATES] = d_after * g * i * (1 - i)
                z[:, STATES : 2 * STATES] = d_after * memory * f * (1 - f)
                z[:, 2 * STATES : 3 * STATES] = d_out * squashed * o * (1 - o)
                z[:, 3 * STATES :] = d_after * i * (1 - g**2)
                grad[width:-1] += state.T @ z
                d_state = z @ weight[width:-1].T + np.where(here, 0, d_state + own[t])
                d_memory = np.where(here, d_after * f, d_memory)
            flat = slopes.reshape(-1, 4 * STATES)
            grad[:width] = rows.reshape(-1, width).T @ flat
            grad[-1] = flat.sum(axis=0)
            found[way] = grad
        return found


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pages side by side, (steps, pages, width), and which steps are real."""
    steps = max(len(page) for page in pages)
    rows = np.zeros((steps, len(pages), PATH_WIDTH + WORD_WIDTH + MEASURES), np.float32)
    there = np.zeros((steps, len(pages)), bool)
    for n, page in enumerate(pages):
        rows[: len(page), n] = page
        there[: len(page), n] = True
    return rows, there


def fit(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = 7) -> Labeller:
    """Adam over batches of pages of like length."""
    labeller = Labeller.new(seed)
    first = {k: np.zeros_like(v) for k, v in labeller.weights.items()}
    second = {k: np.zeros_like(v) for k, v in labeller.weights.items()}
    order = sorted((n for n in range(len(pages)) if len(pages[n])), key=lambda n: len(pages[n]))
    batches = [order[start : start + 32] for start in range(0, len(order), 32)]
    shuffle, step = random.Random(seed), 0
    for epoch in range(epochs):
        shuffle.shuffle(batches)
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        for batch in batches:
            step += 1
            rows, there = padded([pages[n] for n in batch])
            wanted = np.zeros(there.shape, np.float32)
            for n, page in enumerate(batch):
                wanted[: len(labels[page]), n] = labels[page]
            for k, grad in labeller.gradients(rows, there, wanted).items():
                grad = np.clip(grad, -1, 1)
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.01 * (grad**2 - second[k])
                size = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8
                labeller.weights[k] -= (rate * first[k] / (1 - 0.9**step) / size).astype(np.float32)
    return labeller


# ---------------------------------------------------------------- training pages


def marked_labels(blocks: list[Block]) -> np.ndarray | None:
    """Labels of a page whose markup has an article; None when it has none."""
    inside = [any(tag in block.path for tag in ARTICLE_TAGS) for block in blocks]
    if not any(inside):
        return None
    out = {*BOILERPLATE_TAGS, *(f".{name}" for name in BOILERPLATE_CLASSES)}
    return np.array([is_in and not out & set(block.path) for is_in, block in zip(inside, blocks)], np.float32)


#: Short texts of page furniture in the four languages of the tables.
FURNITURE = (
    "Home|News|About us|Contact|Login|Sign up|Search|Menu|Share|Tweet|Read more|Next|Previous|Privacy policy|Terms of use|"
    "Startseite|Über uns|Kontakt|Anmelden|Suche|Teilen|Mehr lesen|Datenschutz|Impressum|Accueil|À propos|Connexion|Rechercher|"
    "Partager|Lire la suite|Mentions légales|Inicio|Acerca de|Contacto|Buscar|Compartir|Leer más|Aviso legal|"
    "We use cookies to improve our site.|Wir verwenden Cookies.|Nous utilisons des cookies.|Usamos cookies.|"
    "Subscribe to our newsletter|Leave a comment|Reply|Antworten|Répondre|Responder|Advertisement|Anzeige|Publicité|Publicidad|"
    "All rights reserved.|© 2020|Related articles|Most read|Comments (3)|Back to top"
).split("|")


class _Maker:
    """Pages with a known label for every block."""

    def __init__(self, words: list[str], seed: int):
        self.words, self.random = words, random.Random(seed)

    def sentence(self, low: int, high: int) -> str:
        return entities.escape(" ".join(self.random.choices(self.words, k=self.random.randint(low, high))), quote=False)

    def paragraph(self) -> str:
        text = self.sentence(3, self.random.choice((12, 30, 80)))
        return text + self.random.choice((".", ".", ".", "", "!", "?"))

    def page(self) -> tuple[str, list[int]]:
        pick, out, labels = self.random, [], []

        def leaf(tag: str, text: str, label: int, attributes: str = ""):
            out.append(f"<{tag}{attributes}>{text}</{tag}>")
            labels.append(label)

        def links(container: str, names: str, low: int, high: int):
            out.append(f"<{container}{names}><ul>" if pick.random() < 0.7 else f"<{container}{names}><ul class=\"list\">")
            for _ in range(pick.randint(low, high)):
                text = pick.choice(FURNITURE) if pick.random() < 0.5 else self.sentence(1, 3)
                leaf("li", f'<a href="/x">{text}</a>', 0)
            out.append(f"</ul></{container}>")

        def named(*choices: str) -> str:
            name = pick.choice(choices)
            return pick.choice((f' class="{name}"', f' id="{name}"', f' class="{name} wide"', f' class="site-{name}"'))

        def text_box(tag: str, names: str, label: int = 0):
            out.append(f"<{tag}{names}>")
            for _ in range(pick.randint(1, 3)):
                if pick.random() < 0.4:
                    out.append(pick.choice((pick.choice(FURNITURE), self.paragraph())))
                    labels.append(label)
                    out.append("<hr>")
                else:
                    leaf(pick.choice(("p", "div")), pick.choice((pick.choice(FURNITURE), self.paragraph())), label)
            out.append(f"</{tag}>")

        def furniture(where: str):
            kinds = {
                "before": ("nav", "header", "ad", "notice", "crumbs", "form"),
                "inside": ("ad", "aside", "related", "form", "share"),
                "after": ("comments", "aside", "footer", "related", "ad", "form", "notice", "nav"),
            }[where]
            for kind in pick.sample(kinds, pick.randint(1, 3) if where != "inside" else pick.choice((0, 0, 1))):
                if kind == "nav":
                    links(*pick.choice((("nav", ""), ("div", named("nav", "menu", "navbar", "navigation")), ("menu", ""))), 2, 8)
                elif kind == "header":
                    out.append(pick.choice(("<header>", '<div class="header">', '<header class="masthead">')))
                    leaf(pick.choice(("h1", "p", "div")), self.sentence(1, 4), 0)
                    if pick.random() < 0.5:
                        links("nav", "", 2, 5)
                    out.append("</header></div>")
                elif kind == "footer":
                    text_box(*pick.choice((("footer", ""), ("div", named("footer", "copyright", "legal")))))
                elif kind == "aside":
                    text_box(*pick.choice((("aside", ""), ("div", named("sidebar", "widget", "promo")))))
                elif kind == "related":
                    links("div", named("related", "recommended", "sidebar"), 2, 6)
                elif kind == "comments":
                    box = pick.choice(("div", "section"))
                    out.append(f"<{box}{named('comments', 'comment-list', 'disqus', 'discussion', 'replies')}>")
                    for _ in range(pick.randint(1, 6)):
                        leaf(pick.choice(("p", "div", "li", "article")), self.paragraph(), 0, pick.choice(("", ' class="comment"', ' class="reply"')))
                    out.append(f"</{box}>")
                elif kind == "form":
                    out.append(pick.choice(("<form>", '<form class="newsletter">', '<form id="search">')))
                    leaf(pick.choice(("label", "p", "button")), pick.choice((pick.choice(FURNITURE), self.sentence(2, 12))), 0)
                    out.append("</form>")
                else:
                    names = {"ad": ("ad", "ads", "advert", "banner", "sponsored"), "notice": ("cookie-notice", "consent", "notice", "popup"), "crumbs": ("breadcrumb", "breadcrumbs"), "share": ("share", "social")}[kind]
                    text_box("div", named(*names))

        out.append("<html><body>")
        shell = pick.random() < 0.4
        out.append("<div class=\"page\">" if shell else "")
        furniture("before")
        tag, names = pick.choice(
            (("article", ""), ("article", ""), ("article", ' class="post"'), ("main", ""), ("div", named("content", "post", "entry", "article-body", "story")), ("section", named("content", "article")), ("div", ""))
        )
        out.append(f"<{tag}{names}>")
        if pick.random() < 0.75:
            leaf(pick.choice(("h1", "h1", "h2")), self.sentence(1, 10), 1)
        for n in range(pick.choice((1, 2, 4, 8, 14, 24))):
            kind = pick.random()
            if kind < 0.72:
                leaf("p", self.paragraph(), 1)
            elif kind < 0.8:
                leaf(pick.choice(("h2", "h3")), self.sentence(1, 6), 1)
            elif kind < 0.86:
                out.append("<ul>")
                for _ in range(pick.randint(1, 4)):
                    leaf("li", self.sentence(1, 14), 1)
                out.append("</ul>")
            elif kind < 0.92:
                leaf(pick.choice(("blockquote", "pre", "div", "td")), self.paragraph(), 1)
            elif kind < 0.96:  # left open, as pages do
                out.append(f"<p><b>{self.paragraph()}<br>")
                labels.append(1)
            elif n:
                furniture("inside")
        out.append(f"</{tag}>")
        furniture("after")
        out.append("</div></body></html>" if pick.random() < 0.9 else "")
        return "".join(out), labels


def train(pages: DataFrame, most_pages: int = TRAIN_PAGES, made_pages: int = MADE_PAGES) -> Labeller:
    """Fit on at most ``most_pages`` pages, different ones with the smallest hashes, and on
    pages made from their words."""
    sample = pages.select(F.col("html").cast("string").alias("html")).where("html is not null")
    sample = sample.withColumn("h", F.xxhash64("html"))
    # hashes first: a task sends numbers to the driver, and then only the chosen pages
    chosen = [row.h for row in sample.select("h").distinct().orderBy("h").limit(most_pages).collect()]
    picked = sample.where(F.col("h").isin(chosen)).groupBy("h").agg(F.min("html").alias("html"))
    rows, labels, words = [], [], set()
    for page in sorted(row.html for row in picked.collect()):
        blocks = blocks_of(page)
        words.update(word for block in blocks for word in block.text.split()[:200])
        marked = marked_labels(blocks)
        if marked is not None:
            rows.append(vectors(blocks))
            labels.append(marked)
    maker = _Maker(sorted(words) or ["text"], 11)
    for _ in range(made_pages):
        page, known = maker.page()
        blocks = blocks_of(page)
        if len(blocks) == len(known):
            rows.append(vectors(blocks))
            labels.append(np.array(known, np.float32))
    return fit(rows, labels)


# ---------------------------------------------------------------- on Spark


def labelled(labeller: Labeller, pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page which of its blocks are main text."""
    order = sorted((n for n, blocks in enumerate(pages) if blocks), key=lambda n: len(pages[n]))
    result = [np.zeros(len(blocks), bool) for blocks in pages]
    for start in range(0, len(order), PAGES_AT_ONCE):
        group = order[start : start + PAGES_AT_ONCE]
        rows, there = padded([vectors(pages[n]) for n in group])
        chances = labeller.probabilities(rows, there)
        for n, page in enumerate(group):
            result[page] = chances[: len(pages[page]), n] >= 0.5
    return result


def main_text(pages: DataFrame, labeller: Labeller | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row: the blocks that are main text, in page order,
    joined by one line feed.

    Null and empty html give an empty text. Rows that repeat a page are read each for itself;
    other columns do not matter. Character references are decoded and white space inside a
    block becomes one space; a line break element counts as white space.
    """
    ship_package(pages.sparkSession)
    labeller = labeller or train(pages)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html", SLICE_BYTES):
                blocks = [blocks_of(page) for page in part.column(2).to_pylist()]
                texts = [
                    "\n".join(block.text for block, main in zip(own, kept) if main)
                    for own, kept in zip(blocks, labelled(labeller, blocks))
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    columns = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return columns.mapInArrow(run, "page_id LONG, url STRING, text STRING, n_chars LONG")
