"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks (``html_blocks``). Each block becomes a vector: the mean of learned vectors of the names
on its tag path, that of the name next to the text, the mean of learned vectors of its hashed words, and a few measures
(size, share of linked characters, signs, place on the page). A bidirectional LSTM in numpy reads the vectors of the
whole page in both directions and a logistic unit labels every block as main text or not. Main blocks are joined by
one space in page order.

There is no labelled table, so the training labels are weak: on a bounded, hashed sample of pages (``FIT_PAGES`` pages,
expected) the names on a block's path say what it is, and from the texts of these pages ``VARIANTS * FIT_PAGES`` further
pages are composed with other containers (sidebars, notices, comments, forms, adverts between and inside main blocks, and
containers without a telling name), whose labels are known by construction. Training is deterministic.

Defined results: a null or empty html, and a page without main blocks, gives an empty text of 0 characters; repeated
rows are labelled each; a null page id is carried; with no page to learn from the composed pages are made of fixed words; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, strings, text_buffers
from .html_blocks import Leaf, Path, leaf, leaves
from .textarrays import SIGNS, word_hashes


FIT_PAGES = 240
VARIANTS = 4
EPOCHS = 6
BATCH = 32
#: Training pages are cut to windows of so many blocks; labelling reads pages whole.
TRAIN_BLOCKS = 96
NAMES, WORDS = 1024, 2048
NAME_DIM, WORD_DIM, MEASURES, HIDDEN = 16, 6, 7, 16
WIDTH = 2 * NAME_DIM + WORD_DIM + MEASURES
#: How much is held at once: pages a run of the network, its cells (pages times the blocks of the longest; a longer page
#: runs alone), and characters of html read before labelling.
PAGES_AT_ONCE = 256
CELLS = 16_384
CHARS_AT_ONCE = 4_000_000
SEED = 7

#: Names that mark main text and names that mark what surrounds it.
MAIN = frozenset("article main .article .main .content .post .entry .story .text .body .prose".split())
AROUND = frozenset(
    "nav header footer aside form menu dialog .nav .navigation .navbar .menu .header .footer .sidebar .aside .ad .ads "
    ".advert .advertisement .sponsor .promo .banner .cookie .consent .notice .alert .popup .modal .share .social .related "
    ".recommended .comment .comments .reply .replies .discussion .login .signup .subscribe .newsletter .search .breadcrumb "
    ".breadcrumbs .pagination .copyright .legal .tags .widget".split())
_PROSE = ("p", "p", "p", "p", "h1", "h2", "h3", "blockquote", "pre", "li", "td", "dd", "div")
_PLAIN = ("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore "
          "magna aliqua").split()


def labelled(page: list[Leaf]) -> list[int]:
    """What the names on the blocks' paths say; each node of a path is looked at once."""
    known: dict[Path | None, tuple[bool, bool, bool]] = {None: (False, False, False)}

    def signs(node: Path) -> tuple[bool, bool, bool]:
        """Whether a name around the block, of main text, of prose is on the path."""
        new, at = [], node
        while at not in known:
            new.append(at)
            at = at.above
        for n in reversed(new):
            known[n] = tuple(old or any(x in kind for x in n.names)
                             for old, kind in zip(known[n.above], (AROUND, MAIN, _PROSE)))
        return known[node]

    found = [signs(block.node) for block in page]
    has_main = any(main for _, main, _ in found)
    return [int(not around and (main if has_main else prose)) for around, main, prose in found]


def compose(texts: list[str], rng: np.random.Generator) -> tuple[list[Leaf], list[int]]:
    """A page made of the given texts in other containers, with its labels."""
    def pick(options):
        return options[int(rng.integers(len(options)))]

    def some() -> str:
        text = pick(texts).split()
        start = int(rng.integers(max(1, len(text) - 3)))
        return " ".join(text[start:start + int(rng.integers(2, 40))]) or pick(_PLAIN)

    around = sorted(AROUND)

    def surrounding(lead: tuple[str, ...]) -> list[tuple[Leaf, int]]:
        name = pick(around)
        box = (name,) if name[0] != "." else (pick(("div", "div", "section", "ul", "p", "aside")), name)
        if rng.random() < 0.4:
            box = (*box, "div", pick((".box", ".wrap", ".container", ".block", ".list", ".inner", ".logo", ".title", ".item")))
        kind, out = rng.random(), []
        for _ in range(int(rng.integers(1, 9))):
            words = some()
            if kind < 0.4:
                out.append((leaf(words, (*lead, *box, "ul", "li", "a"), len(words)), 0))
            elif kind < 0.7:
                out.append((leaf(words, (*lead, *box, "p"), 0), 0))
            else:
                out.append((leaf(words, (*lead, *box), len(words) if rng.random() < 0.3 else 0), 0))
                break
        return out

    lead = ("html", "body") + (("div",) + pick(((), (".page",), (".wrapper",), (".container",))) if rng.random() < 0.4
                               else ())
    name = pick(sorted(MAIN))
    main = (name,) if name[0] != "." else ("div", name, *pick(((), (".inner",), (".area",), (".wrap",))))
    if rng.random() < 0.1:
        main = ("div",)
    rows: list[tuple[Leaf, int]] = []
    for _ in range(int(rng.integers(0, 4))):
        rows += surrounding(lead)
    for n in range(int(rng.integers(1, 20))):
        tag = "h1" if n == 0 and rng.random() < 0.7 else pick(_PROSE)
        path = (*lead, *main, *(("ul",) if tag == "li" else ("table", "tr") if tag == "td" else ()), tag)
        text = pick(texts) if rng.random() < 0.6 else some()
        if rng.random() < 0.2:
            path = (*path, pick(("b", "strong", "em", "a", "span")))
        rows.append((leaf(text, path, len(text) if path[-1] == "a" else 0), 1))
        if rng.random() < 0.08:
            rows += surrounding((*lead, *main))
    for _ in range(int(rng.integers(0, 4))):
        rows += surrounding(lead)
    return [r for r, _ in rows], [y for _, y in rows]


class Inputs:
    """Blocks of many pages as arrays: hashed names and words with their offsets, and measures."""

    def __init__(self, pages: list[list[Leaf]], hashed: dict[str, int]):
        blocks = [leaf for page in pages for leaf in page]
        self.sizes = np.array([len(p) for p in pages], np.int64)

        def code(name: str) -> int:
            if name not in hashed:
                hashed[name] = zlib.crc32(name.encode()) % NAMES
            return hashed[name]

        # The nodes of all paths, each after the one above it; a block without names is in one named 0.
        places: dict[Path, int] = {}
        above, codes, levels = [-1], [[0]], [0]

        def place(node: Path) -> int:
            new, at = [], node
            while at and at not in places:
                new.append(at)
                at = at.above
            for n in reversed(new):
                places[n] = len(codes)
                above.append(places[n.above] if n.above else -1)
                codes.append([code(x) for x in n.names])
                levels.append(n.level)
            return places[node]

        self.node = np.array([place(b.node) if b.node.size else 0 for b in blocks], np.int64)
        self.above, levels = np.array(above, np.int64), np.array(levels, np.int64)
        order = np.argsort(levels, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(levels[order])) + 1)
        self.name_at = np.concatenate([[0], np.cumsum([len(c) for c in codes])]).astype(np.int64)
        self.names = np.array([n for c in codes for n in c], np.int64)
        self.path_size = np.array([max(b.node.size, 1) for b in blocks], np.int64)
        self.last = np.array([code(b.node.last) if b.node.size else 0 for b in blocks], np.int64)
        texts = pa.array([b.text for b in blocks], pa.string())
        found, self.word_at = word_hashes(*text_buffers(texts), SIGNS)
        self.words = (found % np.uint64(WORDS)).astype(np.int64)
        raw, at = text_buffers(texts)
        signs = np.concatenate([[0], np.cumsum(SIGNS[raw])]) if len(raw) else np.zeros(1, np.int64)
        size = np.maximum(np.diff(at), 1)
        spot = np.concatenate([np.arange(n) / max(n - 1, 1) for n in self.sizes]) if len(blocks) else np.zeros(0)
        linked = np.array([min(1.0, b.linked / max(1, len(b.text))) for b in blocks])
        count = np.diff(self.word_at)
        self.measures = np.column_stack([
            np.log1p(size) / 8, np.log1p(count) / 6, linked, np.diff(signs[at]) / size, spot, 1 - spot,
            np.minimum(self.path_size, 12) / 12]) if len(blocks) else np.zeros((0, MEASURES))

    def total(self, table: np.ndarray, items: np.ndarray, at: np.ndarray) -> np.ndarray:
        count = np.diff(at)
        total = np.zeros((len(count), table.shape[1]), table.dtype)
        full = np.flatnonzero(count)
        for i in range(0, len(full), CELLS):
            part = full[i:i + CELLS]
            first = at[part[0]]
            total[part] = np.add.reduceat(table[items[first:at[part[-1] + 1]]], at[part] - first, axis=0)
        return total

    def path_means(self, table: np.ndarray) -> np.ndarray:
        """The mean over the names on each block's path; a node adds its own names to the sum of the one above."""
        sums = self.total(table, self.names, self.name_at)
        for nodes in self.levels[1:]:
            sums[nodes] += sums[self.above[nodes]]
        return sums[self.node] / self.path_size[:, None].astype(table.dtype)

    def path_gradients(self, rows: np.ndarray) -> np.ndarray:
        """The gradient of the names' table for that of ``path_means``."""
        sums = np.zeros((len(self.above), rows.shape[1]))
        np.add.at(sums, self.node, rows / self.path_size[:, None])
        for nodes in self.levels[:0:-1]:
            np.add.at(sums, self.above[nodes], sums[nodes])
        return gathered(NAMES, self.names, np.repeat(sums, np.diff(self.name_at), axis=0))

    def vectors(self, p: dict[str, np.ndarray]) -> np.ndarray:
        words = self.total(p["words"], self.words, self.word_at)
        words /= np.maximum(np.diff(self.word_at), 1)[:, None].astype(words.dtype)
        return np.concatenate([self.path_means(p["names"]), p["names"][self.last], words,
                               self.measures.astype(np.float32)], axis=1)

    def padded(self) -> tuple[np.ndarray, np.ndarray]:
        """(time, page) block numbers, the last one for padding, and the mask."""
        longest, start = int(self.sizes.max(initial=0)), np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        t = np.arange(longest)[:, None]
        mask = t < self.sizes[None]
        return np.where(mask, start[None] + t, 0).astype(np.int64), mask.astype(np.float32)[:, :, None]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def run_lstm(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool = False):
    """Hidden states (time, page, HIDDEN) of one direction; a masked step leaves the state as it is."""
    steps, pages, _ = x.shape
    h = np.zeros((pages, HIDDEN), np.float32)
    c = np.zeros_like(h)
    out = np.zeros((steps, pages, HIDDEN), np.float32)
    tape = []
    span = max(1, CELLS // max(pages, 1))
    for t in range(steps):
        if t % span == 0:
            ahead = x[t:t + span] @ w + b
        z = ahead[t % span] + h @ u
        gates = sigmoid(z[:, :3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        c_new = f * c + i * g
        tc = np.tanh(c_new)
        m = mask[t]
        if keep:
            tape.append((i, f, o, g, c, tc, h))
        c, h = m * c_new + (1 - m) * c, m * (o * tc) + (1 - m) * h
        out[t] = h
    return out, tape


def back_lstm(grad: np.ndarray, x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, tape: list):
    """Gradients of x, w, u and b for the gradient of the hidden states."""
    dx, du = np.zeros_like(x), np.zeros_like(u)
    dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
    dh, dc = np.zeros(x.shape[1:2] + (HIDDEN,), np.float32), np.zeros(x.shape[1:2] + (HIDDEN,), np.float32)
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, c_old, tc, h_old = tape[t]
        m = mask[t]
        dh = dh + grad[t]
        step = dh * m
        dct = dc * m + step * o * (1 - tc ** 2)
        dz = np.concatenate([dct * g * i * (1 - i), dct * c_old * f * (1 - f), step * tc * o * (1 - o),
                             dct * i * (1 - g ** 2)], axis=1)
        dz_all[t] = dz
        du += h_old.T @ dz
        dh = dh * (1 - m) + dz @ u.T
        dc = dc * (1 - m) + dct * f
    dx = dz_all @ w.T
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    return dx, x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(axis=0)


def initial(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    p = {"names": normal(NAMES, NAME_DIM, scale=0.3), "words": normal(WORDS, WORD_DIM, scale=0.05),
         "out": normal(2 * HIDDEN, 1, scale=0.2), "skip": normal(WIDTH, 1, scale=0.1), "bias": np.zeros(1, np.float32)}
    for d in "fb":
        p["w" + d] = normal(WIDTH, 4 * HIDDEN, scale=WIDTH ** -0.5)
        p["u" + d] = normal(HIDDEN, 4 * HIDDEN, scale=HIDDEN ** -0.5)
        p["b" + d] = np.zeros(4 * HIDDEN, np.float32)
        p["b" + d][HIDDEN:2 * HIDDEN] = 1.0
    return p


def forward(p: dict[str, np.ndarray], inputs: Inputs, keep: bool = False):
    """Logits (time, page), with all that backpropagation needs."""
    flat = inputs.vectors(p)
    spot, mask = inputs.padded()
    x = flat[spot] * mask
    ahead, tape_f = run_lstm(x, mask, p["wf"], p["uf"], p["bf"], keep)
    behind, tape_b = run_lstm(x[::-1], mask[::-1], p["wb"], p["ub"], p["bb"], keep)
    state = np.concatenate([ahead, behind[::-1]], axis=2)
    logit = (state @ p["out"] + x @ p["skip"] + p["bias"])[:, :, 0]
    return logit, (flat, spot, mask, x, state, tape_f, tape_b)


def gathered(size: int, items: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sums of ``rows`` by item."""
    return np.column_stack([np.bincount(items, rows[:, d], size) for d in range(rows.shape[1])])


def gradients(p: dict[str, np.ndarray], inputs: Inputs, marks: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean cross-entropy of the block labels ``marks``."""
    logit, (flat, spot, mask, x, state, tape_f, tape_b) = forward(p, inputs, True)
    d = ((sigmoid(logit) - marks[spot]) * mask[:, :, 0] / mask.sum()).astype(np.float32)[:, :, None]
    g = {"out": (state * d).sum(axis=(0, 1))[:, None], "skip": (x * d).sum(axis=(0, 1))[:, None], "bias": d.sum((0, 1))}
    ds = d @ p["out"].T
    dx = d @ p["skip"].T
    a, g["wf"], g["uf"], g["bf"] = back_lstm(ds[:, :, :HIDDEN], x, mask, p["wf"], p["uf"], tape_f)
    b, g["wb"], g["ub"], g["bb"] = back_lstm(ds[::-1, :, HIDDEN:], x[::-1], mask[::-1], p["wb"], p["ub"], tape_b)
    dx = (dx + a + b[::-1]) * mask
    block = np.zeros_like(flat)
    real = mask[:, :, 0] > 0
    block[spot[real]] = dx[real]
    g["names"] = inputs.path_gradients(block[:, :NAME_DIM])
    g["names"] += gathered(NAMES, inputs.last, block[:, NAME_DIM:2 * NAME_DIM])
    count = np.diff(inputs.word_at)
    g["words"] = gathered(WORDS, inputs.words, np.repeat(block[:, 2 * NAME_DIM:2 * NAME_DIM + WORD_DIM]
                                                         / np.maximum(count, 1)[:, None], count, axis=0))
    return g


def train(pages: list[list[Leaf]]) -> dict[str, np.ndarray]:
    """Parameters fitted to the weak labels of ``pages`` and to composed pages, by Adam."""
    rng = np.random.default_rng(SEED)
    pages = [p for p in pages if p]
    texts = [leaf.text for p in pages for leaf in p] or [" ".join(_PLAIN)]
    data = [(p, labelled(p)) for p in pages]
    data += [compose(texts, rng) for _ in range(VARIANTS * FIT_PAGES)]
    cuts = [(p[i:i + TRAIN_BLOCKS], y[i:i + TRAIN_BLOCKS]) for p, y in data for i in range(0, len(p), TRAIN_BLOCKS)]
    p, hashed = initial(rng), {}
    first, second, step = {k: 0.0 for k in p}, {k: 0.0 for k in p}, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(cuts))
        rate = 0.01 * (0.5 if epoch >= EPOCHS // 2 else 1.0)
        for at in range(0, len(order), BATCH):
            batch = [cuts[i] for i in order[at:at + BATCH]]
            marks = np.array([y for _, ys in batch for y in ys], np.float32)
            step += 1
            for k, g in gradients(p, Inputs([b for b, _ in batch], hashed), marks).items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = (p[k] - rate * (first[k] / (1 - 0.9 ** step))
                        / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return p


def main_blocks(p: dict[str, np.ndarray], pages: list[list[Leaf]], hashed: dict[str, int]) -> list[np.ndarray]:
    """For each page which of its blocks are main text; pages of like size run together, a long one alone."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if pages[i]]
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and end - at < PAGES_AT_ONCE and (end - at + 1) * len(pages[order[end]]) <= CELLS:
            end += 1
        part = order[at:end]
        logit, _ = forward(p, Inputs([pages[i] for i in part], hashed))
        for column, i in enumerate(part):
            out[i] = logit[:len(pages[i]), column] > 0
        at = end
    return out


def groups(htmls: pa.Array) -> Iterator[tuple[int, int]]:
    """Cuts rows into runs of some ``CHARS_AT_ONCE`` bytes of html, at most ``2 * PAGES_AT_ONCE`` rows each."""
    _, at = text_buffers(htmls)
    start = 0
    for i in range(len(htmls)):
        if i + 1 == len(htmls) or i + 1 - start == 2 * PAGES_AT_ONCE or at[i + 2] - at[start] > CHARS_AT_ONCE:
            yield start, i + 1 - start
            start = i + 1


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> dict[str, np.ndarray]:
    """The labeller, trained on a bounded sample of ``pages``."""
    known = pages.filter(F.col(html_col).isNotNull() & F.col(id_col).isNotNull()).select(id_col, html_col)
    rows = bounded_sample(known, id_col, FIT_PAGES).orderBy(id_col, html_col).toArrow()
    return train([leaves(t) for t in rows[html_col].to_pylist()])


def extract(pages: DataFrame, model: dict[str, np.ndarray] | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    held = pages.sparkSession.sparkContext.broadcast(model or fit(pages, id_col, html_col))
    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                          F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed: dict[str, int] = {}
        for batch in batches:
            for at, n in groups(strings(batch.column(2))):
                part = batch.slice(at, n)
                blocks = [leaves(t) for t in strings(part.column(2)).to_pylist()]
                texts = [" ".join(b.text for b, keep in zip(page, chosen) if keep)
                         for page, chosen in zip(blocks, main_blocks(held.value, blocks, hashed))]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                       pa.array([len(t) for t in texts], pa.int64())],
                                      names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    return narrow.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
