"""HTML extraction by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: runs of text between block-level tags, each
with the path of tags (and their class words) above it. A bidirectional LSTM in numpy reads
tag-path and hashed-word vectors of the whole sequence and labels every block main text
or not, so a block's label depends on the rest of the page.

There are no labelled pages. The model learns from a bounded sample of pages whose blocks
are labelled by what their tags and classes are called, in several variants each: containers
take other usual names, names that tell nothing, or none at all; the main part's paragraphs become
lists, tables, quotes, captions and unnamed boxes; headings, menus and footers are left out; sidebars, notices,
forms, link lists and reader comments are put in. Pages are parsed and labelled in the tasks that read them; only hashes are
shuffled, to choose the sample, and no page is cut.

Defined results: a null or empty page has empty text; so has a page without main text; a page
that breaks off in a tag or reference keeps the text before it; repeated rows give repeated
results; an empty table gives no rows; extra columns do not matter. Line breaks (`br`) are
white space inside a block.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES, SAMPLE_CHARS = 300, 60_000  # pages that training looks at, and the longest of them
PATH, WORDS, EXTRA = 1024, 48, 8  # widths of the input vector's parts
INPUT = PATH + WORDS + EXTRA
HIDDEN = 20
EPOCHS, BATCH, RATE, SEED = 24, 25, 0.02, 3
BATCH_BLOCKS = 10_000  # padded blocks labelled at once
STEP_BLOCKS = 4_000  # padded blocks of a training step

# Names of HTML elements.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol optgroup option p pre search section select summary table tbody "
    "td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template".split())
CLOSED_BY_SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Words in tags and classes that tell what a part of a page is.
MAIN_WORDS = frozenset("article main content post entry story articlebody".split())
OTHER_WORDS = frozenset(
    "nav menu navbar navigation footer bottom header masthead aside sidebar ad ads advert adverts advertisement promo banner sponsored "
    "cookie cookies consent notice alert form button select login newsletter subscribe comment comments reply replies disqus share social "
    "related recommended widget breadcrumb breadcrumbs pagination popup modal legal copyright".split()
)
OTHER_NAMES = (
    ("nav", "div.menu", "div.navbar", "ul.menu", "header", "div.header"),
    ("footer", "div.footer", "div.bottom", "div.legal"),
    ("div.ad", "aside", "div.sidebar", "div.promo", "div.banner", "div.cookie", "div.notice", "div.related", "form", "div.newsletter", "div.share"),
    ("div.comments", "section.comments", "div.comment", "ol.comments", "div.replies"),
)
MAIN_NAMES = ("article", "main", "div.content", "div.post", "div.entry", "section.story", "div.article", "article")

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int  # characters in links


def _name(tag: str, attributes: str) -> str:
    """The tag and the words of its class, id and role, lower-case, joined by dots."""
    if not attributes or "=" not in attributes:
        return tag
    found = [a or b or c for a, b, c in NAMED.findall(attributes)]
    return ".".join([tag, *re.findall(r"[a-z0-9]+", " ".join(found).lower())]) if found else tag


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks of a page in page order."""
    out: list[Block] = []
    path: list[str] = []
    text: list[str] = []
    linked = links = 0
    above: tuple[str, ...] | None = None  # the path at the block's first text

    def close() -> None:
        nonlocal linked, above
        if text:
            own = " ".join(html.unescape("".join(text)).split())
            if own:
                out.append(Block(above or tuple(path), own, min(linked, len(own))))
            text.clear()
        linked, above = 0, None

    def pop_to(at: int) -> None:
        nonlocal links
        for name in path[at:]:
            links -= name.partition(".")[0] == "a"
        del path[at:]

    at = 0
    while True:
        found = TAG.search(page, at)
        piece = page[at : found.start() if found else len(page)]
        if piece:
            text.append(piece)
            if not piece.isspace():
                above = above or tuple(path)
                linked += len(piece) if links else 0
        if not found:
            break
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        ends = bool(found[1] or found[4])
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            close()
        if ends:
            for i in range(len(path) - 1, -1, -1):
                if path[i].partition(".")[0] == tag:
                    pop_to(i)
                    break
            continue
        if tag in RAW:
            over = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = over.end() if over else len(page)
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            for i in range(len(path) - 1, -1, -1):  # a paragraph ends where another block begins
                outer = path[i].partition(".")[0]
                if outer == "p":
                    pop_to(i)
                    break
                if outer in BLOCK:
                    break
            siblings = CLOSED_BY_SIBLING.get(tag, ())
            if siblings:
                for i in range(len(path) - 1, -1, -1):
                    outer = path[i].partition(".")[0]
                    if outer in siblings:
                        pop_to(i)
                        break
                    if outer in ("ul", "ol", "dl", "table", "select"):
                        break
        name = _name(tag, found[3] or found[6] or "")
        path.append(name)
        links += tag == "a"
    close()
    return out


_slots: dict[str, tuple[int, ...]] = {}


def _path_slots(path: tuple[str, ...]) -> list[int]:
    slots = []
    for name in path:
        own = _slots.get(name)
        if own is None:
            own = _slots[name] = tuple(zlib.crc32(w.encode()) % PATH for w in dict.fromkeys([name, *name.split(".")]))
            if len(_slots) > 50_000:
                _slots.clear()
        slots += own
    return slots


class _WordSlots(dict):
    """The slot of every word, found once for a common one."""

    def __missing__(self, word: str) -> int:
        slot = zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORDS
        if len(word) <= 48:
            if len(self) >= 100_000:
                self.clear()
            self[word] = slot
        return slot


_word_slots = _WordSlots()


def _vectors(pages: list[list[Block]]) -> np.ndarray:
    """Input vectors of all blocks of all pages."""
    total = sum(map(len, pages))
    x = np.zeros((total, INPUT), np.float32)
    rows, slots, row, paths = [], [], 0, {}
    word_counts, word_slots = [], []
    for page in pages:
        for k, b in enumerate(page):
            own = paths.get(b.path)
            if own is None:
                own = paths[b.path] = sorted(set(_path_slots(b.path)))
            rows += [row] * len(own)
            slots += own
            split = b.text.split(" ")
            word_counts.append(len(split))
            word_slots.append(bytes(map(_word_slots.__getitem__, split)))
            size = len(b.text)
            x[row, -EXTRA:] = (
                min(len(b.path), 20) / 10, np.log1p(size) / 6, b.linked / size, k / len(page), 1 / (1 + k), 1 / (len(page) - k),
                b.text[-1] in ".!?", 20 * sum(map(b.text.count, ".,;:")) / (size + 20),
            )
            row += 1
    x[rows, slots] = 1
    if word_counts:
        word_row = np.repeat(np.arange(total), word_counts)
        counts = np.bincount(word_row * WORDS + np.frombuffer(b"".join(word_slots), np.uint8), minlength=total * WORDS).reshape(total, WORDS)
        x[:, PATH : PATH + WORDS] = counts / np.maximum(1, np.sqrt((counts * counts).sum(1)))[:, None]
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _reversed(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Every row's first `size` steps in reverse; padding stays at the end."""
    steps = np.arange(x.shape[1])
    at = np.where(steps < sizes[:, None], sizes[:, None] - 1 - steps, steps)
    return np.take_along_axis(x, at[:, :, None], 1)


def _run(inner: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states (batch, step, HIDDEN) of one direction, and what its gradient needs."""
    h = c = np.zeros((len(inner), HIDDEN), inner.dtype)
    out, kept = np.empty((*inner.shape[:2], HIDDEN), inner.dtype), []
    for t in range(inner.shape[1]):
        z = inner[:, t] + h @ u
        gate = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN : 2 * HIDDEN], gate[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, h0 = c, h
        c = f * c + i * g
        h = o * np.tanh(c)
        out[:, t] = h
        kept.append((i, f, o, g, before, c, h0))
    return out, kept


def _back(u: np.ndarray, kept: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates' inputs and of `u`."""
    dh, dc = np.zeros_like(dout[:, 0]), np.zeros_like(dout[:, 0])
    dz = np.empty((*dout.shape[:2], 4 * HIDDEN), dout.dtype)
    du = np.zeros_like(u)
    for t in range(dout.shape[1] - 1, -1, -1):
        i, f, o, g, before, c, h0 = kept[t]
        dh = dh + dout[:, t]
        tc = np.tanh(c)
        dc = dc + dh * o * (1 - tc * tc)
        dz[:, t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        du += h0.T @ dz[:, t]
        dh, dc = dz[:, t] @ u.T, dc * f
    return dz, du


def _logits(model: list[np.ndarray], x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list]:
    """Logits (page, step) of pages whose blocks `x` holds one after another."""
    wf, uf, bf, wb, ub, bb, v, c = model
    hf, kf = _run(_padded(x @ wf + bf, sizes), uf)
    hb, kb = _run(_reversed(_padded(x @ wb + bb, sizes), sizes), ub)
    both = np.concatenate([hf, _reversed(hb, sizes)], 2)
    return both @ v + c, [kf, kb, both]


def _padded(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sizes), int(sizes.max()), x.shape[1]), x.dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = x
    return out


def named_labels(page: list[Block]) -> list[int]:
    """1 for the blocks that their tags and classes name as main text."""
    names = [{w for name in b.path for w in name.split(".")} for b in page]
    main = [bool(n & MAIN_WORDS) and not n & OTHER_WORDS for n in names]
    if not any(main):  # no named container: paragraphs of prose
        main = [not n & OTHER_WORDS and len(b.text) > 80 and b.linked < 0.3 * len(b.text) for n, b in zip(names, page)]
    return [int(m) for m in main]


def _unknown(random: np.random.Generator) -> str:
    """A container whose name tells nothing."""
    tag = ("div", "section", "div")[random.integers(3)]
    if random.random() < 0.5:
        return tag
    words = random.integers(1, 4)
    return ".".join([tag, *("".join(chr(97 + c) for c in random.integers(26, size=random.integers(2, 9))) for _ in range(words))])


def _pieces(text: str, most: int, random: np.random.Generator) -> list[str]:
    """`text` in pieces of 1 to `most` words."""
    left, out = text.split(" "), []
    while left:
        size = int(random.integers(1, most + 1))
        out.append(" ".join(left[:size]))
        left = left[size:]
    return out


def _reshaped(b: Block, stem: tuple[str, ...], random: np.random.Generator) -> list[Block]:
    """A paragraph of the main part as another kind of block, or as several."""

    def cut(above: tuple[str, ...], names: tuple[str, ...], most: int) -> list[Block]:
        linked = random.random() < 0.15
        pieces = _pieces(b.text, most, random)
        return [Block((*stem, *above, names[i % len(names)]), t, len(t) if linked else 0) for i, t in enumerate(pieces)]

    def whole(*names: str) -> list[Block]:
        return [Block((*stem, *names), b.text, b.linked)]

    kind = random.integers(9)
    if kind == 0:
        return cut((("ul", "ol")[random.integers(2)],), ("li",), 25)
    if kind == 1:
        return cut(("table", "tbody", "tr")[: 3 if random.random() < 0.5 else 1] + ("tr",) * int(random.random() < 0.5), ("th", "td", "td", "td"), 4)
    if kind == 2:
        return whole("blockquote", "p") if random.random() < 0.5 else whole("blockquote")
    if kind == 3:
        return cut(("dl",), ("dt", "dd"), 10)
    if kind == 4:
        return whole("figure", "figcaption")
    if kind == 5:
        return cut((), (("h2", "h3")[random.integers(2)], "p", "p"), 30)
    if kind == 6:
        return whole(_unknown(random))
    if kind == 7:
        return whole(_unknown(random), "p")
    return whole("pre")


def _variant(page: list[Block], labels: list[int], others: list[Block], random: np.random.Generator) -> tuple[list[Block], list[int]]:
    """The page in another layout.

    Containers take other names, names that tell nothing, or none; paragraphs of the main part
    become lists, tables, quotes and the like; parts that are not main text are put in.
    """
    swap: dict[str, str] = {}
    nameless = random.random() < 0.2  # text, links and places must tell

    def renamed(name: str) -> str:
        if name not in swap:
            swap[name] = name
            group = next((g for g in OTHER_NAMES if name in g), None)
            if group:
                swap[name] = "div" if nameless else group[random.integers(len(group))]
            elif name in MAIN_NAMES:
                swap[name] = _unknown(random) if nameless or random.random() < 0.4 else MAIN_NAMES[random.integers(len(MAIN_NAMES))]
        return swap[name]

    share = random.random() * random.integers(2)  # of the main part's paragraphs that are reshaped
    wrap = tuple(_unknown(random) for _ in range(random.integers(3))) if random.random() < 0.4 else ()
    out: list[tuple[Block, int]] = []
    for b, k in zip(page, labels):
        box = next((i for i, n in enumerate(b.path) if k and n in MAIN_NAMES), None)
        if box is None:
            out.append((Block(tuple(map(renamed, b.path)), b.text, b.linked), k))
            continue
        stem = (*map(renamed, b.path[: box + 1]), *wrap)
        inner = b.path[box + 1 :]
        if inner[:1] == ("p",) and random.random() < share:
            out += [(piece, 1) for piece in _reshaped(b, stem, random)]
        else:
            out.append((Block((*stem, *inner), b.text, b.linked), k))
    first = next((i for i, (_, k) in enumerate(out) if k), 0)
    if random.random() < 0.25:  # no heading
        del out[first : first + 1]
    if random.random() < 0.25:  # nothing before the main part
        del out[:first]
    if random.random() < 0.25:  # nothing after it
        del out[max((i + 1 for i, (_, k) in enumerate(out) if k), default=0) :]
    inside = random.random() < 0.5
    for group, most in ((OTHER_NAMES[2], 3), (OTHER_NAMES[3], 6), (OTHER_NAMES[2], 5)):
        if not nameless and random.random() < 0.5 and others:
            box = group[random.integers(len(group))]
            ends = [i for i, (_, k) in enumerate(out) if k]
            at = (ends[-1] + 1) if ends and (most == 6 or random.random() < 0.5) else int(random.integers(len(out) + 1))
            stem = out[ends[-1]][0].path[: 3 + len(wrap)] if ends and inside else ("html", "body")
            extra = [others[random.integers(len(others))].text for _ in range(int(random.integers(1, most + 1)))]
            if most == 5:  # a list of links
                short = [" ".join(t.split(" ")[: random.integers(1, 9)]) for t in extra]
                out[at:at] = [(Block((*stem, box, "ul", "li", "a"), t, len(t)), 0) for t in short]
            else:
                inner = (("p",), ("li",), ("div", "p"), ("div",), ())[random.integers(5)]
                out[at:at] = [(Block((*stem, box, *inner), t, 0), 0) for t in extra]
    if not nameless and others and random.random() < 0.3:  # a header without links
        words = others[random.integers(len(others))].text.split(" ")[: random.integers(1, 9)]
        box = ("header", "div.header", "div.masthead")[random.integers(3)]
        out.insert(0, (Block(("html", "body", box, *((), ("p",), ("h1",), ("div",))[random.integers(4)]), " ".join(words), 0), 0))
    return [b for b, _ in out], [k for _, k in out]


def fit(pages: list[str]) -> list[np.ndarray]:
    """A model from sample pages; the same pages give the same model."""
    random = np.random.Generator(np.random.PCG64(SEED))

    def start(*shape: int) -> np.ndarray:
        return (random.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

    bias = np.zeros(4 * HIDDEN, np.float32)
    bias[HIDDEN : 2 * HIDDEN] = 1
    model = [start(INPUT, 4 * HIDDEN), start(HIDDEN, 4 * HIDDEN), bias, start(INPUT, 4 * HIDDEN), start(HIDDEN, 4 * HIDDEN), bias.copy(), start(2 * HIDDEN), np.zeros(1, np.float32)]
    parsed = [b for b in map(blocks_of, pages) if b]
    labels = [named_labels(p) for p in parsed]
    if not parsed:
        return model
    prose = [b for p, k in zip(parsed, labels) for b, one in zip(p, k) if one]
    m, v = [np.zeros_like(p) for p in model], [np.zeros_like(p) for p in model]
    # As many steps for few pages as for many: the cost of training is fixed.
    for step in range(1, EPOCHS * SAMPLE_PAGES // BATCH + 1):
        pick = random.integers(len(parsed), size=BATCH)
        batch = [_variant(parsed[i], labels[i], prose, random) if random.random() < 0.7 else (parsed[i], labels[i]) for i in pick]
        batch = [(b, k) for b, k in batch if b] or [(parsed[0], labels[0])]
        batch = batch[: max(1, STEP_BLOCKS // max(len(b) for b, _ in batch))]
        sizes = np.array([len(b) for b, _ in batch])
        x = _vectors([b for b, _ in batch])
        y = _padded(np.array([k for _, ks in batch for k in ks], np.float32)[:, None], sizes)[:, :, 0]
        mask = np.arange(y.shape[1]) < sizes[:, None]
        z, (kf, kb, both) = _logits(model, x, sizes)
        d = ((_sigmoid(z) - y) * mask / mask.sum()).astype(np.float32)
        dboth = d[:, :, None] * model[6]
        zf, uf = _back(model[1], kf, dboth[:, :, :HIDDEN])
        zb, ub = _back(model[4], kb, _reversed(dboth[:, :, HIDDEN:], sizes))
        zf, zb = zf[mask], _reversed(zb, sizes)[mask]
        grads = [x.T @ zf, uf, zf.sum(0), x.T @ zb, ub, zb.sum(0), (both * d[:, :, None]).sum((0, 1)), d.sum(keepdims=True)[0]]
        rate = RATE * min(1, 3 * (1 - step / (EPOCHS * SAMPLE_PAGES // BATCH + 1)))
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            model[k] = (model[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def label_blocks(model: list[np.ndarray], pages: list[list[Block]]) -> list[np.ndarray]:
    """For every page, whether each of its blocks is main text."""
    sizes = np.array([len(p) for p in pages], np.int64)
    out: list = [np.zeros(n, bool) for n in sizes]
    order = [i for i in np.argsort(sizes, kind="stable") if sizes[i]]
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * sizes[order[end]] <= BATCH_BLOCKS:
            end += 1
        pick = order[at:end]
        own = sizes[pick]
        z, _ = _logits(model, _vectors([pages[i] for i in pick]), own)
        for k, i in enumerate(pick):
            out[i] = z[k, : sizes[i]] > 0
        at = end
    return out


def _extractor(model: list[np.ndarray]):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                pages = [blocks_of(h) if h else [] for h in part.column("html").to_pylist()]
                texts = ["\n\n".join(b.text for b, k in zip(p, keep) if k) for p, keep in zip(pages, label_blocks(model, pages))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return extract


def extract_text(pages: DataFrame) -> DataFrame:
    """`page_id, url, text, n_chars` of every row of `pages` (page_id, url, html)."""
    fitting = pages.where((F.length("html") > 0) & (F.length("html") <= SAMPLE_CHARS)).select(
        F.xxhash64("page_id", "html").alias("draw"), F.col("html").cast("string").alias("html")
    )
    drawn = fitting.select("draw").distinct().orderBy("draw").limit(SAMPLE_PAGES)
    sample = fitting.join(F.broadcast(drawn), "draw").groupBy("draw").agg(F.min("html").alias("html")).collect()
    model = fit(sorted(r.html for r in sample))
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return given.mapInArrow(_extractor(model), "page_id long, url string, text string, n_chars long")
