"""HTML extraction: gradient-boosted trees over DOM nodes and a decoding that keeps ancestors and descendants consistent.

Each block element and each run of text is a node (`dom_blocks`). Its features are its kind and what its attributes say, the same
of its ancestors, its depth, text, link and sentence density of its subtree, its share of the page, and its siblings. Trees give
the log-odds that main text lies below the node. Decoding picks the set of kept nodes of largest total log-odds in which every
kept node has a kept parent: a subtree is worth its own log-odds and those of the worthwhile subtrees below it, computed from
the leaves up, and is kept if that is above zero and its parent is kept.

Pages carry no labels. The trees are fitted on labelled pages that `composed_page` lays out: main text in many containers, and menus, headers,
footers, sidebars, notices, adverts, forms and reader comments around and within it. Their sentences are drawn from a bounded sample
of the table's pages; where it has none, from made-up words.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmart.llm import boosted_trees
from barmart.llm.dom_blocks import GROUPS, HIDDEN, KIND_NAMES, SAYS, Blocks
from barmart.llm.shared import slices

#: Pages that sentences for training are drawn from (the first by hash), the longest of them, and pages laid out.
SAMPLE_PAGES, SAMPLE_CHARS = 200, 32_768
TRAIN_PAGES, TREES = 500, 40
#: Marks main text in pages that are laid out (a private-use character).
MARK = "\ue000"
#: Pages held at once in a task, at most, and their characters.
HELD_PAGES, HELD_CHARS = 256, 1 << 22

# --- features ---------------------------------------------------------------------------


def features(blocks: Blocks) -> np.ndarray:
    """One row of numbers for each node."""
    column = {name: np.array(getattr(blocks, name), np.int64) for name in Blocks.COLUMNS}
    parent, end, kind = column["parent"], column["end"], column["kind"]
    n = len(parent)
    at = np.arange(n)

    def below(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(values)))
        return (sums[end] - sums[at]).astype(float)

    chars, links, words, stops = (below(column[c]) for c in ("chars", "links", "words", "stops"))
    runs = below(kind == 0)
    paragraphs = below(np.where(kind[np.maximum(parent, 0)] == KIND_NAMES.index("paragraph"), column["chars"], 0))
    items = below(np.where(column["all_kinds"] >> KIND_NAMES.index("item") & 1, column["chars"], 0))
    roots = np.array(blocks.pages, np.int64)
    page = roots[np.searchsorted(roots, at, side="right") - 1] if n else at
    upper = np.maximum(parent, 0)
    before = column["previous"]
    after = np.full(n, -1)
    after[before[before >= 0]] = at[before >= 0]
    link_share = links / np.maximum(chars, 1)

    def beside(values: np.ndarray, which: np.ndarray) -> np.ndarray:
        return np.where(which >= 0, values[np.maximum(which, 0)], -1)

    columns = [
        *[kind == k for k in range(len(KIND_NAMES))],
        *[column["own_says"] >> k & 1 for k in range(HIDDEN + 1)],
        *[column["all_says"] >> k & 1 for k in range(HIDDEN + 1)],
        *[column["all_kinds"] >> k & 1 for k in range(1, len(KIND_NAMES))],
        column["depth"],
        column["nth"],
        np.array(blocks.children)[upper],
        (at - page) / np.maximum(end[page] - page, 1),
        np.log1p(chars),
        np.log1p(words),
        link_share,
        stops / np.maximum(words, 1),
        words / np.maximum(runs, 1),
        paragraphs / np.maximum(chars, 1),
        items / np.maximum(chars, 1),
        chars / np.maximum(end - at, 1),
        chars / np.maximum(chars[page], 1),
        chars / np.maximum(chars[upper], 1),
        link_share[upper],
        np.log1p(chars[upper]),
        *[beside(np.log1p(chars), w) for w in (before, after)],
        *[beside(link_share, w) for w in (before, after)],
        *[beside(kind, w) == kind for w in (before, after)],
    ]
    return np.stack(columns, 1).astype(np.float32) if n else np.zeros((0, len(columns)), np.float32)


def decoded(blocks: Blocks, margins: np.ndarray) -> list[bool]:
    """For each node whether it is kept; the root of a page always is, as it stands for the page."""
    gain = margins.tolist()
    parent = blocks.parent
    for at in range(len(parent) - 1, -1, -1):
        if parent[at] >= 0 and gain[at] > 0:
            gain[parent[at]] += gain[at]
    kept: list[bool] = []
    for at, up in enumerate(parent):
        kept.append(up < 0 or (kept[up] and gain[at] > 0))
    return kept


def main_texts(sources: list[str | None], model: boosted_trees.Trees) -> list[str]:
    """The main text of each page."""
    blocks = Blocks()
    for source in sources:
        blocks.add_page(source)
    kept = decoded(blocks, model.margins(features(blocks)))
    out = []
    for start in blocks.pages:
        runs = range(start, blocks.end[start])
        out.append("\n".join(blocks.texts[k] for k in runs if kept[k] and blocks.texts[k] is not None))
    return out


# --- pages to learn from ----------------------------------------------------------------


class Sentences:
    """Sentences and names for laid-out pages."""

    def __init__(self, rng: random.Random, runs: list[str]) -> None:
        self.rng = rng
        self.runs = [r.split() for r in runs if r.count(" ") >= 11]
        if len(self.runs) < 20:
            pool = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
            self.runs += [[rng.choice(pool) for _ in range(60)] for _ in range(60)]

    def prose(self, least: int, most: int) -> str:
        run = self.rng.choice(self.runs)
        n = min(self.rng.randrange(least, most + 1), len(run))
        k = self.rng.randrange(len(run) - n + 1)
        text = " ".join(run[k : k + n])
        if n < 4 and self.rng.random() < 0.2:
            text = " ".join([run[k]] * self.rng.randrange(1, 40))
        return html.escape((text[:1].upper() + text[1:]).rstrip(".") + self.rng.choice(["", ".", ".", ".", ".", "!", "?"]))

    def name(self) -> str:
        return html.escape(" ".join(self.rng.choice(self.rng.choice(self.runs)).strip(".,") for _ in range(self.rng.randrange(1, 4))))


def composed_page(rng: random.Random, say: Sentences) -> str:
    """A page in which each run of main text carries MARK."""
    pick = rng.choice

    def naming(group: str) -> str:
        word = pick(SAYS[group].split())
        word = pick([word] * 4 + [f"{word}-{pick(['box', 'wrap', 'list', 'area', '1', 'inner'])}", f"{pick(['site', 'js', 'c', 'page'])}-{word}", f"{word}{pick(['Box', 'Wrap', 'Area'])}"])
        return pick([' class="{}"', ' class="{}"', ' id="{}"', ' class="x{}1 {}"'.replace("{}", "", 1)]).replace("{}", word)

    def boxed(tag: str, group: str | None, inner: str) -> str:
        for _ in range(rng.randrange(3) // 2):
            inner = f"<div>{inner}</div>"
        return f"<{tag}{naming(group) if group else ''}>{inner}</{tag}>"

    def own(tag: str, group: str, inner: str) -> str:
        """An element that says what it is, by its tag, its attributes, or both."""
        kind = rng.randrange(3)
        return boxed("div" if kind == 0 else tag, group if kind != 1 or tag in ("div", "section", "p") else None, inner)

    def link(words: str) -> str:
        return f'<a href="/{rng.randrange(999)}">{words}</a>'

    def menu() -> str:
        links = [link(say.name()) for _ in range(rng.randrange(2, 12))]
        inner = pick([f"<ul>{''.join(f'<li>{x}</li>' for x in links)}</ul>", f"<ul>{''.join(f'<li>{x}' for x in links)}</ul>", pick([" | ", " ", ""]).join(links)])
        return own("nav", "menu", inner)

    def prose_block(least: int = 3, most: int = 45) -> str:
        text = say.prose(least, most)
        return pick([f"<p>{text}</p>", f"<p>{text}", text, f"<div>{text}</div>", f"<p>{text}<br>{say.prose(2, 12)}</p>"])

    def several(least: int, most: int) -> str:
        return "".join(f"<p>{say.prose(3, 45)}</p>" for _ in range(rng.randrange(least, most + 1)))

    def advert() -> str:
        return own(pick(["div", "section", "aside", "p"]), "advert", pick([say.prose(3, 40), prose_block(), f"{link(say.name())} {say.prose(3, 20)}", several(1, 2)]))

    def notice() -> str:
        return own(pick(["div", "section", "p", "dialog"]), "notice", pick([say.prose(4, 40), prose_block(), several(1, 2)]) + pick(["", "<button>OK</button>", link(say.name())]))

    def form() -> str:
        inner = pick(["", prose_block(3, 15), f"<label>{say.name()}</label>"]) + f'<input name="q"><button>{say.name()}</button>' + pick(["", f"<select><option>{say.name()}<option>{say.name()}</select>"])
        return own("form", "form", inner)

    def share() -> str:
        return own("div", "share", pick([" ".join(link(say.name()) for _ in range(3)), f"<ul>{''.join(f'<li>{link(say.name())}</li>' for _ in range(3))}</ul>"]))

    def teasers() -> str:
        entry = [pick([f"<li>{link(say.prose(3, 9))}</li>", f"<h3>{link(say.name())}</h3><p>{say.prose(4, 30)}</p>", f"<p>{say.prose(5, 45)}</p>"]) for _ in range(rng.randrange(1, 6))]
        return own("aside", "side", pick(["", f"<h3>{say.name()}</h3>", f"<h2>{say.name()}</h2>"]) + "".join(entry))

    def comments() -> str:
        def one() -> str:
            head = pick(["", f"<b>{say.name()}</b> ", f"<div>{link(say.name())}</div>", f"<h4>{say.name()}</h4>"])
            return pick([boxed("div", pick(["comment", None]), head + several(1, 3)), boxed("li", pick(["comment", None]), head + say.prose(3, 60)), f"<article{naming('comment')}>{head}{several(1, 2)}</article>"])

        inner = "".join(one() for _ in range(rng.randrange(1, 6)))
        return boxed(pick(["div", "section", "ol", "aside"]), "comment", pick(["", f"<h3>{say.name()}</h3>", f"<h2>{say.name()}</h2>"]) + inner)

    def header() -> str:
        inner = pick([f"<h1>{say.name()}</h1>", f"<p>{say.name()}</p>", f"<div>{link(say.name())}</div>", f"<h2>{say.prose(2, 8)}</h2>", say.prose(3, 14)])
        return own("header", "edge", inner + pick(["", menu(), form()]))

    def footer() -> str:
        return own("footer", "edge", pick(["&copy; ", ""]) + pick([say.prose(3, 25), several(1, 2), " &middot; ".join(link(say.name()) for _ in range(4)), f"{say.name()} &middot; {say.prose(4, 14)}"]))

    def marked(words: str) -> str:
        inline = rng.randrange(8)
        if inline == 0:
            words = f"{words} {link(say.name())} {say.prose(2, 14)}"
        elif inline == 1:
            words = f"<b>{words}</b> {say.prose(1, 14)}"
        elif inline == 2:
            words = f"<b>{words}<br>"
        return MARK + words

    def main_block() -> str:
        kind, text = rng.randrange(26), marked(say.prose(1, pick([1, 4, 12, 60, 60, 120])))
        if kind == 0:
            return f"<h{rng.randrange(2, 5)}>{MARK}{say.name()}</h2>"
        if kind == 1:
            tag = pick(["ul", "ol"])
            return f"<{tag}>{''.join(f'<li>{MARK}{say.prose(1, 20)}</li>' for _ in range(rng.randrange(2, 7)))}</{tag}>"
        if kind == 2:
            return f"<blockquote>{pick(['', '<p>'])}{text}</blockquote>"
        if kind == 3:
            rows = [f"<tr><td>{MARK}{say.name()}</td><td>{MARK}{say.prose(1, 5)}</td></tr>" for _ in range(rng.randrange(1, 4))]
            return f"<table>{''.join(rows)}</table>"
        if kind == 4:
            return f"<figure><img src=x><figcaption>{text}</figcaption></figure>"
        if kind == 5:
            return f"<pre>{text}</pre>"
        if kind in (6, 7):
            return f"<div>{text}</div>"
        if kind == 8:
            return f"<section><h3>{MARK}{say.name()}</h3><p>{text}</p></section>"
        return f"<p>{text}" + pick(["</p>", "</p>", "</p>", ""])

    within = [advert, notice, share, form, teasers, menu, footer]
    body = []
    if rng.random() < 0.8:
        body.append(f"<h1>{MARK}{say.prose(2, 12)}</h1>")
    elif rng.random() < 0.3:
        body.append(f"<header><h1>{MARK}{say.prose(2, 12)}</h1></header>")
    body += [main_block() for _ in range(pick([1, 1, 2, 3, 5, 8, 14]))]
    for _ in range(pick([0, 0, 1, 1, 2])):
        body.insert(rng.randrange(len(body) + 1), pick(within)())
    if rng.random() < 0.35:
        body.append(comments())
    text_box = pick([("article", None)] * 5 + [("main", None), ("article", "text"), ("div", "text"), ("div", "text"), ("div", "text"), ("section", "text"), ("div", None)])
    main = f"<{text_box[0]}{naming('text') if text_box[1] else ''}>{''.join(body)}</{text_box[0]}>"
    for _ in range(pick([0, 0, 1, 2])):
        main = pick([f"<div>{main}</div>", f"<main>{main}</main>", f'<div id="{pick(["wrapper", "container", "page", "content", "main"])}">{main}</div>'])
    before = [x() for x in (header, menu, advert, notice, form) if rng.random() < 0.5]
    after = [x() for x in (teasers, comments, advert, notice, form, share, footer, menu) if rng.random() < 0.4]
    if rng.random() < 0.5:
        rng.shuffle(before)
        rng.shuffle(after)
    if rng.random() < 0.2:
        main = f"{teasers()}{main}"
    head = f"<head><title>{say.name()}</title><style>p{{margin:0}}</style><script>var t=\"<p>\";</script></head>"
    inner = f"{''.join(before)}<!-- {say.name()} -->{main}{''.join(after)}"
    if rng.random() < 0.3:
        inner = f'<div class="{pick(["wrapper", "container", "page", "layout", "root"])}">{inner}</div>'
    return f"<!DOCTYPE html><html>{pick([head, ''])}<body{pick(['', naming('text')])}>{inner}" + pick(["</body></html>", ""])


def labelled_nodes(pages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of laid-out pages: 1 if a run with MARK lies in the subtree."""
    blocks = Blocks()
    for page in pages:
        blocks.add_page(page)
    marks = np.array([t is not None and MARK in t for t in blocks.texts], np.int64)
    sums = np.concatenate(([0], np.cumsum(marks)))
    labels = sums[np.array(blocks.end)] > sums[np.arange(len(marks))]
    blocks.chars = [c - t.count(MARK) if t else c for c, t in zip(blocks.chars, blocks.texts)]
    return features(blocks), labels.astype(float)


def fitted(sample: list[str | None], pages: int = TRAIN_PAGES, trees: int = TREES, seed: int = 12) -> boosted_trees.Trees:
    """The model, from sentences of sample pages (in a fixed order) and a fixed seed."""
    blocks = Blocks()
    for source in sample:
        blocks.add_page(source)
    rng = random.Random(seed)
    say = Sentences(rng, [t for t in blocks.texts if t is not None])
    return boosted_trees.fit(*labelled_nodes([composed_page(rng, say) for _ in range(pages)]), trees=trees)


# --- the operator -----------------------------------------------------------------------


def sample_pages(pages: DataFrame, most: int = SAMPLE_PAGES, most_chars: int = SAMPLE_CHARS) -> list[str]:
    """At most `most` pages of at most `most_chars` characters, first by hash: the bound of what is gathered to learn from."""
    kept = pages.select("html").filter(F.length("html") <= most_chars)
    return [r["html"] for r in kept.orderBy(F.xxhash64("html"), "html").limit(most).collect()]


def extract(pages: DataFrame, model: boosted_trees.Trees | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages` (page_id, url, html; other columns are ignored).

    Null html is an empty page; a page without main text has an empty text. Repeated rows are returned as often as they occur.
    `model` comes from `fitted`; by default it is fitted to this table.
    """
    model = fitted(sample_pages(pages)) if model is None else model

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: pa.RecordBatch, sources: list[str | None]) -> pa.RecordBatch:
            found = main_texts(sources, model)
            sizes = pa.array([len(t) for t in found], pa.int64())
            return pa.RecordBatch.from_arrays([*rows.columns[:2], pa.array(found, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

        for batch in slices(batches, HELD_PAGES):
            held, first, size = [], 0, 0
            for k, source in enumerate(batch.column("html")):
                source = source.as_py()
                if held and size + len(source or "") > HELD_CHARS:
                    yield done(batch.slice(first, k - first), held)
                    held, first, size = [], k, 0
                held.append(source)
                size += len(source or "")
            if held:
                yield done(batch.slice(first), held)

    rows = pages.select("page_id", "url", "html")
    return rows.mapInArrow(texts, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
