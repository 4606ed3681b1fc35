"""Main text of pages by a linear-chain conditional random field over leaf blocks.

A page's leaf blocks (see ``blocks``) are a sequence; each is labelled as main text or not.
Features are the tags above a block, the words in their classes, ids and roles, and its text:
length, share of links, of digits and of capitals, how it ends.  The field has a weight a
feature and label and one a pair of labels in a row; it is trained by the gradient of the
conditional likelihood on labelled pages and decoded by Viterbi.

The labelled pages are made here from a seed, ``LABELLED`` of them: articles in the elements and
classes that sites use for them, among menus, headers, footers, sidebars, notices, adverts,
forms and reader comments, around and inside the article, in random order and random words.
None of the pages to be extracted is used in training.

Defined cases: NULL or empty html, and a page without main text, give the empty text; repeated
rows each get a row; an empty table gives no rows; columns that clash are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.functions.rows import by_bytes
from pagetables.llm.common import Tucked
from pagetables.llm.blocks import Block, leaf_blocks

LABELLED = 240
EPOCHS = 40
PENALTY = 1e-3
BATCH_BYTES = 4 * 1024 * 1024

# How sites name the parts of a page.
MAIN = ["article", "main", "div class=content", "div id=main-content", "div class='post entry'", "section class=story", "div role=main", "div class=article-body"]
AROUND = {
    "menu": ["nav", "div class=menu", "ul class=navbar", "div id=navigation", "div class=breadcrumb", "div role=navigation"],
    "header": ["header", "div class=header", "div id=masthead", "div class=topbar"],
    "footer": ["footer", "div class=footer", "div id=bottom", "div class=copyright"],
    "sidebar": ["aside", "div class=sidebar", "div id=side", "div class=related", "section class=recommended"],
    "notice": ["div class=notice", "div id=cookie-banner", "div class='cookie consent'", "div role=alert", "section class=newsletter", "div class=popup"],
    "advert": ["div class=ad", "div class=ads", "div class=advert", "div class=sponsored", "div id=promo", "section class=advertisement", "aside class=ad"],
    "form": ["form", "form class=search", "form id=login", "div class=subscribe"],
    "comments": ["section class=comments", "div id=comments", "div class=comment", "ol class=comment-list", "div class=discussion", "section id=disqus"],
}
INSIDE = ("advert", "comments", "notice", "form", "sidebar", "menu")


def features(block: Block, at: int, n: int) -> list[str]:
    """What a block shows, as names."""
    text, size = block.text, len(block.text)
    words = size and text.count(" ") + 1
    linked = block.linked / size
    digits = sum(map(text.count, "0123456789")) / size
    return [
        "any",
        f"own {block.own}",
        *(f"in {t}" for t in block.above),
        *(f"named {w}" for w in block.names),
        f"words {min(7, int(np.log2(words)))}",
        f"links {int(linked * 3.99)}",
        f"digits {int(min(digits * 5, 2))}",
        f"ends {'stop' if text[-1] in '.!?…。' else 'other'}",
        *(["starts with a sign"] if text[0] in "©®|»›•" else []),
        *(["first"] if at == 0 else []),
        *(["last"] if at == n - 1 else []),
    ]


@dataclass
class Field:
    """A trained field: a weight pair a feature, a weight a pair of labels (0 other, 1 main)."""

    weights: dict[str, tuple[float, float]]
    turns: np.ndarray

    @cached_property
    def known(self) -> frozenset[str]:
        """The words of classes, ids and roles that have a weight."""
        return frozenset(name.removeprefix("named ") for name in self.weights if name.startswith("named "))

    def scores(self, blocks: list[Block]) -> np.ndarray:
        rows = np.zeros((len(blocks), 2))
        for i, block in enumerate(blocks):
            for name in features(block, i, len(blocks)):
                pair = self.weights.get(name)
                if pair is not None:
                    rows[i, 0] += pair[0]
                    rows[i, 1] += pair[1]
        return rows

    def decode(self, blocks: list[Block]) -> list[bool]:
        """The most likely labels, by Viterbi."""
        if not blocks:
            return []
        (a, b), (c, d) = self.turns.tolist()
        rows = self.scores(blocks).tolist()
        other, main = rows[0]
        back = []
        for s0, s1 in rows[1:]:
            from0, from1 = main + c > other + a, main + d > other + b
            back.append((from0, from1))
            other, main = (main + c if from0 else other + a) + s0, (main + d if from1 else other + b) + s1
        label = main > other
        labels = [label]
        for pair in reversed(back):
            label = pair[label]
            labels.append(label)
        return labels[::-1]


def likelihood(scores: np.ndarray, turns: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of labels and its gradients for scores and turns, by forward-backward."""
    n = len(scores)
    ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = scores[0]
    for i in range(1, n):
        ahead[i] = scores[i] + np.logaddexp(ahead[i - 1, 0] + turns[0], ahead[i - 1, 1] + turns[1])
    for i in range(n - 2, -1, -1):
        step = scores[i + 1] + back[i + 1]
        back[i] = np.logaddexp(turns[:, 0] + step[0], turns[:, 1] + step[1])
    total = np.logaddexp(ahead[-1, 0], ahead[-1, 1])
    wanted = -np.exp(ahead + back - total)
    wanted[np.arange(n), labels] += 1
    turned = np.zeros((2, 2))
    for i in range(1, n):
        turned -= np.exp(ahead[i - 1][:, None] + turns + (scores[i] + back[i])[None, :] - total)
        turned[labels[i - 1], labels[i]] += 1
    value = scores[np.arange(n), labels].sum() + turns[labels[:-1], labels[1:]].sum() - total
    return float(value), wanted, turned


def train(pages: list[tuple[list[Block], list[bool]]], epochs: int = EPOCHS, penalty: float = PENALTY) -> Field:
    """The field that makes the labels of the pages likely, by gradient ascent with momentum."""
    named = [[features(b, i, len(blocks)) for i, b in enumerate(blocks)] for blocks, _ in pages]
    index = {name: k for k, name in enumerate(sorted({f for page in named for block in page for f in block}))}
    weights, turns = np.zeros((len(index), 2)), np.zeros((2, 2))
    moved, turned = np.zeros_like(weights), np.zeros_like(turns)
    squares, turn_squares = np.full_like(weights, 1e-8), np.full_like(turns, 1e-8)
    sparse = []
    for page, (_, labels) in zip(named, pages):
        rows = np.repeat(np.arange(len(page)), [len(b) for b in page])
        columns = np.array([index[f] for block in page for f in block])
        sparse.append((rows, columns, np.array(labels, dtype=int)))
    for epoch in range(epochs):
        grad, grad_turns = -penalty * len(pages) * weights, -penalty * len(pages) * turns
        for rows, columns, labels in sparse:
            scores = np.zeros((len(labels), 2))
            np.add.at(scores, rows, weights[columns])
            _, wanted, pair = likelihood(scores, turns, labels)
            np.add.at(grad, columns, wanted[rows])
            grad_turns += pair
        for value, g, m, s in ((weights, grad, moved, squares), (turns, grad_turns, turned, turn_squares)):
            m += 0.2 * (g - m)
            s += 0.05 * (g * g - s)
            value += 0.2 * (1 - epoch / epochs) * m / np.sqrt(s)
    return Field({name: (weights[k, 0], weights[k, 1]) for name, k in index.items()}, turns)


class _Maker:
    """Makes labelled pages; blocks of main text carry a mark that is taken out again."""

    MARK = "\ue000"

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def pick(self, items):
        return items[int(self.rng.integers(len(items)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, least: int, most: int, stop: float = 0.9) -> str:
        letters = [
            "".join(map(chr, self.rng.integers(97, 123, int(self.rng.integers(1, 10)))))
            for _ in range(int(self.rng.integers(least, most + 1)))
        ]
        if self.chance(0.15):
            letters = [w + self.pick(["", "###", "%%%", "!", " 12", "&amp;&amp;"]) for w in letters]
        return " ".join(letters).capitalize() + (self.pick([".", ".", ".", "!", "?"]) if self.chance(stop) else "")

    def element(self, spec: str, body: str) -> str:
        return f"<{spec}>{body}</{spec.split(' ')[0]}>"

    def paragraph(self, mark: str) -> str:
        text = mark + self.words(1, int(self.pick([3, 12, 60, 120])), 0.8)
        style = self.rng.random()
        if style < 0.1:
            text = f"<b>{text}<br>"
        elif style < 0.25:
            text += f" <a href='/{self.words(1, 1, 0)}'>{self.words(1, 4, 0)}</a> {self.words(2, 9)}"
        return f"<p>{text}</p>" if self.chance(0.7) else f"<p>{text}"

    def main_body(self) -> list[str]:
        """The article's own blocks."""
        parts = [f"<h1>{self.MARK}{self.words(1, 12, 0.4)}</h1>"] if self.chance(0.85) else []
        for _ in range(int(self.pick([0, 1, 2, 4, 8, 16]))):
            kind = self.rng.random()
            if kind < 0.75:
                parts.append(self.paragraph(self.MARK))
            elif kind < 0.85:
                items = "".join(f"<li>{self.MARK}{self.words(1, 15, 0.5)}</li>" for _ in range(int(self.rng.integers(1, 6))))
                parts.append(f"<ul>{items}</ul>")
            elif kind < 0.92:
                parts.append(f"<h2>{self.MARK}{self.words(1, 8, 0.2)}</h2>")
            else:
                parts.append(f"<blockquote>{self.MARK}{self.words(4, 40)}</blockquote>")
        if not parts:
            parts.append(self.paragraph(self.MARK))
        return parts

    def other(self, kind: str) -> str:
        spec = self.pick(AROUND[kind])
        if kind == "menu":
            links = [f"<a href='/{self.words(1, 1, 0)}'>{self.words(1, 3, 0)}</a>" for _ in range(int(self.rng.integers(2, 9)))]
            body = "<ul>" + "".join(f"<li>{a}</li>" for a in links) + "</ul>" if self.chance(0.7) else " | ".join(links)
        elif kind == "form":
            body = f"<label>{self.words(1, 3, 0)}</label><input name=q><button>{self.words(1, 2, 0)}</button>"
            body += self.paragraph("") if self.chance(0.3) else ""
        elif kind == "footer":
            body = f"&copy; {self.words(1, 4, 0)} &middot; {self.words(1, 20)}"
        elif kind == "comments":
            body = "".join(f"<div class=comment>{self.paragraph('')}</div>" for _ in range(int(self.rng.integers(1, 5))))
        else:
            body = self.words(1, 25) if self.chance(0.6) else "".join(self.paragraph("") for _ in range(int(self.rng.integers(1, 4))))
        return self.element(spec, body)

    def page(self) -> str:
        main = self.main_body()
        for kind in INSIDE:
            if self.chance(0.15):
                main.insert(int(self.rng.integers(1, len(main) + 1)), self.other(kind))
        article = self.element(self.pick(MAIN), "".join(main))
        if self.chance(0.2):
            article = self.element(self.pick(["main", "div class=wrapper", "div id=page"]), article)
        before = [self.other(k) for k in ("header", "menu", "notice", "advert", "form", "sidebar") if self.chance(0.5)]
        after = [self.other(k) for k in ("comments", "sidebar", "advert", "form", "notice", "footer") if self.chance(0.5)]
        head = f"<head><title>{self.words(1, 8, 0)}</title><script>var a='<p>';</script><style>p{{}}</style></head>"
        return f"<!DOCTYPE html><html>{head}<body>{''.join(before)}{article}{''.join(after)}</body></html>"


def labelled_pages(n: int = LABELLED, seed: int = 5) -> list[tuple[list[Block], list[bool]]]:
    maker = _Maker(seed)
    pages = []
    for _ in range(n):
        blocks = leaf_blocks(maker.page())
        labels = [maker.MARK in b.text for b in blocks]
        pages.append(([replace(b, text=b.text.replace(maker.MARK, "")) for b in blocks], labels))
    return [(blocks, labels) for blocks, labels in pages if blocks and all(b.text for b in blocks)]


@cache
def default_field() -> Field:
    return train(labelled_pages())


def main_text(html: str, field: Field) -> str:
    blocks = leaf_blocks(html, field.known)
    return "\n".join(b.text for b, keep in zip(blocks, field.decode(blocks)) if keep)


def extract(pages: DataFrame, html: str = "html", field: Field | None = None) -> DataFrame:
    """All rows and columns with ``text`` and ``n_chars``.  Narrow."""
    trained = field or default_field()
    tucked = Tucked(pages)
    at = tucked.names.index(html)
    schema = tucked.frame.withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, at, BATCH_BYTES):
            texts = [main_text(h, trained) for h in batch.column(at).fill_null("").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=schema.names,
            )

    found = tucked.frame.mapInArrow(read, schema)
    return found.select(*tucked.back("text", "n_chars"), "text", "n_chars")
