"""Main text of web pages by gradient-boosted trees over DOM nodes.

Every node gets features of its own (tag, attribute words), of its subtree (text, link
and tag density), of its place (depth, position, siblings) and of the nodes above it.
Boosted trees give each node log-odds of belonging to the article, and a pass from the
leaves up picks the likeliest choice of nodes in which no node is kept below one that is
dropped. There are no labelled pages, so the trees are trained on generated ones: page
layouts drawn at random from a list of usual parts, whose article is known. The number
of these pages is a parameter.
"""

from __future__ import annotations

import functools
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.boosting import Boosted
from headway.llm.common import ready
from headway.llm.dom import BLOCKS, RAW, Node, blocks, parse

TRAINING_PAGES = 500
TAGS = (
    "nav header footer aside article main section div p h1 h2 h3 h4 ul ol li a span form table tr td"
    " blockquote pre figure figcaption img input button select label title head body html dialog"
).split()
#: Words of class, id and role attributes, by what they tell.
WORDS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toc skip",
    "head": "header masthead banner topbar logo branding",
    "foot": "footer foot copyright legal colophon contentinfo",
    "side": "sidebar side aside rail widget widgets complementary secondary",
    "more": "related recommended recommendations more popular trending tags teaser promo promoted outbrain taboola",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored adsbygoogle dfp commercial",
    "talk": "comment comments commentlist respond reply replies discussion disqus responses",
    "form": "form login signin signup subscribe subscription newsletter search contact",
    "notice": "cookie cookies consent notice notices alert gdpr privacy popup modal overlay dialog message warning",
    "share": "share sharing social follow twitter facebook",
    "meta": "meta byline author date timestamp caption credit",
    "main": "article content post entry story main body text maincontent articlebody hentry page",
    "hidden": "hidden none invisible sr-only",
}
_GROUP = {w: i for i, words in enumerate(WORDS.values()) for w in words.split()}
_SPLIT = re.compile(r"[^a-z]+")
_TAG = {t: i for i, t in enumerate(TAGS)}
_NEVER = RAW | {"head", "input", "select", "button", "img", "link", "meta"}


@functools.lru_cache(maxsize=50_000)
def _groups(attributes: str) -> int:
    found = 0
    for word in _SPLIT.split(attributes):
        group = _GROUP.get(word)
        if group is not None:
            found |= 1 << group
    return found


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node."""
    n, groups = len(nodes), len(WORDS)
    text, links, tags, paragraphs, commas, forms = (np.zeros(n) for _ in range(6))
    own = np.zeros(n)
    parent = np.array([x.parent.number if x.parent else -1 for x in nodes])
    position = np.zeros(n)
    passed = 0
    for node in nodes:
        i = node.number
        for item in node.items:
            if isinstance(item, str):
                size = len(item) - item.count(" ") // 2
                if item.isspace():
                    continue
                own[i] += size
                commas[i] += item.count(",") + item.count(".")
        position[i] = passed
        passed += own[i]
    text += own
    for i in range(n - 1, 0, -1):
        p, tag = parent[i], nodes[i].tag
        if tag == "a":
            links[i] = text[i]
        tags[p] += tags[i] + 1
        text[p] += text[i]
        links[p] += links[i]
        commas[p] += commas[i]
        paragraphs[p] += paragraphs[i] + (tag == "p" and text[i] > 0)
        forms[p] += forms[i] + (tag in ("input", "select", "button", "textarea", "form"))
    total = max(text[0], 1.0)
    words = np.array([_groups(x.attributes) for x in nodes])
    above, tags_above = np.zeros(n, np.int64), np.zeros(n, np.int64)
    nth, count = np.zeros(n), np.zeros(n)
    seen: dict[int, int] = {}
    for node in nodes[1:]:
        i, p = node.number, parent[node.number]
        above[i] = above[p] | words[p]
        tags_above[i] = tags_above[p] | (1 << _TAG[nodes[p].tag] if nodes[p].tag in _TAG else 0)
        nth[i] = seen.get(p, 0)
        seen[p] = seen.get(p, 0) + 1
    for i in range(1, n):
        count[i] = seen[parent[i]]
    up = np.maximum(parent, 0)
    tag = np.array([_TAG.get(x.tag, -1) for x in nodes])
    columns = [
        *((words >> g & 1) for g in range(groups)),
        *((above >> g & 1) for g in range(groups)),
        *((tag == t) for t in range(len(TAGS))),
        *((tags_above >> _TAG[t] & 1) for t in "nav header footer aside article main form ul table p".split()),
        np.array([x.depth for x in nodes]),
        np.log1p(text), np.log1p(own), links / np.maximum(text, 1), tags / np.maximum(text, 1) * 100,
        text / total, np.log1p(paragraphs), commas / np.maximum(text, 1) * 100, np.log1p(forms),
        position / total, nth, count, nth / np.maximum(count, 1), np.log1p(text[up]),
        links[up] / np.maximum(text[up], 1), text / np.maximum(text[up], 1), np.log1p(paragraphs[up]),
    ]
    return np.stack([np.asarray(c, dtype=np.float64) for c in columns], axis=1)


def decode(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the likeliest choice without a kept node below a dropped one."""
    n = len(nodes)
    yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    kept_gain, drop = yes.copy(), no.copy()
    for i in range(n - 1, 0, -1):
        if nodes[i].tag in _NEVER:
            kept_gain[i] = -math.inf
        p = nodes[i].parent.number
        drop[p] += drop[i]
        kept_gain[p] += max(kept_gain[i], drop[i])
    out = np.zeros(n, dtype=bool)
    out[0] = True
    for i in range(1, n):
        out[i] = out[nodes[i].parent.number] and kept_gain[i] >= drop[i]
    return out


# --- generated pages -------------------------------------------------------------------


def _sentence(r: random.Random, least: int, most: int) -> str:
    syllables = "an the re on ti ver ka lo mi sur eau que ch el os ra den st ung io".split()
    words = ["".join(r.choices(syllables, k=r.choice((1, 1, 2, 2, 3, 4)))) for _ in range(r.randint(least, most))]
    if len(words) > 8:
        for _ in range(len(words) // 12):
            words[r.randrange(len(words))] += ","
    return (" ".join(words)).capitalize() + "."


def _prose(r: random.Random) -> str:
    text = " ".join(_sentence(r, 4, 22) for _ in range(r.choice((1, 1, 2, 3, 4, 6))))
    if r.random() < 0.1:
        text = r.choice((text.upper(), text.replace(" ", "### "), text.replace(" ", " | ")))
    if r.random() < 0.08:
        text = _sentence(r, 1, 2)
    if r.random() < 0.25:
        words = text.split(" ")
        at = r.randrange(len(words))
        words[at] = r.choice(("<b>%s</b>", "<em>%s</em>", '<a href="/x">%s</a>', "<span>%s</span>", "<b>%s")) % words[at]
        text = " ".join(words)
    return text


def _name(r: random.Random, group: str) -> str:
    word = r.choice(WORDS[group].split())
    word = r.choice((word, word, f"site-{word}", f"{word}-box", f"{word} clearfix", f"main-{word}" if group != "main" else word))
    return r.choice(("class", "class", "id")) + f'="{word}"'


def _links(r: random.Random, n: int) -> str:
    kind = r.choice(("ul", "ul", "div", "p"))
    items = [f'<a href="/{i}">{_sentence(r, 1, 3)[:-1]}</a>' for i in range(n)]
    if kind == "ul":
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
    return f"<{kind}>" + r.choice((" | ", " ")).join(items) + f"</{kind}>"


def _noise(r: random.Random, group: str) -> str:
    """A part that is not of the article, marked so: ``data-no`` goes before parsing."""
    tag, inner = "div", ""
    if group == "menu":
        tag, inner = r.choice(("nav", "nav", "div", "ul")), _links(r, r.randint(2, 12))
    elif group == "head":
        tag = r.choice(("header", "header", "div"))
        inner = r.choice(("", f"<h1>{_sentence(r, 1, 4)[:-1]}</h1>", f"<p>{_sentence(r, 2, 8)}</p>")) + _links(r, r.randint(1, 5))
    elif group == "foot":
        tag = r.choice(("footer", "footer", "div"))
        inner = r.choice(("&copy; ", "")) + _sentence(r, 2, 30) + r.choice(("", _links(r, 4)))
    elif group in ("side", "more"):
        tag = r.choice(("aside", "div", "section"))
        inner = f"<h3>{_sentence(r, 1, 4)[:-1]}</h3>" + r.choice((_links(r, 5), f"<p>{_sentence(r, 5, 40)}</p>"))
    elif group == "advert":
        tag, inner = r.choice(("div", "div", "ins", "aside", "section")), r.choice((_sentence(r, 2, 30), f"<p>{_sentence(r, 3, 30)}</p>"))
    elif group == "talk":
        tag = r.choice(("section", "div", "ol"))
        one = r.choice(("li", "div", "article")) if tag != "ol" else "li"
        inner = "".join(
            f'<{one} class="comment"><p>{_prose(r)}</p></{one}>' for _ in range(r.randint(1, 6))
        )
        if r.random() < 0.5:
            inner = f"<h3>{_sentence(r, 1, 2)[:-1]}</h3>" + inner
    elif group == "form":
        tag = r.choice(("form", "form", "div"))
        body = f"<label>{_sentence(r, 1, 3)}</label><input name=q><button>{_sentence(r, 1, 2)}</button>"
        inner = r.choice((body, f"<p>{_sentence(r, 3, 20)}</p>{body}"))
        if tag == "div":
            inner = f"<form>{inner}</form>"
    else:
        tag = r.choice(("div", "div", "section", "aside", "p"))
        inner = r.choice((_sentence(r, 3, 30), f"<p>{_sentence(r, 3, 30)}</p>")) if tag != "p" else _sentence(r, 3, 30)
        if group == "share":
            inner = _links(r, 3) if tag != "p" else _sentence(r, 1, 4)
    bare = {"nav", "header", "footer", "aside", "form"}
    name = "" if tag in bare and r.random() < 0.5 else " " + _name(r, group)
    return f"<{tag} data-no{name}>{inner}</{tag}>"


def _article(r: random.Random) -> str:
    parts = [f"<h1>{_sentence(r, 1, 12)[:-1]}</h1>"] if r.random() < 0.85 else []
    if parts and r.random() < 0.15:
        parts = [f"<header>{parts[0]}</header>"]
    for _ in range(r.choice((1, 1, 2, 3, 5, 8, 14, 25))):
        x, end = r.random(), r.choice(("</p>", "</p>", "</p>", "", "<br></p>"))
        if x < 0.78:
            parts.append(f"<p>{_prose(r)}{end}")
        elif x < 0.85:
            parts.append(f"<h2>{_sentence(r, 1, 8)[:-1]}</h2>")
        elif x < 0.9:
            parts.append("<ul>" + "".join(f"<li>{_sentence(r, 2, 15)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
        elif x < 0.94:
            parts.append(f"<blockquote><p>{_prose(r)}</p></blockquote>")
        elif x < 0.97:
            parts.append(f"<div>{_prose(r)}</div>")
        else:
            parts.append(f"<pre>{_sentence(r, 3, 12)}</pre>")
    if r.random() < 0.35:
        group = r.choice(("advert", "advert", "share", "more", "notice", "form"))
        parts.insert(r.randint(0, len(parts)), _noise(r, group))
    inner = "".join(parts)
    how = r.choice(("article", "article", "article", "main", "div", "section", "nested", "bare", "td"))
    name = " " + _name(r, "main") if r.random() < 0.7 or how in ("div", "section") else ""
    if how == "nested":
        return f'<main><div{name}><article>{inner}</article></div></main>'
    if how == "bare":
        return f"<div>{inner}</div>"
    if how == "td":
        return f"<table><tr><td data-no>{_links(r, 4)}</td><td{name}>{inner}</td></tr></table>"
    return f"<{how}{name}>{inner}</{how}>"


def generated(r: random.Random) -> str:
    """A page whose parts outside the article carry the bare attribute ``data-no``."""
    before = [g for g in ("head", "menu", "notice", "advert", "form", "side") if r.random() < 0.45]
    after = [g for g in ("share", "advert", "more", "talk", "form", "side", "notice", "foot") if r.random() < 0.4]
    r.shuffle(before)
    r.shuffle(after)
    body = "".join(_noise(r, g) for g in before) + _article(r) + "".join(_noise(r, g) for g in after)
    if r.random() < 0.3:
        body = f'<div id="{r.choice(("page", "wrapper", "container"))}">{body}</div>'
    end = r.choice(("</body></html>", "", "</body></html>"))
    return (
        f"<!DOCTYPE html><html><head><title>{_sentence(r, 1, 9)}</title><style>p{{margin:0}}</style>"
        f"<script>var a='</p>';</script></head><body>{body}{end}"
    )


def training(pages: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r, x, y = random.Random(seed), [], []
    for _ in range(pages):
        marked = parse(generated(r).replace(" data-no", " hidden").replace("hidden class", "hidden class"))
        marks = ["hidden" in n.attributes.split() for n in marked]
        for n in marked:
            n.attributes = " ".join(w for w in n.attributes.split() if w != "hidden")
        no = np.zeros(len(marked), dtype=bool)
        for i, n in enumerate(marked):
            no[i] = marks[i] or n.tag in _NEVER or (n.parent is not None and no[n.parent.number])
        x.append(features(marked))
        y.append(~no)
    return np.concatenate(x), np.concatenate(y).astype(float)


@functools.lru_cache(maxsize=4)
def model(pages: int = TRAINING_PAGES, seed: int = 7) -> Boosted:
    """Trees trained on so many generated pages; the same for the same arguments."""
    return Boosted().fit(*training(pages, seed))


def extract(pages: DataFrame, trees: Boosted | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row.

    The text is that of the blocks of the article, in page order, a line each: white
    space inside a block is one space, character references are decoded, nothing else is
    changed. Null and empty pages, and pages without any text of an article, have an
    empty text. Rows are worked on by themselves, so repeated rows give equal results.
    """
    ready(pages.sparkSession)
    trees = trees or model()

    def each(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for at in range(0, frame.num_rows, 64):
                part = frame.slice(at, 64)
                parsed = [parse(p) for p in part.column(2).to_pylist()]
                odds = trees.predict(np.concatenate([features(p) for p in parsed]))
                ends = np.cumsum([len(p) for p in parsed])
                texts = [
                    "\n".join(blocks(p, decode(p, odds[e - len(p) : e])))
                    for p, e in zip(parsed, ends.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).mapInArrow(
        each, "page_id bigint, url string, text string, n_chars bigint"
    )
