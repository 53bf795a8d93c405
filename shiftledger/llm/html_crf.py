"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page is a chain of leaf blocks. Each block has features from its ancestors (tags, words
of class, id and role, and which of them is nearest) and from its text (length, links,
marks, capitals). Two labels, article and other; weights of features and of label pairs are
trained by stochastic gradient steps on the log likelihood (forward-backward), and a page is
decoded by Viterbi. The blocks labelled article, joined by one space, are the main text.

Training pages: a bounded sample of `pages` (`sample` smallest hashes) that mark their
article by an article or main element, labelled by it; and pages composed from a fixed seed
with many layouts and known labels, so pages without such elements are covered too.

Null or empty html, or none but hidden text: empty text. Equal rows give equal rows. Null
ids and urls are passed on. Empty table: no rows. Very long pages are one row's work, linear
in their length.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.html_blocks import Block, Place, blocks

SAMPLE = 300
COMPOSED = 500
EPOCHS = 6
DEEPEST = 200  # elements around a block of a training page
SEED = 20240117

# Words that layouts use in class, id and role names.
GROUPS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pager pagination tabs skip",
    "head": "header masthead banner topbar logo branding",
    "foot": "footer copyright colophon legal bottom",
    "side": "sidebar aside widget rail related recommended trending popular complementary tags",
    "advert": "ad ads advert advertisement advertising sponsor sponsored promo promotion adsense dfp",
    "notice": "cookie cookies consent gdpr notice alert newsletter subscribe popup modal overlay toast paywall disclaimer",
    "form": "form search login signup contact",
    "comment": "comment comments reply replies respond discussion disqus feedback review reviews",
    "share": "share sharing social follow byline meta author",
    "article": "article content post entry story body text main page prose",
}
_GROUP = {w: g for g, words in GROUPS.items() for w in words.split()}
_TAG_GROUP = {"nav": "menu", "menu": "menu", "header": "head", "footer": "foot", "aside": "side", "form": "form", "article": "article", "main": "article"}


def _size(n: int) -> int:
    return min(n.bit_length(), 12)


def _own_features(place: Place) -> tuple[list[str], str]:
    """Features that an element gives to the blocks below it, and its group of layout words."""
    found, group = [f"in={place.tag}"], _TAG_GROUP.get(place.tag)
    for w in place.names:
        found.append(f"name={w}")
        g = _GROUP.get(w)
        if g:
            found.append(f"group={g}")
            group = g if group in (None, "article") else group
    if group:
        found.append(f"tags={group}")
    return found, group or ""


def settle(chain: list[Block]) -> list[Place]:
    """The places of a chain, parents first, each with the features that its ancestors lack.

    Blocks come in page order, so the places of neighbours differ at their inner end only;
    each place is met once, whatever its depth.
    """
    out: list[Place] = []
    path: list[Place] = []
    held: dict[str, int] = {}
    depths: dict[int, int] = {}
    for b in chain:
        if b.place is None:
            continue
        fresh = []
        at: Place | None = b.place
        while at is not None and id(at) not in depths:
            fresh.append(at)
            at = at.parent
        keep = depths[id(at)] + 1 if at is not None else 0
        while len(path) > keep:  # left for good: page order does not come back to them
            for f in path.pop().new:
                del held[f]
        for place in reversed(fresh):
            own, group = _own_features(place)
            place.new = tuple(f for f in dict.fromkeys(own) if f not in held)
            held.update(dict.fromkeys(place.new, 1))
            place.near = group or (place.parent.near if place.parent else "")
            depths[id(place)] = len(path)
            path.append(place)
            out.append(place)
    return out


def place_ends(place: Place | None) -> list[str]:
    """The features that an innermost place does not pass on."""
    return ["bias", f"tag={place.tag if place else ''}", f"near={place.near if place else ''}"]


def place_features(place: Place | None) -> list[str]:
    """All features of a block's ancestors; settle() has set them."""
    own = [f for x in reversed(list(place.up())) for f in x.new] if place else []
    return place_ends(place) + own


def text_features(b: Block, first: bool, last: bool) -> list[str]:
    t = b.text
    return [
        f"words={_size(t.count(' ') + 1)}",
        f"linked={min(4, 4 * b.linked // max(1, len(t)))}",
        f"stops={min(3, t.count('. ') + t.count(', '))}",
        f"last={t[-1] if not t[-1].isalnum() else 'x'}",
        f"copy={'©' in t}",
        f"first={first}",
        f"end={last}",
    ]


def features(chain: list[Block]) -> list[list[str]]:
    settle(chain)
    end = len(chain) - 1
    return [place_features(b.place) + text_features(b, i == 0, i == end) for i, b in enumerate(chain)]


class Chain:
    """Weights: of each feature and label, of label pairs, of first and last labels."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, step: np.ndarray) -> None:
        self.index, self.emit, self.step = index, emit, step
        self.pairs: dict[str, tuple[float, float]] = {}

    def places(self, chain: list[Block]) -> list[np.ndarray]:
        get = self.index.get
        return [np.array([j for f in fs if (j := get(f)) is not None], np.int64) for fs in features(chain)]

    def scores(self, places: list[np.ndarray]) -> np.ndarray:
        return np.array([self.emit[p].sum(0) for p in places]).reshape(-1, 2)

    def _sum(self, found: Iterable[str]) -> tuple[float, float]:
        a = b = 0.0
        for f in found:
            x, y = self.pairs.get(f, (0.0, 0.0))
            a, b = a + x, b + y
        return a, b

    def emissions(self, chain: list[Block]) -> list[tuple[float, float]]:
        if not self.pairs:
            rows = self.emit.tolist()
            self.pairs = {f: tuple(rows[i]) for f, i in self.index.items()}
        for place in settle(chain):
            x, y = self._sum(place.new)
            a, b = place.parent.kept if place.parent else (0.0, 0.0)
            place.kept = a + x, b + y
        out, end = [], len(chain) - 1
        for i, b in enumerate(chain):
            p, q = b.place.kept if b.place else (0.0, 0.0)
            x, y = self._sum(place_ends(b.place) + text_features(b, i == 0, i == end))
            out.append((p + x, q + y))
        return out

    def decode(self, chain: list[Block]) -> list[int]:
        """Viterbi: the best label sequence; equal scores go to the lower label."""
        if not chain:
            return []
        (s00, s01), (s10, s11) = self.step.tolist()
        back, (a, b) = [], (0.0, 0.0)
        for i, (e0, e1) in enumerate(self.emissions(chain)):
            if i == 0:
                a, b = e0, e1
                continue
            from0 = (a + s00) >= (b + s10)
            from1 = (a + s01) >= (b + s11)
            a, b = (a + s00 if from0 else b + s10) + e0, (a + s01 if from1 else b + s11) + e1
            back.append((0 if from0 else 1, 0 if from1 else 1))
        label = 0 if a >= b else 1
        out = [label]
        for pair in reversed(back):
            label = pair[label]
            out.append(label)
        return out[::-1]

    def text(self, page: str | None) -> str:
        chain = blocks(page)
        return " ".join(b.text for b, y in zip(chain, self.decode(chain)) if y)


def _marginals(e: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(e)
    fore, back = np.zeros((n, 2)), np.zeros((n, 2))
    fore[0] = e[0]
    for i in range(1, n):
        x = fore[i - 1][:, None] + step
        fore[i] = np.logaddexp(x[0], x[1]) + e[i]
    for i in range(n - 2, -1, -1):
        x = step + (e[i + 1] + back[i + 1])[None, :]
        back[i] = np.logaddexp(x[:, 0], x[:, 1])
    total = np.logaddexp(*fore[-1])
    one = np.exp(fore + back - total)
    two = np.zeros((2, 2))
    for i in range(1, n):
        two += np.exp(fore[i - 1][:, None] + step + (e[i] + back[i])[None, :] - total)
    return one, two


def fit(pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, l2: float = 1e-4) -> Chain:
    """Steps with per-weight rates on each page's log likelihood, in a seeded order."""
    index: dict[str, int] = {}
    for chain, _ in pages:
        for fs in features(chain):
            for f in fs:
                index.setdefault(f, len(index))
    model = Chain(index, np.zeros((len(index), 2)), np.zeros((2, 2)))
    seen_e, seen_s = np.full((len(index), 2), 1e-2), np.full((2, 2), 1e-2)
    ready = [(model.places(chain), np.array(y)) for chain, y in pages if chain]
    order = random.Random(SEED)
    for _ in range(epochs):
        order.shuffle(ready)
        for places, y in ready:
            one, two = _marginals(model.scores(places), model.step)
            grad = np.zeros_like(model.emit)
            for i, p in enumerate(places):
                g = -one[i]
                g[y[i]] += 1
                grad[p] += g
            real = np.zeros((2, 2))
            np.add.at(real, (y[:-1], y[1:]), 1)
            at = np.unique(np.concatenate(places))
            g = grad[at] - l2 * model.emit[at]
            seen_e[at] += g * g
            model.emit[at] += rate * g / np.sqrt(seen_e[at])
            g = real - two - l2 * model.step
            seen_s += g * g
            model.step += rate * g / np.sqrt(seen_s)
    return model


def marked(page: str | None) -> tuple[list[Block], list[int]] | None:
    """A page's blocks labelled by its article or main element; none where it has no such, or
    where elements lie more than DEEPEST deep (a training page's features are listed in full)."""
    chain = blocks(page)
    other = {"menu", "head", "foot", "side", "advert", "notice", "form", "comment", "share"}
    inside: dict[int, bool] = {}
    found, depth = False, {}
    for place in settle(chain):
        up = place.parent
        depth[id(place)] = depth[id(up)] + 1 if up else 1
        held = inside[id(up)] if up else False
        if place.tag in ("article", "main"):
            found = held = True
        elif held and (_TAG_GROUP.get(place.tag) in other or any(_GROUP.get(w) in other for w in place.names)):
            held = False
        inside[id(place)] = held
    if not found or max(depth.values()) > DEEPEST:
        return None
    return chain, [int(b.place is not None and inside[id(b.place)]) for b in chain]


_MARK = "\x01"  # before each text of a composed page that belongs to its article


def composed(count: int = COMPOSED, seed: int = SEED) -> Iterator[tuple[list[Block], list[int]]]:
    """Pages of many layouts with known labels."""
    r = random.Random(seed)
    syllables = "an be ci do er fu ga hi in jo ka lu me no or pa que ri so ti un va we za".split()

    def word() -> str:
        return "".join(r.choices(syllables, k=r.randint(1, 4)))

    def prose(low: int, high: int) -> str:
        out = [word() + ("," if r.random() < 0.1 else ". " + word().title() if r.random() < 0.1 else "") for _ in range(r.randint(low, high))]
        return " ".join(out).capitalize() + r.choice("....!?")

    def named(tag: str, group: str, inner: str) -> str:
        if tag in ("div", "section", "ul") or r.random() < 0.3:
            key = r.choice(["class", "class", "id"])
            name = r.choice(GROUPS[group].split())
            name = r.choice([name, name, f"{name}-{r.choice(['box', 'wrap', 'inner', 'list', '1'])}", f"site-{name}"])
            return f'<{tag} {key}="{name}">{inner}</{tag}>'
        return f"<{tag}>{inner}</{tag}>"

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{word()}">{prose(1, 3)[:-1]}</a></li>' for _ in range(n)) + "</ul>"

    def other(group: str) -> str:
        if group == "menu":
            return named(r.choice(["nav", "div"]), group, links(r.randint(2, 8)))
        if group == "head":
            return named(r.choice(["header", "div"]), group, f"<a href='/'>{prose(1, 3)}</a>" + r.choice(["", f"<p>{prose(2, 8)}</p>"]))
        if group == "foot":
            return named(r.choice(["footer", "div"]), group, f"&copy; {word()}.example &middot; {prose(3, 10)}")
        if group == "side":
            return named(r.choice(["aside", "div"]), group, f"<h3>{prose(1, 3)}</h3>" + r.choice([links(4), f"<p>{prose(5, 25)}</p>"]))
        if group == "advert":
            return named(r.choice(["div", "aside"]), group, r.choice([prose(4, 14), f"<p>{prose(4, 20)}</p>"]))
        if group == "notice":
            return named("div", group, f"<p>{prose(5, 25)}</p><button>{word()}</button>")
        if group == "form":
            return f"<form action='/{word()}'><label>{prose(1, 4)}</label><input name='{word()}'><p>{prose(2, 8)}</p></form>"
        if group == "comment":
            return named(r.choice(["div", "section"]), group, f"<h3>{prose(1, 3)}</h3>" + "".join(f"<{t}>{prose(3, 30)}</{t}>" for t in r.choices(["p", "li", "div"], k=r.randint(1, 5))))
        return named("div", "share", links(r.randint(1, 4)))

    def article() -> str:
        parts = [f"<h1>{_MARK}{prose(2, 10)}</h1>"]
        for _ in range(r.randint(1, 12)):
            kind = r.random()
            text = _MARK + prose(r.choice([1, 5, 20]), r.choice([20, 60, 200]))
            if kind < 0.7:
                text = text if r.random() < 0.7 else f"{text} <a href='/x'>{word()}</a> <b>{word()}</b>"
                parts.append(f"<p>{text}</p>" if r.random() < 0.8 else f"<p><b>{text}<br>")
            elif kind < 0.8:
                parts.append(f"<h2>{_MARK}{prose(1, 6)[:-1]}</h2>")
            elif kind < 0.9:
                parts.append("<ul>" + "".join(f"<li>{_MARK}{prose(2, 15)}</li>" for _ in range(3)) + "</ul>")
            else:
                parts.append(f"<blockquote>{text}</blockquote>")
            if r.random() < 0.05:
                parts.append(other(r.choice(["advert", "share", "notice"])))
        inner = "".join(parts)
        shape = r.random()
        if shape < 0.35:
            return f"<article>{inner}{other('comment') if r.random() < 0.15 else ''}</article>"
        if shape < 0.55:
            return f"<main>{inner}</main>"
        if shape < 0.95:
            return named(r.choice(["div", "section"]), "article", inner)
        return f"<div>{inner}</div>"

    for _ in range(count):
        first = [g for g in ("notice", "head", "menu", "form", "advert") if r.random() < 0.5]
        last = [g for g in ("side", "advert", "share", "comment", "form", "foot", "notice") if r.random() < 0.5]
        body = "".join(map(other, first)) + article() + "".join(map(other, last))
        chain = blocks(f"<html><head><title>x</title></head><body>{body}</body></html>")
        labels = [int(_MARK in b.text) for b in chain]
        yield [b._replace(text=b.text.replace(_MARK, "").strip() or "x") for b in chain], labels


def train(pages: DataFrame, sample: int = SAMPLE) -> Chain:
    """Train in one task on the bounded sample; the model has as many weights as features seen."""
    # ids first, so that only the chosen pages' html is moved; of several pages of one id the least
    ids = pages.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    html = pages.select("page_id", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    chosen = html.join(ids, "page_id").groupBy("page_id").agg(F.min("html").alias("html"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [x for batch in batches for page in batch.column(1).to_pylist() if (x := marked(page))]
        model = fit(known + list(composed()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(model.index)), *(pa.array(model.emit[:, k]) for k in (0, 1)),
             pa.array([model.step.ravel().tolist()] * len(model.index))],
            names=["feature", "other", "article", "step"],
        )

    # one row without a page, so the task runs on an empty table too
    none = pages.sparkSession.range(1).select(
        F.lit(None).cast(chosen.schema["page_id"].dataType).alias("page_id"), F.lit(None).cast("string").alias("html")
    )
    rows = chosen.unionByName(none).repartition(1).mapInArrow(learn, "feature string, other double, article double, step array<double>").collect()
    return Chain(
        {x["feature"]: i for i, x in enumerate(rows)},
        np.array([[x["other"], x["article"]] for x in rows]),
        np.array(rows[0]["step"]).reshape(2, 2),
    )


def extract(pages: DataFrame, model: Chain) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row."""
    shared = pages.sparkSession.sparkContext.broadcast((model.index, model.emit, model.step))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(*shared.value)
        for batch in batches:
            texts = [chain.text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
