"""Main text of web pages: boosted trees over the features of block elements, then one consistent choice for the whole tree.

Every block element is a frame (it stands around the article), a part of the article, or something else (menus, headers,
footers, sidebars, notices, adverts, forms, comments). Trees score the three for each element by its subtree's density (text,
links, punctuation, paragraphs, controls), the tokens of its tag and attributes and of those above it, its depth, its place
and its siblings. The decoding takes the best-scored labelling in which an article's elements have only article or other
elements below them and nothing below a dropped element is kept, so an ancestor never contradicts a descendant.

The trees are trained on the driver on at most TRAIN_PAGES built pages (page_samples) with the text of as many sampled pages
of the table, of at most SAMPLE_CHARS characters each; the sample are the pages with the smallest hashes, so it does not depend
on partitioning. Pages are then read and decoded whole, each where it lies: no shuffle, memory for a batch of pages.

Defined results: null or empty html gives an empty text; a page without an article gives an empty text; blocks are trimmed,
white space in them is one space and character references are decoded; text outside every element but the page itself
belongs to no block. Rows are independent: null or repeated ids and urls are passed on. An empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.llm import page_samples, store
from triplake.llm.boosted_trees import BoostedTrees
from triplake.llm.dom import CONTROLS, HEADINGS, Pages, attributes

TRAIN_PAGES = 600
SAMPLE_PAGES = 200
SAMPLE_CHARS = 50_000
SEED = 13
BATCH_CHARS = 4_000_000  # of html read before its elements are decoded
FRAME, ARTICLE, OTHER = 0, 1, 2

_TOKENS = re.compile(r"[a-z]+|[A-Z][a-z]*")
_NAMING = ("class", "id", "role", "itemprop", "itemtype", "aria-label", "rel", "data-component", "data-testid")


def tokens(tag: str, raw: str) -> list[str]:
    """``tag:`` and ``at:`` tokens of an element: its tag and the words in its naming attributes."""
    values = attributes(raw) if raw else {}
    words = {w.lower() for name in _NAMING if name in values for w in _TOKENS.findall(values[name]) if len(w) > 1}
    return [f"tag:{tag}", *(f"at:{w}" for w in sorted(words))]


class Extractor:
    """Token weights and trees; small arrays that travel with a task."""

    def __init__(self, weights: dict[str, tuple[float, float]], trees: BoostedTrees | None = None) -> None:
        self.weights, self.trees, self._known = weights, trees, {}

    def _scores(self, tag: str, raw: str) -> tuple[float, float, float, float]:
        key = (tag, raw)
        if key not in self._known:
            if len(self._known) > 50_000:
                self._known.clear()
            first, *rest = [self.weights.get(t, (0.0, 0.0)) for t in tokens(tag, raw)]
            self._known[key] = (*first, sum(w[0] for w in rest), sum(w[1] for w in rest))
        return self._known[key]

    def features(self, p: Pages) -> np.ndarray:
        n = len(p.tag)
        parent, end = np.array(p.parent), np.array(p.end)
        depth, place, before = np.array(p.depth), np.array(p.place), np.array(p.before)
        page = np.array(p.page)
        up = np.maximum(parent, 0)
        own = {k: np.array(v, float) for k, v in p.counts.items()}
        own["paragraphs"] = np.array([t == "p" for t in p.tag], float)
        own["paragraph_chars"] = own["paragraphs"] * own["chars"]
        own["headings"] = np.array([t in HEADINGS for t in p.tag], float)
        own["elements"] = np.ones(n)
        own["controls"] += np.array([t in CONTROLS or t == "form" for t in p.tag], float)
        sub = {}
        for k, v in own.items():
            sums = np.concatenate([[0.0], np.cumsum(v)])
            sub[k] = sums[end] - sums[:-1]
        root = np.flatnonzero(parent < 0)[page]
        scores = np.array([self._scores(t, a) for t, a in zip(p.tag, p.attributes)], float).reshape(n, 4)
        path = scores.copy()  # the strongest weights on the way from the root
        for d in range(1, int(depth.max(initial=0)) + 1):
            at = np.flatnonzero(depth == d) if d < 64 else np.flatnonzero(depth >= d)
            if d < 64:
                path[at] = np.maximum(path[at], path[parent[at]])
            else:  # deep pages: parents come first in the list
                for k in at.tolist():
                    path[k] = np.maximum(path[k], path[parent[k]])
                break
        chars = sub["chars"]
        siblings = np.bincount(up[parent >= 0], minlength=n)[up]
        blocks_above = sub["elements"][up]
        prefix = np.concatenate([[0.0], np.cumsum(own["chars"])])
        whole = np.maximum(chars[root], 1)
        density = sub["link_chars"] / np.maximum(chars, 1)
        previous = np.maximum(before, 0)
        following = np.full(n, -1)
        following[before[before >= 0]] = np.flatnonzero(before >= 0)
        largest = np.zeros(n)
        np.maximum.at(largest, up[parent >= 0], chars[parent >= 0])
        columns = [
            scores[:, 0], scores[:, 1], scores[:, 2], scores[:, 3], path[:, 0], path[:, 1], path[:, 2], path[:, 3],
            scores[up, 0], scores[up, 1], scores[up, 2], scores[up, 3],
            depth, np.log1p(chars), chars / whole, chars / np.maximum(chars[up], 1), chars[up] / whole,
            density, density[up], np.where(before >= 0, density[previous], -1), np.where(following >= 0, density[following], -1),
            np.log1p(sub["elements"]), chars / sub["elements"], np.log1p(sub["paragraphs"]), np.log1p(sub["paragraphs"][up]),
            sub["paragraph_chars"] / np.maximum(chars, 1), sub["points"] / np.maximum(chars, 1), sub["points"][up] / np.maximum(chars[up], 1),
            chars / np.maximum(sub["blocks"], 1), sub["headings"], sub["headings"][up], sub["controls"], sub["controls"][up],
            sub["inlines"] / np.maximum(sub["elements"], 1), place, siblings, place / np.maximum(siblings, 1),
            (prefix[:-1] - prefix[root]) / whole, (prefix[end] - prefix[root]) / whole,
            largest / np.maximum(chars, 1), largest[up] / np.maximum(chars[up], 1), np.log1p(blocks_above), own["chars"] / np.maximum(chars, 1),
            np.where(before >= 0, np.log1p(chars[previous]), -1), np.where(following >= 0, np.log1p(chars[following]), -1),
        ]
        return np.column_stack(columns).astype(np.float32)

    def labels(self, p: Pages) -> np.ndarray:
        """The best consistent label of every element."""
        n = len(p.tag)
        gain = self.trees.log_probabilities(self.features(p))
        parent, depth = np.array(p.parent), np.array(p.depth)
        gain[parent < 0, ARTICLE] = gain[parent < 0, OTHER] = -1e9  # the page itself is a frame
        order = np.argsort(depth, kind="stable")
        bounds = np.searchsorted(depth[order], np.arange(int(depth.max(initial=0)) + 2))
        for d in range(len(bounds) - 2, 0, -1):
            at = order[bounds[d]:bounds[d + 1]]
            g = gain[at]
            best_ac = np.maximum(g[:, ARTICLE], g[:, OTHER])
            np.add.at(gain[:, FRAME], parent[at], np.maximum(g[:, FRAME], best_ac))
            np.add.at(gain[:, ARTICLE], parent[at], best_ac)
            np.add.at(gain[:, OTHER], parent[at], g[:, OTHER])
        out = np.zeros(n, np.int64)
        for d in range(1, len(bounds) - 1):
            at = order[bounds[d]:bounds[d + 1]]
            above, g = out[parent[at]], gain[at].copy()
            g[above != FRAME, FRAME] = -np.inf
            g[above == OTHER, ARTICLE] = -np.inf
            out[at] = g.argmax(axis=1)
        return out

    def texts(self, pages: list[str | None]) -> list[str]:
        """Main text of every page."""
        p = Pages()
        for page in pages:
            p.add(page)
        label = self.labels(p)
        out: list[list[str]] = [[] for _ in pages]
        for page, node, text in zip(p.text_page, p.text_node, p.text):
            if label[node] == ARTICLE:
                out[page].append(text)
        return ["\n\n".join(blocks) for blocks in out]


def labelled(pages: list[str]) -> tuple[Pages, np.ndarray]:
    """Built pages with the labels that their marks say; the marks are taken out."""
    p = Pages()
    for page in pages:
        p.add(page)
    label = np.zeros(len(p.tag), np.int64)
    mark = re.compile(rf'\s*{page_samples.LABEL}="([cd])"')
    for k, raw in enumerate(p.attributes):
        found = mark.search(raw)
        above = label[p.parent[k]] if p.parent[k] >= 0 else FRAME
        label[k] = {"c": ARTICLE, "d": OTHER}[found[1]] if found and above != OTHER else above
        p.attributes[k] = mark.sub("", raw) if found else raw
    return p, label


def token_weights(p: Pages, label: np.ndarray) -> dict[str, tuple[float, float]]:
    """Smoothed log odds of article and of other, by token."""
    counts: dict[str, list[int]] = {}
    for tag, raw, y in zip(p.tag, p.attributes, label.tolist()):
        for t in tokens(tag, raw):
            counts.setdefault(t, [0, 0, 0])[y] += 1
    whole = np.bincount(label, minlength=3) + 3.0
    odds = np.log(whole / (whole.sum() - whole))
    out = {}
    for t, c in sorted(counts.items()):
        n = sum(c)
        if n > 2:
            out[t] = tuple(float(np.log((c[y] + 0.5) / (n - c[y] + 0.5)) - odds[y]) for y in (ARTICLE, OTHER))
    return out


def train(texts: list[list[str]], pages: int = TRAIN_PAGES, seed: int = SEED) -> Extractor:
    """Fit on built pages with the blocks of ``texts``; half of the pages give the token weights that the rest's features use."""
    built = page_samples.training_pages(texts, pages, seed)
    half = len(built) // 2
    extractor = Extractor(token_weights(*labelled(built[:half])))
    p, label = labelled(built[half:])
    x = extractor.features(p)
    chars = np.array(p.counts["chars"], float)
    extractor.trees = BoostedTrees(3).fit(x, label, 1 + np.minimum(np.log1p(chars), 5) / 2)
    extractor._known = {}
    return extractor


def sampled_texts(df: DataFrame, html_col: str = "html", pages: int = SAMPLE_PAGES) -> list[list[str]]:
    """Blocks of a bounded sample: of the pages of at most SAMPLE_CHARS characters those with the smallest hashes."""
    html = F.col(f"`{html_col}`")
    rows = df.select(html.alias("html")).where(F.length("html").between(1, SAMPLE_CHARS)).withColumn("at", F.xxhash64("html"))
    chosen = [r.at for r in rows.select("at").distinct().orderBy("at").limit(pages).collect()]  # equal pages count once
    rows = rows.where(F.col("at").isin(chosen)).groupBy("at").agg(F.min("html").alias("html")).orderBy("at").collect()
    out = []
    for r in rows:
        p = Pages()
        p.add(r.html)
        out.append(p.text)
    return out


def extract(df: DataFrame, extractor: Extractor, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns with ``text`` and ``n_chars`` of every page."""
    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            texts: list[str] = []
            group: list[str | None] = []
            held = 0
            for value in column:
                page = value.as_py()
                group.append(page)
                held += len(page or "")
                if held > BATCH_CHARS:
                    texts += extractor.texts(group)
                    group, held = [], 0
            texts += extractor.texts(group) if group else []
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(len(keep))], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                [*[f"k{k}" for k in range(len(keep))], "text", "n_chars"])

    kept = df.select(*[F.col(f"`{c}`").alias(f"k{k}") for k, c in enumerate(keep)], F.col(f"`{html_col}`").alias("html"))
    types = dict(kept.dtypes)
    out = store.map_arrow(kept, run, ", ".join(f"k{k} {types[f'k{k}']}" for k in range(len(keep))) + ", text string, n_chars long")
    return out.select(*[F.col(f"k{k}").alias(c) for k, c in enumerate(keep)], "text", "n_chars")


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, train(sampled_texts(pages)))


# What the given pages hold: one article element of headings and paragraphs. It knows no other kind of page.
SQL = r"""
WITH blocks AS (
  SELECT k, page_id, url, i, trim(regexp_replace(regexp_replace(replace(replace(replace(
           regexp_replace(regexp_replace(block, '<br>', ' ', 'g'), '</?b>', '', 'g'),
           '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS block
  FROM (SELECT k, page_id, url, unnest(parts) AS block, generate_subscripts(parts, 1) AS i
        FROM (SELECT row_number() OVER () AS k, page_id, url,
                     string_split_regex(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'), '</?(?:p|h1)>') AS parts
              FROM pages))),
joined AS (
  SELECT k, page_id, url, coalesce(string_agg(block, chr(10) || chr(10) ORDER BY i) FILTER (WHERE block <> ''), '') AS text
  FROM blocks GROUP BY k, page_id, url)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM joined
"""

QUERIES = {"op13_html_extraction": op13_html_extraction}
ORACLE = {"op13_html_extraction": SQL}
