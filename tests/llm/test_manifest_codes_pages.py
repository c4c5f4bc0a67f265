"""The Merkle manifest, the vector codes and the page extraction against plain Python, whole trees and unseen pages."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from triplake.llm import html_extraction, merkle_manifest, page_samples, vector_codes
from triplake.llm.boosted_trees import BoostedTrees
from triplake.llm.dom import MAX_OPEN, Pages


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """(root, sibling lists of every node) of a list of digests."""
    paths = [[] for _ in nodes]
    where = list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, k in enumerate(where):
            run = nodes[k // 16 * 16:k // 16 * 16 + 16]
            paths[leaf].append(("".join(run[:k % 16]), "".join(run[k % 16 + 1:])))
        where = [k // 16 for k in where]
        nodes = [h(*nodes[k:k + 16]) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def expected_manifest(rows):
    def leaf(row):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = tree([x[2] for x in groups[name]])
    root, tops = tree([trees[n][0] for n in names])
    out = []
    for name, top in zip(names, tops):
        for (_, _, digest, row), path in zip(groups[name], trees[name][1]):
            path = path + top
            node = digest
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                node = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for left, right in path:
                node = h(left, node, right)
            out.append((row[0], digest, trees[name][0], root, h(*(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels,counts", [(1, (300, 17, 16, 1)), (2, (600, 256, 257)), (3, (20, 1)), (3, (1,)), (1, (1,) * 40)])
def test_manifest_equals_the_whole_trees(spark, monkeypatch, tmp_path, levels, counts):
    monkeypatch.setattr(merkle_manifest, "BLOCK_LEVELS", levels)
    rows = []
    for g, count in enumerate(counts):
        name = None if g == 1 else ["", "zß", "é", "Zz"][g % 4] + "x" * (g // 4)
        rows += [(k * 7 % 1000, name, "en" if k % 3 else None, None if k % 4 else k, None if k % 11 == 5 else f"Text {k} ÄB") for k in range(count)]
    rows += [(None, "", "de", 1, "N"), rows[0], rows[0], (rows[0][0], rows[0][1], None, None, "")] if len(rows) > 1 else []
    df = spark.createDataFrame([(*r, "clash", 5, [1]) for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string, leaf string, rank int, path array<int>")
    df.repartition(5).write.parquet(f"file://{tmp_path}/documents.parquet")
    got = merkle_manifest.op11_merkle_manifest(spark, f"file://{tmp_path}")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == expected_manifest(rows)


def test_manifest_finds_any_changed_column(spark):
    df = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit("en").alias("lang"),
                                F.lit(3).alias("n_chars"), F.lit("abc").alias("text"))
    for column in ("lang", "n_chars", "text"):
        rows = merkle_manifest.manifest(df, tampered={column: F.when(F.col("doc_id") == 7, F.lit(None)).otherwise(F.col(column))})
        bad = rows.where(merkle_manifest.folded(F.col("shown_leaf"), F.col("path")) != F.col("root")).collect()
        assert [r.id for r in bad] == [7]


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])),
                  key=lambda r: (r[0] is None, r[0] or 0, [int(np.floor(np.float32(x).astype(float) * 1024)) for x in r[1]]))
    if not kept:
        return []
    length = len(kept[0][1])
    fit = [r for r in kept if len(r[1]) == length and length % parts == 0]
    v = np.array([[int(np.floor(np.float32(x).astype(float) * 1024)) for x in r[1]] for r in fit]).reshape(len(fit), parts, -1)
    books = [v[:entries, p].copy() for p in range(parts)]

    def assign(p):
        d = ((v[:, p, None, :] - books[p][None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        for p in range(parts):
            best, _ = assign(p)
            for e in set(best.tolist()):
                books[p][e] = v[best == e, p].sum(axis=0) // (best == e).sum()
    best = [assign(p) for p in range(parts)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    codes = {id(r): ("".join(f"{b[k]:02x}" for b, _ in best), int(sum(e[k] for _, e in best))) for k, r in enumerate(fit)}
    labels = {}
    for r in fit:
        labels[r[2]] = labels.get(r[2], 0) + codes[id(r)][1]
    return sorted([(r[0], *codes.get(id(r), (None, None)), labels.get(r[2]), digest) for r in kept], key=str)


@pytest.mark.parametrize("n,dims,spread", [(700, 16, 1.0), (400, 8, 0.01), (30, 12, 5000.0), (3, 4, 1.0)])
def test_vector_codes_equal_plain_training(spark, tmp_path, n, dims, spread):
    r = np.random.default_rng(n)
    rows = [(int(r.integers(0, 2 * n)) if k % 20 else None, (r.normal(size=dims) * spread).astype(np.float32).tolist(),
             int(k % 5) if k % 3 else None) for k in range(n)]
    rows += [rows[0]] * 40 + [(0, None, 1), (1, [float("nan")] * dims, 1), (2, [None] * dims, 1), (3, [0.5] * (dims + 1), 9), (4, [], 8)]
    rows.append((-5, [0.0] * dims, 1))
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], "vec_id long, embedding array<float>, label int, code string, v int")
    df.repartition(4).write.parquet(f"file://{tmp_path}/embeddings.parquet")
    got = vector_codes.op12_vector_codes(spark, f"file://{tmp_path}")
    assert sorted(map(tuple, got.collect()), key=str) == plain_codes(rows)


def test_nearest_takes_the_lower_index_and_wide_numbers():
    book = np.array([[5, 5], [0, 0], [5, 5], [10, 10]])
    best, error = vector_codes.nearest(np.array([[5, 5], [7, 8], [-1, 0]]), book)
    assert best.tolist() == [0, 0, 1] and error.tolist() == [0, 13, 1]
    far = 1 << 28
    best, error = vector_codes.nearest(np.array([[far, -far]]), np.array([[-far, far], [-far, far - 1]]))
    assert best.tolist() == [1] and error.tolist() == [(2 * far) ** 2 + (2 * far - 1) ** 2]


def test_decoded_vectors_are_the_entries(spark):
    rows = [(k, [k / 8, 0.0, 1.0, -k / 4], 0) for k in range(6)]
    vectors = vector_codes.integers(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    books = vector_codes.codebooks(vectors)
    back = vector_codes.decoded(vector_codes.coded(vectors, books), books).collect()
    assert {r.vec_id: r.decoded for r in back} == {k: v for k, v, _ in rows}


@pytest.fixture(scope="module")
def extractor():
    return html_extraction.train([])


def test_pages_of_unseen_frames(extractor):
    """Held-out built pages of another seed: nearly all characters get the right verdict, most pages are exact."""
    pages = page_samples.training_pages([], 200, seed=77)
    p, label = html_extraction.labelled(pages)
    got, chars, page = extractor.labels(p), np.array(p.counts["chars"]), np.array(p.page)
    wrong = ((got == html_extraction.ARTICLE) != (label == html_extraction.ARTICLE)) & (chars > 0)
    assert chars[wrong].sum() < 0.02 * chars.sum() and len(set(page[wrong].tolist())) < 30


def test_choices_never_contradict(extractor):
    p, _ = html_extraction.labelled(page_samples.training_pages([], 60, seed=5))
    label = extractor.labels(p)
    for k, up in enumerate(p.parent):
        if up >= 0:
            assert not (label[up] == html_extraction.OTHER and label[k] != html_extraction.OTHER)
            assert not (label[up] == html_extraction.ARTICLE and label[k] == html_extraction.FRAME)


PARA = "The committee met on Tuesday to consider the proposal, which had been delayed twice. Members agreed that more time was needed."


def test_hand_written_pages(extractor):
    page = ("<html><body><header class='site-header'><a href='/'>Site</a><nav><ul><li><a href=/a>Home</a><li><a href=/b>About</a></ul></nav></header>"
            f"<div class='cookie-banner'><p>We use cookies. {PARA}</p><button>OK</button></div>"
            f"<main><article><h1>Title &amp; more</h1><p>{PARA}</p><div class='ad'>Buy now</div><p>A<b>B</b>\n c&nbsp;&lt;d&gt;<br>e</p>"
            f"<script>var x = '<p>no</p>';</script><ul><li>One point</li><li>Two point</ul><p>{PARA}</article>"
            f"<section id='comments'><h2>Comments</h2><div class='comment'><b>Bob</b><p>{PARA}</p></div></section></main>"
            "<aside class='sidebar'><h3>Related</h3><ul><li><a href=q>Another thing</a></li></ul></aside>"
            "<form><label>Mail</label><input></form><footer><p>&copy; 2024 All rights reserved</p></footer></body></html>")
    want = "\n\n".join(["Title & more", PARA, "AB c <d> e", "One point", "Two point", PARA])
    assert extractor.texts([page, None, "", page]) == [want, "", "", want]


def test_reader_recovers():
    def blocks(page):
        p = Pages()
        p.add(page)
        return p.text

    assert blocks("<p><b>one<br><p>two</b> three") == ["one", "two three"]
    assert blocks("<ul><li>a<li>b<ul><li>c</ul>d</ul>e") == ["a", "b", "c", "d", "e"]
    assert blocks("x<!-- <p>no</p> -->y<!doctype html>z") == ["xyz"]
    assert blocks("<div title='a>b'>in</div></div></p>out") == ["in", "out"]
    assert blocks("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert blocks("a < b &amp;&lt; c <") == ["a < b &< c <"]
    assert blocks("<p>a<style>p{}</style><script>1<2</SCRIPT >b") == ["ab"]
    assert blocks("<P CLASS=x>a</P><hr>b") == ["a", "b"]
    assert blocks("a<script>never closed <p>x") == ["a"]
    deep = Pages()
    deep.add("<div>" * 5000 + "deep" + "</div>" * 5000 + "after")
    assert deep.text == ["deep", "after"] and len(deep.tag) == MAX_OPEN
    p = Pages()
    p.add("<div><p>a</p><p>b</p></div><div>c</div>")
    assert p.parent == [-1, 0, 1, 1, 0] and p.end == [5, 4, 3, 4, 5] and p.place == [0, 0, 0, 1, 1] and p.before == [-1, -1, -1, 2, 1]


def test_long_and_odd_pages_take_linear_time(extractor):
    r = random.Random(1)
    long = "<body><article><h1>T</h1>" + "".join(f"<p>{PARA} {k}</p>" for k in range(4000)) + "</article>"
    odd = ["<a \"" * 20000, "<b>" * 20000 + "<p>" * 20000, "<ul><li>" * 20000, "<" * 50000, "&lt;" * 50000, "<p a='x" * 20000,
           "".join(r.choice("<>/ap \"'=&;!-") for _ in range(50000))]
    got = extractor.texts([long, *odd])
    assert got[0].count("\n\n") == 4000 and got[0].endswith("needed. 3999") and len(got) == 8


def test_trees_learn_a_rule():
    r = np.random.default_rng(3)
    x = r.uniform(size=(3000, 6))
    y = (x[:, 1] > 0.5).astype(int) + ((x[:, 1] > 0.5) & (x[:, 4] > 0.3))
    trees = BoostedTrees(3, rounds=20, depth=3).fit(x[:2000], y[:2000], np.ones(2000))
    assert (trees.log_probabilities(x[2000:]).argmax(axis=1) == y[2000:]).mean() > 0.95
    again = BoostedTrees(3, rounds=20, depth=3).fit(x[:2000], y[:2000], np.ones(2000))
    assert (again.value == trees.value).all() and (again.feature == trees.feature).all()


def test_pages_keep_other_columns_types(spark, extractor):
    df = spark.createDataFrame([("a", "<article><h1>T</h1><p>x y.</p></article>", 1, "t"), (None, None, None, None)], "k0 string, html string, n_chars int, text string")
    got = html_extraction.extract(df, extractor, keep=("k0",)).collect()
    assert sorted((r.k0 or "", r.text, r.n_chars) for r in got) == [("", "", 0), ("a", "T\n\nx y.", 7)]
