"""Content is told apart by content, users' columns stay theirs, repeats cost nothing extra, and the pipeline equals plain Python."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from triplake.llm import (best_fit_packing, encoder, host_quality, minhash_dedup, repair_tokens, source_mixing, store, suffix_dedup,
                          textarrays as ta, token_counts)
from triplake.llm.minhash_dedup import SIMILARITY_PERCENT


def thue_morse(bits, swap=False):
    word = "ab"[swap]
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word


PAIR = thue_morse(10), thue_morse(10, True)


def test_words_that_fool_polynomials_have_ids_of_their_own():
    """Differences of Thue-Morse words are zero under any polynomial modulo 2**64."""
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        coder = encoder.Encoder(encoder.public_tokenizers.path(name))
        texts = [*PAIR, "x" + PAIR[0] + " " + PAIR[1], "a\0", "a", "a\0\0", "b" * 15, "b" * 16, "b" * 17, *(thue_morse(k, s) for k in (3, 4) for s in (0, 1))] * 2
        ids, off = coder.encode(*ta.flat(pa.array(texts)))
        for k, text in enumerate(texts):
            assert ids[off[k]:off[k + 1]].tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_hashes_differ_where_content_does():
    data = np.frombuffer("".join(PAIR).encode(), np.uint8)
    starts, ends = np.array([0, 1024]), np.array([1024, 2048])
    assert len(set(ta.range_hashes(ta.prefix_sums(data), starts, ends).tolist())) == 2
    assert len(set(ta.content_hashes(data, starts, ends).tolist())) == 2
    r = random.Random(2)
    words = ["".join(r.choice("ab\0é ") for _ in range(r.randrange(0, 90))) for _ in range(3000)] + ["", "a", "a\0", "\0", "\0\0"]
    flat, off = ta.flat(pa.array(words))
    h = ta.content_hashes(flat, off[:-1], off[1:])
    assert len(dict(zip(h.tolist(), words))) == len(set(words)) and len(set(zip(h.tolist(), words))) == len(set(words))
    sums = ta.prefix_sums(flat)
    for k in range(0, len(flat) - 900, 37):  # equal content hashes alike wherever it stands
        moved = np.concatenate([flat[5:9], flat[k:k + 300], flat[:3]])
        assert ta.range_hashes(sums, np.array([k]), np.array([k + 300])) == ta.range_hashes(ta.prefix_sums(moved), np.array([4]), np.array([304]))


def test_operators_tell_such_texts_apart(spark):
    a, b = PAIR
    texts = [f"{a}\n{b}\nx", f"{a} one two three four", f"{b} one two three four", f"{a}{a}", f"{b}{b}"]
    df = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    assert {r.doc_id: r.n_dup_lines for r in host_quality.host_quality(df).collect()}[0] == 0
    near = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(df).collect()}
    assert near[1] == 1 and near[2] == 2 and near[3] == 3 and near[4] == 4
    words = spark.createDataFrame([(0, thue_morse(9)), (1, thue_morse(9, True))], "doc_id long, text string")
    raw = [thue_morse(9, s).encode() for s in (0, 1)]
    seen = collections.Counter(t[i:i + 400] for t in raw for i in range(len(t) - 399))
    want = {}
    for k, t in enumerate(raw):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 399):
            gone[i:i + 400] |= seen[t[i:i + 400]] > 1
        want[k] = int(gone.sum())
    assert {r.doc_id: r.n_removed for r in suffix_dedup.suffix_dedup(words).collect()} == want


CLASHING = ("doc_id long, text string, source string, `_id` string, `_h` string, `_g` string, n_words int, word_chars string, base_failed string, "
            "`_copies` int, copies string, `_one` int, host string, u0 string, u1 int, id_ string, h_ string, own_id string, rid string, component string, row_ string, "
            "n_tokens string, p0 string, rank int, `a.b` string, kept string")


def clashing_rows(texts):
    return [(k, t, "s0") + tuple(f"v{k}" if "string" in c else 7 for c in CLASHING.split(", ")[3:]) for k, t in enumerate(texts)]


def test_users_columns_stay_as_they_are(spark):
    r = random.Random(4)
    prose = [" ".join(f"w{r.randrange(500)}" for _ in range(80)) for _ in range(6)]
    rows = clashing_rows([*prose, prose[0] + " more", None, "short"])
    df = spark.createDataFrame(rows, CLASHING)
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    docs = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "mixing":
            docs = store.written(source_mixing.mixed_documents(docs, labels), "stage")
        else:
            docs = store.written(stage(spark, docs, ""), "stage")
        assert docs.schema.simpleString() == df.schema.simpleString(), name
    got = {tuple(x) for x in docs.collect()}
    assert got <= {rows[k] for k in range(6)} and len(got) == 6


def test_repeated_rows_confirm_once(spark, monkeypatch):
    """A near pair, each text repeated with a null id: one pair of texts is compared."""
    r = random.Random(5)
    words = [f"w{r.randrange(900)}" for _ in range(120)]
    a, b = " ".join(words), " ".join(words + ["end"])
    seen = []
    plain = minhash_dedup._confirmed

    def spied(pairs, texts):
        seen.append((pairs.count(), texts.groupBy("rid").count().agg(F.max("count")).first()[0]))
        return plain(pairs, texts)

    monkeypatch.setattr(minhash_dedup, "_confirmed", spied)
    df = spark.createDataFrame([(None, t) for t in (a, b) for _ in range(600)], "doc_id long, text string").repartition(4)
    got = minhash_dedup.near_duplicates(df)
    assert got.count() == 1200 and max(n for n, _ in seen) <= 1 and max(k or 0 for _, k in seen) <= 1
    assert minhash_dedup.one_of_each(df).count() == 1


def test_many_small_hosts_condemn_nobody(spark):
    r = random.Random(6)
    data = [(f"h{k}", r.random() < 0.4) for k in range(2000)]
    got = host_quality.host_verdicts(spark.createDataFrame(data, "host string, base_failed boolean")).collect()
    assert not any(x.host_rejected for x in got) and len(got) == 2000
    data += [("bad", True)] * 300 + [(f"m{k}", j < 2) for k in range(40) for j in range(40)] + [("mixed", j < 5) for j in range(6)]
    got = {x.host: x.host_rejected for x in host_quality.host_verdicts(spark.createDataFrame(data, "host string, base_failed boolean")).collect()}
    assert [h for h, bad in got.items() if bad] == ["bad"]
    same = spark.createDataFrame([("a", True)] * 3 + [("b", True)], "host string, base_failed boolean")
    assert all(x.host_rejected for x in host_quality.host_verdicts(same).collect())


def test_grammar_of_repetitive_shards_is_short():
    """Rounds go on while they save; nothing but the saving ends them."""
    for ids in (np.zeros(1 << 18, np.uint32), np.tile(np.arange(1000, dtype=np.uint32), 300)):
        symbols, per, rules = repair_tokens.grammar(ids, np.array([0, len(ids)]), 2000)
        assert len(symbols) < 0.02 * len(ids) and per.sum() == len(symbols)
        assert (repair_tokens.expanded(symbols, rules, 2000) == ids).all()
        assert repair_tokens.expansion_lengths(rules, 2000).max() > 100
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        ids = r.integers(0, 30, n).astype(np.uint32)
        cut = np.sort(r.integers(0, n + 1, 40))
        off = np.concatenate([[0], cut, [n]])
        symbols, per, rules = repair_tokens.grammar(ids, off, 30)
        assert (repair_tokens.expanded(symbols, rules, 30) == ids).all()
        size = np.concatenate([np.ones(30, int), repair_tokens.expansion_lengths(rules, 30)])
        ends = np.concatenate([[0], np.cumsum(per)])
        assert [int(size[symbols[a:b]].sum()) for a, b in zip(ends, ends[1:])] == np.diff(off).tolist()


def test_ids_that_are_mostly_null_are_spread(spark):
    r = random.Random(7)
    data = [(None if k % 3 else k, " ".join(f"w{r.randrange(50)}" for _ in range(20))) for k in range(900)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    path = store.scratch_path(spark, "null-ids")
    repair_tokens.write_tokens(df, path)
    parts = repair_tokens.read_tokens(spark, path)
    assert parts.count() == 900
    sizes = [x["count"] for x in repair_tokens.shards(df).groupBy("part").agg(F.sum("n_docs").alias("count")).collect()]
    assert len(sizes) > 2 and max(sizes) < 500
    rows = sorted((tuple(x) for x in parts.collect()), key=lambda x: x[1])
    assert [x[0] for x in rows] == sorted((d for d, _ in data), key=lambda d: (d is not None, d or 0))
    assert [x[1] for x in rows] == [0, *np.cumsum([x[2] for x in rows])[:-1].tolist()]


# -- the pipeline in plain Python --------------------------------------------------------------------------------------------
def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base_failed(text):
    w = words(text)
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {i + j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(3)}
    return len(w) < 50 or 100 * len(covered) > 50 * len(w)


def rejected_hosts(rows):
    hosts = {}
    for _, text, host in rows:
        if host is not None:
            n, f = hosts.get(host, (0, 0))
            hosts[host] = n + 1, f + base_failed(text)
    total, failed, k = sum(n for n, _ in hosts.values()), sum(f for _, f in hosts.values()), len(hosts)
    m = failed / total
    apart = m * (1 - m) * (total - sum(n * n for n, _ in hosts.values()) / total - (k - 1))
    rho = (sum(f * f / n for n, f in hosts.values()) - failed * m - m * (1 - m) * (k - 1)) / apart if apart else 0
    weight = min(1000.0, max(4.0, 1 / rho - 1)) if rho > 0 else 1000.0
    return {h for h, (n, f) in hosts.items() if (f + m * weight) / (n + weight) > 0.8}


def shingles(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def group_of(rows):
    sets = [shingles(t) for _, t, _ in rows]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= SIMILARITY_PERCENT * (len(sets[a]) + len(sets[b]) - both):
                up[root(a)] = root(b)
    return [root(k) if sets[k] else -1 - k for k in range(len(rows))]


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(12)

    def prose(n):
        return " ".join(r.choice(["the", "of", "lorem", "ipsum", "dolor", "sit", "amet", "élan", "zuß"]) + str(r.randrange(90)) for _ in range(n))

    texts = [prose(r.randrange(20, 400)) for _ in range(60)]
    texts += [t.replace(" ", "  ") + "\n" for t in texts[:8]] + [t + " end" for t in texts[8:20]] + ["X" + t[1:] for t in texts[20:26]]
    texts += [None, "", "spam " * 200, prose(5000), prose(90) + " vile vile", *(prose(70) + " vile" for _ in range(12)), *(prose(70) + " ###" for _ in range(12))]
    texts += ["short text"] * 60
    rows = [(k if k % 17 else None, t, "bad" if t == "short text" or k in (3, 4) else f"s{k % 4}" if k % 9 else None) for k, t in enumerate(texts)]
    return rows + [rows[5], rows[5]]


def test_pipeline_equals_plain_python(spark, corpus):
    path = store.scratch_path(spark, "plain-pipeline")
    spark.createDataFrame(corpus, "doc_id long, text string, source string").repartition(4).write.parquet(f"{path}/documents.parquet")
    marks = [(d, int("###" not in t), int("vile" in t)) for d, t, _ in corpus if d is not None and t and d % 2]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = store.written(stage(spark, docs, path), "plain")
        stages.append((name, before, [tuple(x) for x in docs.collect()]))

    # quality rules
    bad = rejected_hosts(corpus)
    rows = [x for x in corpus if not base_failed(x[1]) and x[2] not in bad]
    assert "bad" in bad and collections.Counter(stages[0][2]) == collections.Counter(rows)
    # exact dedup: of equal texts the smallest id
    first = {}
    for x in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", x[1] or ""), x)
    got = stages[1][2]
    assert sorted(map(str, (x[0] for x in got))) == sorted(str(x[0]) for x in first.values()) and len(got) == len(first)
    assert {re.sub(r"[\x20\x09-\x0D]+", " ", x[1]): x[0] for x in got} == {k: x[0] for k, x in first.items()}
    # near dedup: one of each group, with the smallest id
    groups = collections.defaultdict(list)
    for g, x in zip(group_of(got), got):
        groups[g].append(x)
    assert any(len(g) > 1 for g in groups.values())
    stay = stages[2][2]
    assert len(stay) == len(groups)
    for g in groups.values():
        kept = [x for x in g if x in stay]
        assert len(kept) == 1 and kept[0][0] == min((x[0] for x in g if x[0] is not None), default=None)
    # mixing: every row as often as its rate says; toxic rows go, clean rows stay
    plan = {(x.doc_id, x.n_tokens): x.copies for x in source_mixing.source_mixing(stages[3][1], spark.read.parquet(f"{path}/labels.parquet")).collect()}
    mixed = collections.Counter(stages[3][2])
    assert mixed == collections.Counter({x: plan[x[0], len(words(x[1]))] for x in stay if plan[x[0], len(words(x[1]))]})
    assert all(mixed[x] >= 1 for x in stay if "vile" not in x[1] and "###" not in x[1])
    # packing: every text's ids, cut and placed without gaps, in no more sequences than first-fit decreasing takes
    pieces = corpus_pipeline.run(spark, path).collect()
    tokenizer = encoder.encoder(best_fit_packing.TOKENIZER).tokenizer
    want = collections.Counter()
    lengths = []
    for x, n in mixed.items():
        ids = tokenizer.encode(x[1], add_special_tokens=False).ids + [2]
        first_piece = len(ids) % 1024 if len(ids) > 1024 else len(ids)
        cuts = [0, *range(first_piece or 1024, len(ids), 1024), len(ids)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[x[0], p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += n
            lengths += [b - a] * n
    sequences = collections.defaultdict(list)
    for x in pieces:
        sequences[x.sequence_id].append((x.offset, x.length))
    assert sum(want.values()) == len(pieces) and sum(x.length for x in pieces) == sum(lengths)
    assert collections.Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in pieces) == want
    gaps = []
    for n in sorted(lengths, reverse=True):
        k = next((k for k, room in enumerate(gaps) if room >= n), None)
        if k is None:
            gaps.append(1024 - n)
        else:
            gaps[k] -= n
    assert len(sequences) <= len(gaps)
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()] and sum(n for _, n in own) <= 1024
