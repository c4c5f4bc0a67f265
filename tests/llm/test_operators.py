"""The text operators against brute force on small tables with nulls, empty and long texts, ties and clashing columns."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from triplake.llm import (best_fit_packing, catalog, components, encoder, exact_dedup, host_quality, minhash_dedup, pii_pseudonyms,
                          repair_tokens, secret_scan, source_mixing, store, suffix_dedup, textarrays, token_counts)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, rank int, kept string"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(["the", "of", "lorem", "ipsum", "dolor", "sit", "amet", "élan", "zuß"]) + str(r.randrange(60)) for _ in range(n))


def rows():
    long, shared = prose(1, 3000), prose(2, 120)
    texts = [prose(3, 80), None, "", " \n\t ", "one two", "ONE  two", "one two ", prose(4, 200), prose(4, 200), long,
             shared + " " + prose(5, 60), prose(6, 60) + " " + shared, "word " * 300, prose(7, 100),
             prose(7, 100).replace("lorem1", "x9", 1), "line a b\nline a b\nline a b\n" * 3,
             'token = "3e5cb3f9186ce4f749644b4847d287be561795be" mail a.b@mail1.example.com 4111 1111 1111 1111 2024-02-29 !!! <|endoftext|> Σας',
             "a" * 2500, prose(8, 60)]
    out = [(k, t, "en", f"src{k % 3}" if k % 5 else None, None, "x", 1, "y") for k, t in enumerate(texts)]
    out += [(7, prose(4, 200), None, "src0", None, "x", 1, "y"), (None, prose(9, 70), None, None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def folder(spark, docs):
    path = store.scratch_path(spark, "llm-test")
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(k, 1, 0) for k in range(8)] + [(9, None, None), (99, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    docs.limit(0).write.parquet(f"{path}-empty/documents.parquet")
    r = random.Random(11)
    vectors = [(k % 290 if k % 7 else None, [r.uniform(-1, 1) for _ in range(8)] if k % 9 else [float(k % 4)] * 8, k % 3 if k % 5 else None)
               for k in range(300) if k != 11]
    vectors += [(11, [float("nan")] * 8, 1), (12, None, 1), (13, [1.0, None] * 4, 1), (14, [float("inf")] * 8, None)]
    vectors = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    vectors.repartition(3).write.parquet(f"{path}/embeddings.parquet")
    vectors.limit(0).write.parquet(f"{path}-empty/embeddings.parquet")
    page = "<html><body><nav><ul><li><a href=/x>menu</a></li></ul></nav><div class=\"ad\">{}</div><article><h1>{}</h1><p><b>{}<br><p>{}</p></article><footer>{}</footer>"
    pages = [(k, f"http://h/{k}", page.format(*(prose(100 + 5 * k + j, n) for j, n in enumerate((9, 4, 12, 40 * k, 8))))) for k in range(40)]
    pages += [(3, pages[3][1], pages[3][2]), (None, None, pages[4][2] + "</body></html>"), (50, "http://h/50", None), (51, None, "")]
    pages = spark.createDataFrame(pages, "page_id long, url string, html string")
    pages.repartition(3).write.parquet(f"{path}/pages.parquet")
    pages.limit(0).write.parquet(f"{path}-empty/pages.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}-empty/labels.parquet")
    return path


def texts():
    return [(r[0], r[1] or "") for r in rows()]


def by_content(got):
    return sorted(got, key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_sql_agrees(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder.replace('file://', '')}/{table}.parquet/*.parquet'")
    got = catalog.QUERIES[name](spark, folder)
    want = con.sql(catalog.ORACLE[name])
    order = [want.columns.index(c) for c in got.columns]
    assert by_content([tuple(r) for r in got.collect()]) == by_content([tuple(r[i] for i in order) for r in want.fetchall()])


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_empty_table(spark, folder, name):
    assert catalog.QUERIES[name](spark, f"{folder}-empty").count() == 0


def test_pipeline_keeps_columns_and_takes_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = store.written(stage(spark, docs, folder), "stage")
        assert docs.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    ids = [r.doc_id for r in docs.collect()]
    assert 1 not in ids and 2 not in ids and 8 not in ids and 14 not in ids and 0 in ids and 9 in ids
    assert corpus_pipeline.run(spark, f"{folder}-empty").count() == 0


def test_host_verdicts_shrink(spark):
    data = [("bad", True)] * 200 + [("tiny", True)] + [(f"h{k}", j == 0) for k in range(20) for j in range(30)] + [(None, True)]
    got = {r.host: r for r in host_quality.host_verdicts(spark.createDataFrame(data, "host string, base_failed boolean")).collect()}
    assert got["bad"].host_rejected and not got["tiny"].host_rejected and None not in got
    assert not any(v.host_rejected for k, v in got.items() if k.startswith("h"))


def test_suffix_dedup_against_all_positions(spark, docs):
    for length, k, hot in ((60, 30, 2048), (60, 30, 1), (400, 200, 2048)):
        raw = [t.encode() for _, t in texts()]
        seen = collections.Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
        want = []
        for (doc, _), b in zip(texts(), raw):
            gone = np.zeros(len(b), bool)
            for i in range(len(b) - length + 1):
                if seen[b[i:i + length]] > 1:
                    gone[i:i + length] = True
            rest = bytes(np.frombuffer(b, np.uint8)[~gone])
            spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
            want.append((doc, len(b), len(b) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
        got = suffix_dedup.suffix_dedup(docs, length=length, minimiser=k, bucket_contexts=hot)
        assert by_content(map(tuple, got.collect())) == by_content(want)


def test_a_hot_bucket_makes_few_rows_a_context(spark, monkeypatch):
    rng = np.random.default_rng(5)
    word = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes().decode()
    passage, long = word(300), word(900)
    texts = [word(300) + passage + word(300) for _ in range(150)]  # shared bytes, but fewer than a string has
    for k in range(60):  # near copies: a byte differs, from one to the next elsewhere
        at = int(rng.integers(0, 900))
        texts.append(word(50) + long[:at] + "#" + long[at + 1:] + word(50))
    texts += [long[k:k + 520 + k] for k in range(0, 300, 7)]
    rows = {}

    def written(df, name, *args, plain=store.written):
        out = plain(df, name, *args)
        rows.setdefault(name, []).append(out)
        return out

    monkeypatch.setattr(store, "written", written)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {hot: by_content(map(tuple, suffix_dedup.suffix_dedup(docs, bucket_contexts=hot).collect())) for hot in (2048, 2)}
    assert got[2] == got[2048]
    seen = collections.Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    starts = {d: [i for i in range(len(t) - 399) if seen[t[i:i + 400]] > 1] for d, t in enumerate(texts)}
    assert {r[0]: r[2] for r in got[2]} == {d: len({i + j for i in own for j in range(400)}) for d, own in starts.items()}
    starts = rows["suffix-hot"][-1].selectExpr("sum(((at >> 12) & 4095) - (at & 4095) + 1) AS n").first().n
    assert len(rows["suffix-ranges"]) == len(suffix_dedup.RANGES)
    assert 4 * sum(r.count() for r in rows["suffix-ranges"]) < starts


def test_long_texts_are_cut_into_blocks(spark, docs):
    plain = by_content(map(tuple, suffix_dedup.suffix_dedup(docs, length=60, minimiser=30).collect()))
    for block in (60, 97, 1000):
        assert by_content(map(tuple, suffix_dedup.suffix_dedup(docs, length=60, minimiser=30, block=block).collect())) == plain
    n = (1 << 24) + 5000
    data = np.random.default_rng(1).integers(97, 123, n).astype(np.uint8)
    data[n - 1500:n - 500] = data[100:1100]
    row, m, a, b, bucket, near = suffix_dedup.cells(data, np.array([0, n]), 400, 200)
    assert (b - a + 1).sum() == n - 399 and (a <= b).all() and (b <= m).all() and (m - a <= 200).all() and b[-1] == n - 400
    twice = {x.tobytes() for x in bucket[(a >= n - 1500) & (b <= n - 900)]} & {x.tobytes() for x in bucket[b <= 700]}
    assert len(twice) >= 3


def test_interval_expansion_finds_common_prefixes():
    r = random.Random(5)
    for _ in range(60):
        base = [r.choice([1, 2, 3]) for _ in range(25)]
        text = []
        for _ in range(r.randint(1, 4)):
            part = list(base) if r.random() < .6 else [r.choice([1, 2, 3]) for _ in range(r.randint(0, 25))]
            text += part + [0]
        text, least = np.array(text, np.int32), r.randint(1, 10)
        order = suffix_dedup.suffix_order(text)
        got = {int(p) for p in order[suffix_dedup.common_at_least(text, order, least)]}
        words = {i: tuple(text[i:i + least].tolist()) for i in range(len(text))}
        n = collections.Counter(w for w in words.values() if len(w) == least and 0 not in w)
        assert got == {i for i, w in words.items() if n.get(w, 0) > 1}


def encoded(name, end, special=False):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = special
    return [(doc, t.encode(x, add_special_tokens=False).ids + [end]) for doc, x in texts()]


def test_packing(spark, docs):
    got = best_fit_packing.best_fit_packing(docs, sequence_ids=256).collect()
    want = collections.Counter()
    for doc, ids in encoded(best_fit_packing.TOKENIZER, 2):
        for p, (a, b) in enumerate(best_fit_packing.cut(len(ids), 256)):
            want[(doc, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= math.ceil(sum(r.length for r in got) / 256) + 1


def test_supersteps_equal_best_fit_decreasing():
    r = random.Random(2)
    for _ in range(30):
        sizes = sorted((r.randint(1, 64) for _ in range(r.randint(0, 300))), reverse=True)
        gaps = []
        for s in sizes:
            fit = [g for g in gaps if g >= s]
            if fit:
                gaps.remove(min(fit))
                gaps.append(min(fit) - s)
            else:
                gaps.append(64 - s)
        runs = best_fit_packing.supersteps(collections.Counter(sizes), 64)
        used = {q for length, a, b, first, per, _ in runs.tolist() for q in range(first, first + -(-(b - a) // per))}
        assert len(used) == len(gaps)


def test_secret_spans(spark, docs):
    got = {(r.doc_id, r.spans): r for r in secret_scan.secret_scan(docs).collect()}
    for doc, text in texts():
        base = [(m.start(), m.end(), "assign") for m in secret_scan.ASSIGN.finditer(text) if len(m.group(2)) >= 6]
        base += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
        base += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
        base.sort(key=lambda x: (x[0], ("assign", "access", "hex").index(x[2])))
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
        assert any(k[0] == doc and v.base_sha256 == digest for k, v in got.items())


def test_entropy_windows_match_direct_entropy():
    r = random.Random(4)
    for _ in range(40):
        s = "".join(r.choice("0123456789abcdef" if r.random() < .6 else "aab!") for _ in range(r.randint(0, 80)))
        want = set()
        for i in range(len(s) - 19):
            w = s[i:i + 20]
            if set(w) <= set("0123456789abcdef") and -sum(c / 20 * math.log2(c / 20) for c in collections.Counter(w).values()) >= 3 - 1e-9:
                want |= set(range(i, i + 20))
        assert {i for a, b in secret_scan.entropy_spans(s, "0123456789abcdef", 3.0) for i in range(a, b)} == want
    assert secret_scan.scan_text("Donaudampfschifffahrtsgesellschaft and-so-on-and-so-on-and-so-on")[1] == []
    assert secret_scan.scan_text("key Zx9Kq2Lw7Vb4Tn8Rm3Yp6Hd1Js5Gf0 end")[1]


def test_secrets_beside_rulers_and_alphabets_are_found():
    key = "Zx9Kq2Lw7Vb4Tn8Rm3Yp6Hd1Js5Gf0"
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    for filler in ("-" * 8, "=" * 40, "//////////", "AAAAAAAAA", alphabet, alphabet.upper(), "0123456789" + alphabet):
        for text, places in ((key + filler, (0,)), (filler + key, (len(filler),)), (key + filler + key, (0, len(key + filler)))):
            found = secret_scan.scan_text(text)[1]
            assert [x for x in found if any(p <= x[0] and x[1] <= p + len(key) for p in places)] == found
            assert len({p for p in places for x in found if p <= x[0] and x[1] <= p + len(key)}) == len(places), text
    for text in (alphabet + alphabet.upper() + "0123456789+/", "0123456789abcdef" * 3, "-" * 60, "0123456789" + alphabet, "and-so-on-and-so-on" + "-" * 30 + "words"):
        assert secret_scan.scan_text(text)[1] == [], text


def test_exact_dedup_small_tables_and_probing(monkeypatch, spark, docs):
    want = by_content(map(tuple, exact_dedup.exact_dedup(docs).collect()))
    table = exact_dedup.ContentTable()
    assert [table.find(7, str(k % 900).encode())[1] for k in range(1800)] == [True] * 900 + [False] * 900
    kept = exact_dedup.first_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r[3] for r in want)
    # buckets that do not fit are cut by more digits; rows and carried columns leave a task in small parts
    whole = sorted(map(str, kept.collect()))
    for limits in ({"TABLE_BYTES": 3000}, {"TABLE_BYTES": 20_000, "HELD_BYTES": 200, "TABLE_ROWS": 7}):
        for name, value in limits.items():
            monkeypatch.setattr(exact_dedup, name, value)
        assert by_content(map(tuple, exact_dedup.exact_dedup(docs).collect())) == want
        assert sorted(map(str, exact_dedup.first_of_each(docs).collect())) == whole


def test_exact_dedup_cuts_uneven_buckets(monkeypatch, spark):
    monkeypatch.setattr(exact_dedup, "TABLE_BYTES", 2000)
    # 40 hashes that share their first 20 digits, one hash of many large contents, and 200 even ones
    hashes = [(7 << 40) + k for k in range(40)] + [5] * 50 + [k << 55 for k in range(200)]
    reps = spark.createDataFrame([(k, h, 500) for k, h in enumerate(hashes)], "rep_id long, h long, size long")
    got = exact_dedup._buckets(reps).collect()
    size, distinct = collections.Counter(), collections.defaultdict(set)
    for x in got:
        size[x.bucket] += x.size
        distinct[x.bucket].add(x.h)
    assert len(got) == len(hashes) and len({x.depth for x in got}) > 1
    assert all(size[b] <= 2000 or len(distinct[b]) == 1 for b in size)
    assert len({x.bucket for x in got if x.h == 5}) == 1


def test_exact_dedup_takes_millions_of_equal_rows(spark):
    rows = spark.range(0, 1_000_000, 1, 2).selectExpr("IF(id % 3 = 0, NULL, id) AS doc_id", "IF(id % 5 = 0, NULL, ' ') AS text", "id AS n_words")
    got = exact_dedup.first_of_each(rows).collect()
    assert sorted((x.doc_id, x.text) for x in got) == [(1, " "), (5, None)]
    counts = exact_dedup.exact_dedup(rows).groupBy("keep_id", "group_size", "kept").count().collect()
    assert sorted(map(tuple, counts)) == [(1, 800_000, False, 799_999), (1, 800_000, True, 1), (5, 200_000, False, 199_999), (5, 200_000, True, 1)]


def test_separator_scan_over_small_blocks(spark, folder):
    """Counts, places and ids of documents, whichever bounds of blocks and files they cross."""
    table = spark.read.parquet(f"{folder}/documents.parquet")
    want = by_content((doc, len(ids) - 1) for doc, ids in encoded(token_counts.TOKENIZER, 0, special=True))
    names = token_counts.places(table)
    for block, file_docs, id_type in ((65, 2, ">u2"), (4096, 1 << 14, ">u2"), (64, 5, "<u4")):
        path = store.scratch_path(spark, "flat")
        token_counts.write_flat(table, path, file_docs=file_docs, id_type=id_type)
        counts = token_counts.scan_flat(spark, path, block_bytes=block, id_type=id_type)
        got = token_counts.named(counts, names).orderBy("doc_no").collect()
        assert by_content((r.doc_id, r.n_tokens) for r in got) == want and [r.doc_no for r in got] == list(range(len(want)))
        assert got[0].start == 0 and all(b.start == a.start + a.n_tokens + 1 for a, b in zip(got, got[1:]))
        assert [r.doc_id for r in got] == [r.doc_id for r in names.orderBy("part", "k").collect()]


def test_separator_scan_refuses_names_of_another_table(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    path = store.scratch_path(spark, "flat")
    token_counts.write_flat(table.where("doc_id > 3"), path)
    with pytest.raises(Exception, match="do not match"):
        token_counts.named(token_counts.scan_flat(spark, path), token_counts.places(table)).collect()


def test_separator_scan_of_an_open_end_of_nothing_and_of_bad_ids(spark, folder):
    path = store.scratch_path(spark, "flat-open")
    ids = np.array([5, 6, 7, 99, 8, 9], ">u2").tobytes()  # with end id 99; the last byte is the writer's line end
    spark.createDataFrame([(bytearray(ids[:-1]),)], "v binary").coalesce(1).selectExpr("cast(v AS string)").write.option("lineSep", "\t").text(path)
    got = sorted(tuple(r)[:4] for r in token_counts.scan_flat(spark, path, end_id=99, block_bytes=4).collect())
    assert got == [(0, 0, 3, True), (1, 4, 2, False)]
    empty, table = store.scratch_path(spark, "flat-empty"), spark.read.parquet(f"{folder}/documents.parquet")
    token_counts.write_flat(table.where("false"), empty)
    assert token_counts.named(token_counts.scan_flat(spark, empty), token_counts.places(table.where("false"))).collect() == []
    for end in (1 << 16, 0x80):
        with pytest.raises(ValueError):
            token_counts.write_flat(table, empty, end_id=end)


def test_repair_round_trip_and_random_access(spark, docs):
    path = store.scratch_path(spark, "repair")
    repair_tokens.write_tokens(docs, path)
    got = repair_tokens.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    assert by_content((r.doc_id, tuple(r.ids)) for r in got) == by_content((d, tuple(i)) for d, i in encoded(repair_tokens.TOKENIZER, 2))
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda x: (x is not None, x))
    shard = repair_tokens.shards(docs.coalesce(1).where("doc_id = 9")).collect()[0].asDict()
    whole = repair_tokens.decode_range(shard, 0, 0, shard["n_ids"]).tolist()
    assert len(whole) == shard["n_ids"] and repair_tokens.decode_range(shard, 0, 77, 500).tolist() == whole[77:500]
    assert len(shard["symbols"]) // 4 < shard["n_ids"]


def test_new_words_are_encoded_many_to_a_text():
    import pyarrow as pa

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, 0

        def __getattr__(self, name):
            def call(texts, **options):
                self.texts += len(texts)
                return getattr(self.tokenizer, name)(texts, **options)
            return call

    words = [" " + "".join(random.Random(k).choices("etaoinsrÉößİŉª", k=8)) for k in range(500)]
    plain = [w for w in words if "İ" not in w and "ŉ" not in w]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        for own in (words, plain, [" a"]):
            coder = encoder.Encoder(encoder.public_tokenizers.path(name))
            alone = [coder.tokenizer.encode(w, add_special_tokens=False).ids for w in own]
            coder.tokenizer = Counted(coder.tokenizer)
            ids, at = coder.encode(*textarrays.flat(pa.array(own)))
            assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == alone
            assert own is words or coder.tokenizer.texts < 2 + len(own) / 10


def test_encoder_equals_the_library_on_odd_texts():
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer
    r = random.Random(1)
    odd = ["", " ", "it's  I'll\n\n x", "<|endoftext|> a<|endoftext|>", "x\x1c y\x1c", *(
        "".join(r.choice(" \n\t'sStTreabcé́ß,.!-<|>日  \u0085\x1c12٣Σ") for _ in range(r.randint(0, 40))) for _ in range(1500))]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        t = Tokenizer.from_file(public_tokenizers.path(name))
        ids, at = encoder.encoder(name).encode(*textarrays.flat(pa.array(odd)))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [e.ids for e in t.encode_batch(odd, add_special_tokens=False)]


def test_near_duplicates_in_a_large_group(spark):
    """Copies of a base text with one to twelve edits: components equal those of all pairs."""
    r = random.Random(11)
    base = [f"w{r.randrange(10**6)}" for _ in range(120)]
    data = []
    for k in range(120):
        w = list(base)
        for _ in range(1 + k % 12):
            w[r.randrange(120)] = f"e{r.randrange(40)}"
        data.append((1000 - k, " ".join(w)))
    sets = {d: {tuple(t.split()[i:i + 5]) for i in range(116)} for d, t in data}
    label = {d: d for d in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    got = minhash_dedup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == label


def test_strays_of_a_large_group_are_not_paired_with_it(spark, monkeypatch):
    """A group of near copies, many with too many edits for it, some of which are like each other: components equal those
    of all pairs, and no join makes more rows than a small multiple of the postings."""
    r = random.Random(12)
    base = [f"w{r.randrange(10**6)}" for _ in range(120)]

    def edited(words, times):
        w = list(words)
        for at in sorted(r.sample(range(0, 120, 6), times), reverse=True):
            w[at:at + r.choice([1, 1, 1, 2])] = [f"e{r.randrange(30)}"] * r.choice([1, 1, 1, 0])
        return w

    texts = [edited(base, k % 4) for k in range(160)]
    strays = [edited(base, 4 + k % 2) for k in range(100)]
    texts += strays + [edited(w[:100], 0) + w[100:-k] for k, w in enumerate(strays[::6], 1)]
    data = [(1000 - k, " ".join(w)) for k, w in enumerate(texts)]
    sets = {d: {tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for d, t in data}
    label = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    df = spark.createDataFrame(data, "doc_id long, text string")
    made, postings = [], []
    plain, joined = minhash_dedup._across, type(df).join

    def across(live, *more):
        def counted(self, *a, **b):
            out = joined(self, *a, **b)
            made.append(out.count())
            return out

        postings.append(live.count())
        with monkeypatch.context() as m:
            m.setattr(type(df), "join", counted)
            return plain(live, *more)

    monkeypatch.setattr(minhash_dedup, "_across", across)
    got = minhash_dedup.near_duplicates(df).collect()
    assert {x.doc_id: x.component_id for x in got} == label
    assert len(set(label.values())) > 20 and len(postings) == 1 and postings[0] > 1000
    assert max(made) <= 16 * postings[0], (made, postings)


def test_one_row_of_each_group_stays(spark):
    """Rows that share an id or have none are decided each."""
    def near(seed):
        return prose(seed, 120), prose(seed, 120) + " end"
    (a, a2), (f, f2), (g, g2), (h, h2), (k, k2) = (near(x) for x in range(20, 25))
    b, c, d = (prose(x, 90) for x in (30, 31, 32))
    data = [(1, a), (None, a2), (None, b), (None, c), (5, d), (5, f2), (4, f), (None, g), (None, g2), (7, h), (7, h), (7, h2),
            (8, k), (8, k2), (9, None), (9, None), (None, ""), (None, "")]
    got = minhash_dedup.one_of_each(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()
    rest = collections.Counter(map(tuple, got))
    for group in ([(None, g), (None, g2)], [(7, h), (7, h2)], [(8, k), (8, k2)]):
        assert sum(rest.pop(x, 0) for x in group) == 1, group
    assert rest == {(1, a): 1, (None, b): 1, (None, c): 1, (5, d): 1, (4, f): 1, (9, None): 2, (None, ""): 2}


def test_components(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, 101), (200, 100), (7, 7)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 100: 100, 101: 100, 200: 100}


def test_pseudonyms_are_valid_linked_and_reversible():
    p = pii_pseudonyms.Permutation(b"k")
    for kind, s in (("card", "4111 1111 1111 1111"), ("card", "4111-1111-1111-1111"), ("ssn", "123-45-6789"), ("ip", "10.20.30.40"),
                    ("date", "2024-02-29"), ("iban", "GB82 WEST 1234 5698 7654 32"), ("phone", "+1 (310) 555-4510"), ("email", "ab.c9@x.org")):
        new = pii_pseudonyms.pseudonym(kind, s, p)
        assert new != s and pii_pseudonyms.pseudonym(kind, new, p, back=True) == s
    assert all(sorted(p.of(i, n, "t") for i in range(n)) == list(range(n)) for n in (1, 2, 7, 100, 365))
    one, two = (pii_pseudonyms.pseudonym("card", s, p) for s in ("4111 1111 1111 1111", "4111111111111111"))
    assert one.replace(" ", "") == two and pii_pseudonyms.luhn(two)
    text, found = pii_pseudonyms.pseudonymise("at 4111 1111 1111 1112 or 999.1.1.1 or 2024-02-30", p)
    assert text == "at 4111 1111 1111 1112 or 999.1.1.1 or 2024-02-30" and not found


def test_values_side_by_side_are_each_found():
    p = pii_pseudonyms.Permutation(b"k")
    r = random.Random(6)
    one = {"ssn": lambda: f"{r.randint(100, 599)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}",
           "date": lambda: f"20{r.randint(10, 24)}-0{r.randint(1, 9)}-{r.randint(10, 28)}",
           "phone": lambda: f"{r.randint(200, 999)}-555-{r.randint(1000, 9999)}",
           "card": lambda: next(c for c in iter(lambda: f"4111 {r.randint(1000, 9999)} {r.randint(1000, 9999)} {r.randint(1000, 9999)}", "")
                                if pii_pseudonyms.luhn(c.replace(" ", "")))}
    for _ in range(400):
        kinds = [r.choice(list(one)) for _ in range(r.randint(1, 5))]
        values = [one[k]() for k in kinds]
        new, found = pii_pseudonyms.pseudonymise("row " + " ".join(values) + " end", p)
        assert new == "row " + " ".join(pii_pseudonyms.pseudonym(k, v, p) for k, v in zip(kinds, values)) + " end", values
        assert found == collections.Counter(kinds)
    for values in (["2024-01-15-2024-02-20", "date", "-"], ["2024-01-15/2024-02-20", "date", "/"], ["310 555 4510,310 555 4511", "phone", ","],
                   ["BE68 5390 0754 7034,BE68 5390 0754 7034", "iban", ","], ["4111 1111 1111 1111,5500 0000 0000 0004", "card", ","]):
        text, kind, mark = values
        both = [text[:len(text) // 2], text[len(text) // 2 + 1:]]
        joined = mark if mark != "," else " "
        new, found = pii_pseudonyms.pseudonymise(joined.join(both), p)
        assert new == joined.join(pii_pseudonyms.pseudonym(kind, v, p) for v in both) and found == {kind: 2}
    for text in ("4111 1111 1111 1112 2010 2011 2012 2013", "7 4111 1111 1111 1111 123"):
        new, found = pii_pseudonyms.pseudonymise(text, p)
        assert found["phone"] == 0 and found["card"] == (1 if "123" in text else found["card"])


def test_pseudonyms_over_a_table(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    p = pii_pseudonyms.Permutation(b"k")
    want, found = collections.Counter(), collections.Counter()
    for doc_id, text in map(tuple, rows):
        new, counts = (None, {}) if text is None else pii_pseudonyms.pseudonymise(text, p)
        want[doc_id, new, *(counts.get(k, 0) for k in pii_pseudonyms.KINDS)] += 1
        found.update(counts)
    assert collections.Counter(map(tuple, pii_pseudonyms.pii_pseudonyms(docs, b"k").collect())) == want
    assert len(found) > 2


def test_percent_encoded_text_is_read_once():
    p = pii_pseudonyms.Permutation(b"k")
    text = "a%20b%3Dc%26" * 60_000  # 720,000 characters
    new, found = pii_pseudonyms.pseudonymise(text + " to a.b@c.org " + "x" * 65 + "@c.org", p)
    assert found == {"email": 1} and new == text + " to " + pii_pseudonyms.pseudonym("email", "a.b@c.org", p) + " " + "x" * 65 + "@c.org"


def test_mixing_meets_targets_and_learns(spark):
    r = random.Random(3)
    data = []
    for k in range(400):
        kind = 2 if k % 10 == 0 else 1 if k % 10 == 1 else 0
        w = [f"w{r.randrange(300)}" + ("###" if kind == 1 else "") for _ in range(60)] + (["vileword"] * 3 if kind == 2 else [])
        data.append((k, " ".join(w), kind))
    frame = spark.createDataFrame(data, "doc_id long, text string, kind int")
    labels = frame.where("doc_id < 200").selectExpr("doc_id", "int(kind != 1) AS quality", "int(kind = 2) AS toxic")
    got = source_mixing.source_mixing(frame, labels).toPandas().merge(frame.toPandas()[["doc_id", "kind"]], on="doc_id")
    held = got[got.doc_id >= 200]
    assert (held[["p_clean", "p_low", "p_toxic"]].to_numpy().argmax(1) == held.kind).mean() > 0.95
    assert (got.rate >= 0).all() and (got[got.kind == 0].copies >= 1).all() and (got[got.kind == 2].copies == 0).all()
    total = got.n_tokens.sum()
    assert abs((got.rate * got.n_tokens * got.p_clean).sum() / total - source_mixing.TARGET_WEIGHTS["clean"]) < 0.02


def test_mixing_keeps_clean_documents_of_a_clean_corpus(spark):
    r = random.Random(4)
    data = []
    for k in range(1200):
        kind = 2 if k % 120 == 0 else 1 if k % 120 == 1 else 0
        w = [f"w{r.randrange(300)}" + ("###" if kind == 1 else "") for _ in range(60)] + (["vileword"] * 3 if kind == 2 else [])
        data.append((k, " ".join(w), kind))
    frame = spark.createDataFrame(data, "doc_id long, text string, kind int")
    labels = frame.selectExpr("doc_id", "int(kind != 1) AS quality", "int(kind = 2) AS toxic")
    got = source_mixing.source_mixing(frame, labels).toPandas().merge(frame.toPandas()[["doc_id", "kind"]], on="doc_id")
    assert (got[got.kind == 0].copies >= 1).mean() > 0.999 and (got[got.kind == 2].copies == 0).all()


def test_rates_equal_direct_least_squares(spark, monkeypatch):
    monkeypatch.setattr(source_mixing, "RIDGE", 0.2)  # a firmer pull, to be there in fewer rounds
    r = random.Random(9)
    rows = []
    for k in range(60):
        e = [r.random() ** 3 for _ in range(3)]
        rows.append((k, r.randrange(1, 400), *(x / sum(e) for x in e)))
    weights = {"clean": 0.8, "low": 0.15, "toxic": 0.05}
    points = spark.createDataFrame(rows, "doc_id long, n_tokens long, p0 double, p1 double, p2 double")
    got = source_mixing.rates(points, weights, rounds=50, tolerance=1e-9).orderBy("doc_id").toPandas().rate.to_numpy()
    # the same objective, minimised one rate at a time until nothing moves
    n = np.array([x[1] for x in rows], float)
    p = np.array([x[2:] for x in rows])
    have = n @ p
    target = np.array([weights[k] for k in source_mixing.DOMAINS]) * max(n.sum(), have[0] / weights["clean"])
    rate = np.ones(60)
    for _ in range(5000):
        before = rate.copy()
        for d in range(60):
            own = n[d] * p[d]
            rest = (n * rate) @ p - own * rate[d] - target
            curve = (own * own / have).sum() + source_mixing.RIDGE * n[d]
            rate[d] = max(0.0, (source_mixing.RIDGE * n[d] - (own * rest / have).sum()) / curve)
        if np.abs(rate - before).max() < 1e-12:
            break
    assert np.abs(rate - 1).max() > 0.1 and np.abs(rate - got).max() < 2e-3


def test_copies_go_to_the_row_they_were_computed_for(spark):
    r = random.Random(8)
    data = []
    for k in range(400):
        kind = 2 if k % 10 == 0 else 1 if k % 10 == 1 else 0
        w = [f"w{r.randrange(300)}" + ("###" if kind == 1 else "") for _ in range(60)] + (["vileword"] * 3 if kind == 2 else [])
        data.append((k if k < 200 else None if k < 300 else 1000 + k // 20, " ".join(w), kind))
    frame = spark.createDataFrame(data, "doc_id long, text string, kind int")
    labels = frame.where("doc_id < 200").selectExpr("doc_id", "int(kind != 1) AS quality", "int(kind = 2) AS toxic")
    got = collections.Counter(x.text for x in source_mixing.mixed_documents(frame, labels).collect())
    plan = source_mixing.source_mixing(frame, labels).collect()
    assert sum(got.values()) == sum(x.copies for x in plan)
    assert all(got[t] >= 1 for _, t, kind in data if kind == 0) and not any(got[t] for _, t, kind in data if kind == 2)
