"""Operators on small tables with every awkward row, against plain definitions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

import corpus_pipeline
from spendcast.llm import (
    byte_bpe, catalog, common, exact_dedup, language, neighbours, ngram_join, packing, quality, suffix_dedup, token_count, toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, row string, score string, own string, print string"
WORDS = "the of and river stone house winter garden letter music table window bridge morning paper".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice("abcdefgh") for _ in range(n))


def awkward():
    """Nulls, empty and long texts, exact and near copies, shared passages, ties and repeated rows."""
    rng = random.Random(11)
    base, passage = prose(rng, 120), prose(rng, 60)
    texts = [None, "", " \n\t", "a", "A", "à À", "!!!", "x" * 3000, "ab " * 900, base, base.upper(), base.replace("river", "rover", 1)]
    for i in range(12):
        words = base.split()
        words[10 + 7 * i % 100] = f"new{i}"
        texts.append(" ".join(words))
    texts += [prose(rng, 30) + " " + passage + " " + prose(rng, 30) for _ in range(6)]
    texts += [prose(rng, n) for n in (1, 4, 5, 6, 9000)] + ["é" * 150, "ü" + "é" * 150]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], rows[14], (None, base), (None, None), (5000, base), (5001, None)]
    extra = ("x",) * 4
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s2", None]), len(t or ""), *extra) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_exact_duplicates(docs, empty):
    rows = [(r[0], lower(r[1])) for r in awkward()]
    for bits in (64, 5):  # five bits make unlike texts collide
        got = exact_dedup.exact_duplicates(docs, bits).collect()
        assert len(got) == len(rows)
        by = {}
        for doc, text in rows:
            by.setdefault(hashlib.sha256(text.encode()).hexdigest(), []).append(doc)
        kept = Counter()
        for r in got:
            same = by[r.text_sha256]
            assert r.group_size == len(same)
            assert r.keep_id == max((d for d in same if d is not None), default=None)
            kept[r.text_sha256] += r.kept
            assert not r.kept or r.doc_id == r.keep_id
        assert set(kept.values()) == {1}
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_exact_duplicates_beyond_the_broadcast_limits(docs, monkeypatch):
    expected = sorted(map(str, exact_dedup.exact_duplicates(docs).drop("row").collect()))
    monkeypatch.setattr(exact_dedup, "BROADCAST_ITEMS", 0)
    monkeypatch.setattr(exact_dedup, "BROADCAST_GROUPS", 0)
    assert sorted(map(str, exact_dedup.exact_duplicates(docs).drop("row").collect())) == expected


def test_heavy_keys_are_broadcast_and_the_rest_shuffled(spark):
    rows = spark.createDataFrame([(k, i) for k in range(5) for i in range(3000 if k == 0 else k)], "k int, i int")
    table = rows.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1")
    for limit in (0, 100):
        got = exact_dedup.with_copies(rows, table, "k", "n", 3010, limit).groupBy("k", "n").agg(F.count("*").alias("rows"))
        assert {tuple(r) for r in got.collect()} == {(0, 3000, 3000), (1, None, 1), (2, 2, 2), (3, 3, 3), (4, 4, 4)}


def test_groups_come_from_the_merged_filters(spark, docs, monkeypatch):
    """A fingerprint that the filters do not count twice is not grouped."""
    whole = exact_dedup.repeated_fingerprints
    lost = {}

    def without_one(prints, bits=64, items=None):
        found = whole(prints, bits, items)
        lost["print"] = found.agg(F.min("print")).first()[0]
        return found.filter(F.col("print") != lost["print"])

    groups = lambda found: {(r["text_sha256"], r["group_size"]) for r in found.collect() if r["group_size"] > 1}
    before = groups(exact_dedup.exact_duplicates(docs))
    monkeypatch.setattr(exact_dedup, "repeated_fingerprints", without_one)
    after = groups(exact_dedup.exact_duplicates(docs))
    (gone,) = before - after
    normal = common.ascii_lower(common.text_of())
    named = docs.filter(exact_dedup.fingerprint(normal) == lost["print"]).select(F.sha2(normal, 256)).distinct().collect()
    assert after < before and [gone[0]] == [r[0] for r in named]


def test_deduplicated_keeps_columns_and_one_row_of_each(docs, empty):
    got = exact_dedup.deduplicated(docs)
    assert got.columns == docs.columns and exact_dedup.deduplicated(empty).count() == 0
    texts = Counter(lower(r.text) for r in got.collect())
    assert set(texts) == {lower(r[1]) for r in awkward()} and set(texts.values()) == {1}


def plain_components(rows, percent=80):
    sets = {}
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    label = {d: d for d in sets}
    for _ in sets:
        for a, b in itertools.combinations(sets, 2):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                label[a] = label[b] = min(label[a], label[b])
    return {d: (len(sets[d]), label[d]) for d in sets}


def test_link_components(docs, empty):
    named = docs.filter("doc_id is not null")
    wanted = plain_components([(r[0], r[1]) for r in awkward() if r[0] is not None])
    got = ngram_join.link_components(named).collect()
    assert len(got) == named.count()
    assert all(wanted[r.doc_id] == (r.n_shingles, r.component_id) for r in got)
    assert ngram_join.link_components(docs).count() == docs.count()
    assert ngram_join.link_components(empty).count() == 0


def test_chains_of_near_copies_are_one_component(spark):
    """Neighbours link, ends do not; many lists stay open after the first checks."""
    rng = random.Random(8)
    words = prose(rng, 80).split()
    rows = []
    for i in range(60):
        rows.append((1000 - i, " ".join(words)))
        words[(i * 13) % len(words)] = f"w{i}"
    got = ngram_join.link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    wanted = plain_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == wanted


def test_groups_of_partly_linked_copies_need_few_checks(spark, monkeypatch):
    """Many pairs of the group don't link, among them most of those with its smallest doc_id."""
    rng = random.Random(5)
    base, texts = prose(rng, 150).split(), []
    for i in range(150):
        words = list(base)
        for k in range(1 + i % 3 if i else 3):
            words[rng.randrange(5, 145)] = f"w{i}x{k}"
        texts.append(" ".join(words))
    rows = [(i, t) for i, t in enumerate([*texts, prose(rng, 150)])]
    checked, plausible = [], ngram_join.plausible

    def counted(pairs, one, percent):
        checked.append(pairs.count())
        return plausible(pairs, one, percent)

    monkeypatch.setattr(ngram_join, "plausible", counted)
    monkeypatch.setattr(ngram_join, "PIVOTS", 4, raising=False)
    got = ngram_join.link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(rows)
    assert sum(checked) < 20 * len(rows), checked


def test_representatives(docs):
    got = ngram_join.representatives(docs.filter("doc_id is not null"))
    labels = plain_components([(r[0], r[1]) for r in awkward() if r[0] is not None])
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == {d for d, (_, c) in labels.items() if c == d}


def plain_removals(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        hit = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                hit[i : i + length] = b"\x01" * length
        kept = bytes(b for b, h in zip(d, hit) if not h)
        runs = len(re.findall(b"\x01+", bytes(hit)))
        out.append((len(d), sum(hit), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("bucket", [1000, 2])
def test_removals(docs, empty, bucket, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    rows = awkward()
    wanted = Counter(zip([r[0] for r in rows], plain_removals([r[1] for r in rows], 200)))
    got = suffix_dedup.removals(docs).collect()
    assert Counter((r[0], tuple(r[1:])) for r in got) == wanted
    assert suffix_dedup.removals(empty).count() == 0


def test_cleaned_sends_texts_to_python_once(spark):
    """Cutting and decoding in two steps would hold two workers a task."""
    rng = random.Random(3)
    shared = prose(rng, 60)
    rows = [(i, f"{prose(rng, 20)} {shared} {i}" if i else None) for i in range(6)]
    done = suffix_dedup.cleaned(spark.createDataFrame(rows, "doc_id long, text string"))
    assert done._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") <= 2  # one for each side of a union at most
    assert done._jdf.queryExecution().analyzed().toString().count("MapInArrow") == 1
    texts = {r["doc_id"]: r["text"] for r in done.collect()}
    assert texts[0] is None and all(shared not in texts[i] for i in range(1, 6)) and texts[5].endswith("5")


def test_cleaned_cuts_no_character_in_half(docs):
    got = suffix_dedup.cleaned(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    for r in got.collect():
        assert r.text is None or "�" not in r.text


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = catalog.vocabulary("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = awkward()
    ids = [np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4") for r in rows]
    got = packing.pieces(packing.pack(docs, path, window=64, grain=16), with_ids=True).collect()
    assert sum(r.length for r in got) == sum(map(len, ids))
    # Every window but the last is full and gapless.
    windows = {}
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(windows) == list(range(len(windows)))
    for number, own in windows.items():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == 64 or number == len(windows) - 1
    # The pieces of the documents with one id are its ids, as often as it occurs.
    wanted = Counter((r[0], x.tobytes()[4 * i : 4 * i + 4]) for r, x in zip(rows, ids) for i in range(len(x)))
    assert Counter((r.doc_id, r.ids[4 * i : 4 * i + 4]) for r in got for i in range(r.length)) == wanted
    # No source is ever ahead or behind its share by more than a grain and a round.
    share = Counter()
    for r, x in zip(rows, ids):
        share[r[3]] += len(x) / sum(map(len, ids))
    served = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        served[r.source] += r.length
        assert abs(served[r.source] - share[r.source] * sum(served.values())) <= 64 + 2 * 16
    assert packing.pieces(packing.pack(empty, path)).count() == 0


def test_packing_to_given_shares(docs):
    path = catalog.vocabulary("word_bpe_49k.json")
    got = packing.pieces(packing.pack(docs, path, 64, 16, {"s1": 0.2, "s2": 0.6})).collect()
    early = Counter()
    for r in got:
        if r.sequence_id < 20:
            early[r.source] += r.length
    assert early["s2"] > 2 * early["s1"]


def test_byte_bpe(docs, empty):
    import public_tokenizers

    coder = (catalog.vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = byte_bpe.decode(byte_bpe.encode(docs, *coder), *coder)
    assert got.columns == [*docs.columns, "ids", "decoded"]
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in got.collect())
    assert byte_bpe.encode(empty, *coder).count() == 0


def test_token_counts(docs, empty):
    path = catalog.vocabulary("piece_bpe_32k.model")
    got = token_count.count_tokens(docs.withColumn("n_tokens", F.lit("old")), path).collect()
    assert len(got) == docs.count() and all((r.n_tokens > 0) == bool(r.text) for r in got)
    assert token_count.count_tokens(empty, path).count() == 0


def test_language(spark, docs, empty):
    rng = random.Random(1)
    kinds = {"aa": "lorem dolor amet sit", "bb": "krzysz szczyt wrzos chrz", "cc": "ναι όχι καλά"}
    rows = [(i, " ".join(rng.choices(kinds[k].split(), k=20)), k) for i, k in enumerate(rng.choices(list(kinds), k=300))]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(known)
    got = language.identify(known, model).collect()
    assert all(r.lang_pred == r.lang and 0.5 < r.score < 1 for r in got)
    assert np.mean(model.weights == 0) > 0.9  # the penalty leaves few coefficients
    odd = language.identify(docs, model)
    assert odd.columns == [*(c for c in docs.columns if c != "score"), "lang_pred", "score"]
    for r in odd.collect():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
    assert language.identify(empty, model).count() == 0
    assert {r.lang_pred for r in language.identify(docs, language.fit(empty)).collect()} == {"und"}
    assert language.confident(docs).columns == docs.columns


def labelled(spark, bad, label):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(900):
        y = rng.random() < 0.3
        rows.append((i, bad(prose(rng, 60)) if y else prose(rng, 60)))
        labels.append((i, int(y) if label == "toxic" else int(not y)))
    docs = spark.createDataFrame(rows + [(9000, None), (9001, ""), (None, "a")], "doc_id long, text string")
    return docs, spark.createDataFrame(labels + [(5, None), (None, 1), (77777, 1)], f"doc_id long, {label} int")


@pytest.mark.parametrize(
    "operator, label, bad",
    [
        (toxicity, "toxic", lambda t: t.replace(" ", " dreadfulness ", 3)),
        (quality, "quality", lambda t: t.upper().replace(" ", "!! ")),
    ],
)
def test_classifiers(spark, docs, empty, operator, label, bad):
    texts, labels = labelled(spark, bad, label)
    truth = {r[0]: r[1] for r in labels.collect()}
    got = operator.score(texts, operator.fit(texts, labels), ["doc_id"]).collect()
    assert len(got) == 903 and all(0 <= r.score <= 1 for r in got)
    aside = [r for r in got if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and r.doc_id in truth]
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in aside]) > 0.95
    assert operator.score(docs, operator.fit(docs, labels), ["doc_id", "row"]).count() == docs.count()
    none = labels.limit(0)
    assert {r.score for r in operator.score(docs, operator.fit(docs, none), ["doc_id"]).collect()} == {0.0}
    assert operator.score(empty, operator.fit(empty, labels), ["doc_id"]).count() == 0


def test_toxic_words_may_be_rare(spark):
    """Forty toxic words, each in about one of forty toxic texts."""
    rng = random.Random(6)
    words = ["".join(rng.choice("jkqvxyz") for _ in range(12)) for _ in range(40)]
    rows, labels = [], []
    for i in range(1800):
        toxic = rng.random() < 0.3
        rows.append((i, prose(rng, 60).replace(" ", f" {rng.choice(words)} ", 3 if toxic else 0)))
        labels.append((i, int(toxic)))
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(texts, spark.createDataFrame(labels, "doc_id long, toxic int"))
    aside = [(t, y) for (i, t), (_, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 3 == 1]
    scores = model.score([t for t, _ in aside])
    assert np.mean([(s >= 0.5) == y for s, (_, y) in zip(scores, aside)]) > 0.9


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 12)) + rng.normal(size=(10, 12))[rng.integers(0, 10, 1500)] * 2
    x[300:700] = x[0]  # a third are copies
    rows = [(i, [float(v) for v in r], "a") for i, r in enumerate(x)]
    odd = [(5000, None), (5001, [0.0] * 12), (5002, [1.0] * 11 + [None]), (5003, [float("nan")] + [1.0] * 11), (5004, [1.0] * 3), (None, [1.0] * 12), (5005, [float("inf")] * 12)]
    schema = "vec_id long, embedding array<double>, score string"
    vectors = spark.createDataFrame(rows + [(*o, "b") for o in odd] + rows[:1], schema)
    router = neighbours.fit(vectors, "embedding", "vec_id", parts=8)
    found = neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0), router).collect()
    length = np.sqrt((x * x).sum(axis=1))
    hits = 0
    for q in range(0, 1500, 50):
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        score = (x * x[q]).sum(axis=1) / (length * length[q])
        score[q] = -2
        best = np.lexsort((np.arange(1500), -score))[:5]
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        assert np.allclose([r.score for r in own], score[[r.vec_id for r in own]], atol=1e-12)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        hits += len({r.vec_id for r in own} & set(best.tolist()))
    assert hits >= 0.9 * 5 * 30 and {r.query_id for r in found} == set(range(0, 1500, 50))
    assert neighbours.fit(vectors.limit(0), "embedding", "vec_id") is None
    assert neighbours.nearest(vectors, vectors, None).count() == 0
    few = spark.createDataFrame(rows[:3], schema)
    assert neighbours.nearest(few, few, neighbours.fit(few, "embedding", "vec_id")).count() == 6


def plain_nearest(rows, asked, k=5):
    """The k nearest ids of every asked id, with components scaled by hand and the nearest vector of every id."""
    unit = [(i, np.array(v) / np.abs(v).max()) for i, v in rows]
    unit = [(i, v / np.sqrt((v * v).sum())) for i, v in unit]
    out = {}
    for q in asked:
        best = {}
        for own in (v for i, v in unit if i == q):
            for i, v in unit:
                if i != q:
                    best[i] = max(best.get(i, -2.0), round(float(own @ v), 12))
        out[q] = sorted(best, key=lambda i: (-best[i], i))[:k]
    return out


def test_neighbours_of_any_length_and_repeated_ids(spark):
    """Components near the ends of the double range, ids with several vectors, one id in a third of the rows."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 6)) * 10.0 ** rng.choice([-300, -160, 0, 150, 200, 300], 400)[:, None]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(i, [float(c) for c in v]) for i, v in zip(range(0, 100, 5), rng.normal(size=(20, 6)))] + [rows[7]] * 200
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    router = neighbours.fit(vectors, "embedding", "vec_id", parts=8)
    router.probes = len(router.second[0])
    found = neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"), router).orderBy("query_id", "rank").collect()
    want = plain_nearest(rows, range(0, 400, 50))
    assert all(np.isfinite(r.score) and -1 - 1e-9 <= r.score <= 1 + 1e-9 for r in found)
    assert {q: [r.vec_id for r in found if r.query_id == q] for q in want} == want


def test_neighbours_of_sparse_parts_are_complete(spark):
    """Parts that hold fewer rows than are asked for: all parts are visited then."""
    rng = np.random.default_rng(6)
    x = np.r_[rng.normal(size=(600, 8)) * 0.02 + np.eye(8)[0], np.tile(-np.eye(8)[1], (3, 1))]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    router = neighbours.fit(vectors.filter("vec_id < 600"), "embedding", "vec_id", parts=8)
    # A router that files the three odd rows apart from all others and looks nowhere else.
    width = len(router.first[0])
    router.first, router.second = np.zeros((9, width)), np.zeros((width + 1, 8))
    router.first[1, 0], router.second[0, 3], router.second[-1, 5], router.probes = -1.0, 10.0, 1.0, 1
    found = neighbours.nearest(vectors, vectors.filter("vec_id >= 600"), router).orderBy("query_id", "rank").collect()
    want = plain_nearest(rows, [600, 601, 602])
    assert {q: [r.vec_id for r in found if r.query_id == q] for q in want} == want
    assert [r["rank"] for r in found] == [1, 2, 3, 4, 5] * 3


def test_running_total_over_ties_and_nulls(spark):
    rng = random.Random(0)
    rows = [(rng.choice(["a", "b", None]), i, rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, i long, v long")
    for within in (None, "k"):
        got = common.running_total(df, ["k", "i"], "v", "before", within).collect()
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
        sums, wanted = Counter(), {}
        for k, i, v in order:
            wanted[i] = sums[k if within else 0]
            sums[k if within else 0] += v
        assert {r.i: r.before for r in got} == wanted


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (300, 100)] + [(rng.randint(400, 500), 450) for _ in range(30)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {x: x for link in links for x in link}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_components_of_long_chains_in_random_order(spark):
    """A chain, one with links to two neighbours each way, and nodes that are linked with themselves only."""
    rng = random.Random(4)
    ids = rng.sample(range(10**6), 2500)
    chain, wide, alone = ids[:1500], ids[1500:2480], ids[2480:]
    links = list(zip(chain, chain[1:])) + list(zip(wide, wide[1:])) + list(zip(wide, wide[2:])) + list(zip(alone, alone))
    links = [link if rng.random() < 0.5 else link[::-1] for link in links]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: min(own) for own in (chain, wide, *([x] for x in alone)) for x in own}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_on_awkward_rows(spark, docs, empty):
    own = docs
    for name, stage in corpus_pipeline.STAGES:
        before, own = own, common.materialize(stage(spark, own, None))
        if name != "packing":
            assert own.columns == docs.columns and own.count() <= before.count()
    assert own.count() > 0
    rest = empty
    for _, stage in corpus_pipeline.STAGES:
        rest = common.materialize(stage(spark, rest, None))
    assert rest.count() == 0


def test_stages_keep_columns_of_any_name(spark, docs):
    """Names that the operators use inside, of other types, with a dot, and one of a set-aside column."""
    names = "kept n_spans n_bytes _row _own _sha _score _lang_pred lang_pred row print n gram first _id place name rate a.b _extra3 keep_id".split()
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    wide = plain
    for i, name in enumerate(names):
        wide = wide.withColumn(name, F.struct(F.lit(i).alias("x"), F.col("doc_id").alias("y")) if i % 2 else F.lit(f"v{i}"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, wide, None)
        assert got.columns == wide.columns, name
        own = sorted(map(str, got.select(*plain.columns).collect()))
        assert own == sorted(map(str, stage(spark, plain, None).collect())), name
        for i, column in enumerate(names):
            value = got.select(F.col(f"`{column}`")).distinct()
            assert i % 2 or [r[0] for r in value.collect()] == [f"v{i}"], (name, column)
    assert corpus_pipeline.pack(spark, wide, None).count() == corpus_pipeline.pack(spark, plain, None).count()


def test_stages_give_the_same_rows_in_small_batches(spark, docs):
    key, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", lambda df: sorted(map(str, df.collect()))
    stages, before = [corpus_pipeline.cut_passages, corpus_pipeline.pack], spark.conf.get(key)
    source = docs.filter("doc_id is not null")
    try:
        spark.conf.set(key, "5")
        small = [rows(stage(spark, source, "")) for stage in stages]
        assert spark.conf.get(key) == "5"  # a smaller setting stays
        spark.conf.set(key, "10000")
        assert [rows(stage(spark, source, "")) for stage in stages] == small
        assert spark.conf.get(key) == str(corpus_pipeline.BATCH_ROWS)
    finally:
        spark.conf.set(key, before)


def test_pipeline_ends_in_token_ids(spark, docs, empty):
    got = corpus_pipeline.pack(spark, docs, None).collect()
    assert got and all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    assert "ids" in corpus_pipeline.pack(spark, empty, None).columns


def test_pipeline_by_plain_definitions(spark, sf_dir):
    """Every stage on all that the one before kept, by brute force; only the language model is taken as it is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(common.materialize(stage(spark, steps[-1], sf_dir)))
    taken = [{r.doc_id: r.text for r in s.select("doc_id", "text").collect()} for s in steps[:-1]]
    assert len(taken[1]) == len(taken[0])  # clean prose in known languages
    best = {}
    for doc, text in sorted(taken[1].items()):
        best[lower(text)] = doc
    assert set(taken[2]) == set(best.values())
    labels = plain_components(list(taken[2].items()))
    assert set(taken[3]) == {d for d, (_, c) in labels.items() if c == d}
    removed = plain_removals(list(taken[3].values()), 200)
    for (doc, text), (size, n, _, digest) in zip(taken[3].items(), removed):
        now = taken[4][doc].encode()
        assert size - n - 6 <= len(now) <= size - n
        assert len(now) < size - n or hashlib.sha256(now).hexdigest() == digest
    assert {r.doc_id for r in steps[5].collect()} == set(taken[4])


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_queries_answer_for_every_row(name, spark, sf_dir):
    got = catalog.queries()[name](spark, sf_dir)
    documents, embeddings = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "embeddings"))
    key, source = {
        "op9": ("query_id", embeddings.filter("vec_id % 50 = 0")),
        "op11": ("vec_id", embeddings),
    }.get(name.split("_")[0], ("doc_id", documents))
    assert got.select(key).distinct().count() == source.count()
    assert isinstance(got.schema, T.StructType)
