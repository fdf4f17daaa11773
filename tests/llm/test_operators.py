"""Each corpus operator on small tables: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import glob
import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from contestry.llm import decontaminate, language_model, licences, mixing, ngram_join, quality, sharding, surrogates, toxicity, warc
from contestry.llm import common

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, texts, source=lambda i: f"s{i % 3}", ids=None):
    rows = [(ids[i] if ids else i, t, "en", source(i), len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n, vocabulary=500):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


ODD = [None, "", "  \n ", "word", prose(1, 30), prose(1, 30), prose(2, 4000), "a b \x0bc", "ünï \U0001f600 x"]
OPERATORS = [
    mixing.mix_words, licences.scan, language_model.score_documents, ngram_join.jaccard_components, quality.quality_digest,
    sharding.shard_digest, surrogates.surrogate_texts,
]


@pytest.mark.parametrize("operator", OPERATORS, ids=lambda f: f.__name__)
def test_odd_rows_all_come_back(spark, operator):
    docs = make(spark, ODD).union(make(spark, ["twice twice"], ids=[3])).union(make(spark, ["twice twice"], ids=[3])).union(make(spark, ["no id"], ids=[None]))
    assert operator(docs).count() == docs.count()


@pytest.mark.parametrize("operator", OPERATORS, ids=lambda f: f.__name__)
def test_empty_tables_stay_empty(spark, operator):
    assert operator(make(spark, ["x"]).where("false")).count() == 0


@pytest.mark.parametrize("operator", [ngram_join.one_of_each, quality.good_documents, mixing.mixed, lambda d: decontaminate.decontaminate(d, d.select(F.col("doc_id").alias("item_id"), "text").where("false"))])
def test_stages_keep_the_columns(spark, operator):
    clash = {"size": F.lit(1), "bucket": F.lit("b"), "node": F.lit(2), "kept": F.lit(True), "hits": F.lit(3), "n_words": F.lit("n")}
    docs = make(spark, [prose(i, 60) for i in range(6)]).withColumns(clash)
    out = operator(docs)
    assert out.columns == docs.columns and out.count() > 0
    assert operator(docs.where("false")).count() == 0


# 1: mixing


def test_mix_meets_targets_and_limits(spark):
    texts = [prose(i, 1 + i % 90) for i in range(600)]
    docs = make(spark, texts, lambda i: ["a", "b", None][i % 3] if i % 7 else "a")
    found = mixing.mix_words(docs).collect()
    again = {(r.doc_id): r.taken for r in mixing.mix_words(docs.repartition(3)).collect()}
    assert all(r.taken in (0, r.size, 2 * r.size) and again[r.doc_id] == r.taken for r in found)
    by = {}
    sources = {r.doc_id: r.source for r in docs.collect()}
    for r in found:
        s = by.setdefault(sources[r.doc_id], [0, 0, r.target, r.source_size])
        s[0] += r.taken
        s[1] += r.size
    assert all(abs(taken - target) <= 90 and size == source_size and target <= 2 * size for taken, size, target, source_size in by.values())
    assert abs(sum(s[2] for s in by.values()) - 1.5 * sum(s[1] for s in by.values())) < 1e-6


@pytest.mark.parametrize("clash", [False, True])
def test_a_cut_takes_some_of_the_rows_alike(spark, clash):
    # a source of 1,000 copies of one row, beside others: their target is met to half a row
    texts = ["ten words that are alike in all of these rows"] * 1000 + [prose(i, 20 + i) for i in range(60)]
    docs = make(spark, texts, lambda i: "b" if i < 1000 else "a", ids=[7] * 1000 + list(range(1000, 1060)))
    words = mixing.mix_words(docs.repartition(5))
    found = [(r.size, r.target, r.taken) for r in words.where("doc_id = 7").collect()]
    assert len(found) == 1000 and abs(sum(x[2] for x in found) - found[0][1]) <= 5 and len({x[2] for x in found}) == 2
    counts = lambda rows: Counter((r.doc_id, r.size, r.taken) for r in rows)
    assert counts(mixing.mix_words(docs.repartition(3)).collect()) == counts(words.collect())
    if clash:
        docs = docs.withColumns({"n": F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(3)), "some": F.lit("x"), "m": F.create_map(F.lit("k"), F.lit(1))})
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "size", "source_size", "target", "copies"] and mixed.count() == 1060
    assert mixed.where("doc_id = 7").agg(F.sum(F.col("size") * F.col("copies"))).first()[0] == sum(x[2] for x in found)


def test_targets_share_the_excess_by_weight(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 100)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert found["a"] == 20 and abs(found["b"] - 295 * 2 / 3) < 1e-9 and abs(found["c"] - 295 / 3) < 1e-9


# 2: licences


def test_sentences_about_a_copyright_holder_stay(spark):
    text = "You may copy the Package\nif the Copyright Holder agrees and the\nCopyright Holders are named, under\nCopyright Law or the\nCopyright Notice above."
    wrapped = "Copyright (c) 2001 Someone\n" + text.replace("the Copyright Holder agrees", "the\nCopyright Holder agrees")
    known = spark.createDataFrame([("Own-1.0", text.replace("\n", " "))], "licence string, text string")
    docs = make(spark, [text, wrapped, text.replace("Copyright Holders are", "owners are"), "Copyright Jane Doe\n" + text])
    assert [r.licence for r in licences.scan(docs, known).orderBy("doc_id").collect()] == ["Own-1.0", "Own-1.0", None, "Own-1.0"]


def test_licence_texts_match_in_any_dress(spark):
    dressed = licences.MIT.replace("<year> <copyright holders>", "2020 Somebody").upper().replace(",", " ;").replace("SUBLICENSE", "sub-licence")
    docs = make(spark, [licences.MIT, dressed, "Prose.\nLicensed under CC BY-NC 4.0.", "Licensed under CC BY-NC 4.0, or not", None])
    found = {r.doc_id: (r.licence, r.notices) for r in licences.scan(docs).collect()}
    assert {k: v[0] for k, v in found.items()} == {0: "MIT", 1: "MIT", 2: None, 3: None, 4: None}
    assert found[2][1] == "CC-BY-NC-4.0" and found[3][1] == ""


def test_wrapped_texts_and_own_lists_match(spark):
    import textwrap

    wrap = lambda t: "\n\n".join(textwrap.fill(p, 68) for p in t.split("\n\n"))
    isc = wrap(licences.ISC.replace("<year> <owner>", "2019, Jane Doe"))
    shifted = licences.ISC.replace("above copyright", "above\ncopyright").replace("Copyright (c) <year> <owner>", "Copyright Jane Doe")
    bsd = wrap(f"Copyright (c) 2001, Someone\nAll rights reserved.\n\n{licences.BSD_HEAD}\n\n{licences.BSD_THIRD}\n\n{licences.BSD_TAIL}")
    texts = [isc, shifted, bsd, licences.UNLICENSE, "my own licence text", "sublicence and licences", "sublicense and licenses"]
    found = {r.doc_id: r for r in licences.scan(make(spark, texts)).collect()}
    assert [found[i].licence for i in range(5)] == ["ISC", "ISC", "BSD-3-Clause", "Unlicense", None]
    assert found[5].digest == found[6].digest
    own = spark.createDataFrame([("Own-1.0", "My own (licence) TEXT!"), ("None", "...")], "licence string, text string")
    assert [r.licence for r in licences.scan(make(spark, texts), own).orderBy("doc_id").collect()] == [None] * 4 + ["Own-1.0", None, None]


# 3: language model


def test_base_scores_equal_brute_force(spark):
    texts = [prose(i, 20 + i) for i in range(40)] + [None, "", "Rare WORD"]
    found = {r.doc_id: r for r in language_model.score_documents(make(spark, texts)).collect()}
    split = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))}
    words = {i: [*(t or "").lower().split(), ""] for i, t in enumerate(texts)}
    counts = Counter(itertools.chain.from_iterable(w for i, w in words.items() if not split[i]))
    n, v = sum(counts.values()), len(counts)
    for i, w in words.items():
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (split[i], len(w), sum(counts[x] > 0 for x in w), n)
        assert abs(r.base_score - base) < 1e-6 and r.score < 0


def test_trained_model_beats_the_unigram_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_model.score_documents(docs).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert rows[0] / rows[2] > rows[1] / rows[2] + 0.05


def test_texts_score_alike_whatever_lies_beside_them(monkeypatch):
    import pyarrow as pa

    texts = [prose(1, 700, 50), prose(2, 3, 50), "", None, prose(3, 65, 50), "never seen words"]
    known = _vocabulary(texts[:2])
    scorer = language_model.Scorer(known, np.random.default_rng(1).normal(0, 0.3, len(language_model.Network(known).flat)))
    scores = lambda *parts: [x for made in scorer([scorer.prepared(pa.array(p, pa.string())) for p in parts]) for x in made[3].to_pylist()]
    together, alone = scores(texts), [scores([t])[0] for t in texts]
    monkeypatch.setattr(language_model, "STEPS", 5)
    monkeypatch.setattr(language_model, "SCORE_LANES", 2)
    assert np.allclose(together, alone, rtol=1e-4) and np.allclose(together, scores(texts[:2], texts[2:]), rtol=1e-4)


def _vocabulary(texts):
    import pyarrow as pa

    words, rare, _ = language_model.tokens_of(pa.array(texts))
    words, rare, c = language_model._summed(words, rare, np.ones(len(words), np.int64))
    order = np.argsort(-c, kind="stable")
    n = language_model.RARE
    return language_model.Vocabulary(words[order], rare[order], c[order], int(c.sum()), len(c), np.ones(n), np.ones(n))


def _ids(known, texts):
    import pyarrow as pa

    words, rare, offsets = language_model.tokens_of(pa.array(texts))
    return known.ids(rare, known.places(words)), offsets


def test_gradients_match_differences(monkeypatch):
    monkeypatch.setattr(language_model, "FREQUENT", 64)
    texts = [prose(i, 12, 60) for i in range(3)]
    known = _vocabulary(texts)
    net = language_model.Network(known)
    net.Wc[...] *= 10
    ids = _ids(known, texts)[0].reshape(3, 13).T
    h = np.zeros((3, language_model.HIDDEN), np.float32)
    inputs = np.vstack([ids[:1] * 0, ids[:-1]])

    def loss():
        states, _ = net.forward(inputs, h)
        return -float(net.loss(states.reshape(-1, language_model.HIDDEN), ids.ravel())[0].sum())

    grads = {n: np.zeros(net.shapes[n], np.float32) for n in ("U", "b", "Wc", "Ww")}
    states, kept = net.forward(inputs, h)
    _, d = net.loss(states.reshape(-1, language_model.HIDDEN), ids.ravel(), grads)
    net.backward(inputs, kept, d.reshape(states.shape), grads)
    for name in ("U", "b", "Wc", "Ww"):
        where = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        weights, step = getattr(net, name), 1e-2
        weights[where] += step
        up = loss()
        weights[where] -= 2 * step
        down = loss()
        weights[where] += step
        assert abs((up - down) / (2 * step) - grads[name][where]) < 0.05 * abs(grads[name][where]) + 1e-2


def test_training_beats_the_start(monkeypatch):
    monkeypatch.setattr(language_model, "LANES", 8)
    texts = ["a b c d e f " * 20] * 40
    known = _vocabulary(texts)
    ids, offsets = _ids(known, texts)
    shards = list(language_model.gathered(iter([(ids, offsets)] * 25), 24 * len(ids) + 1))
    assert len(shards) == 1 and len(list(language_model.gathered(iter([(ids, offsets)] * 25), 4 * len(ids)))) == 7
    ((weights, seen),) = language_model.train_part(known, None, iter(shards))

    def total(w):
        return sum(float(lp.sum()) for _, _, lp in language_model.windows(language_model.Network(known, w), ids, offsets, 8))

    assert seen == 25 * len(ids) and total(weights) > 0.5 * total(None)


def test_told_words_grow_with_the_vocabulary():
    n = language_model.RARE
    for v in (600, 5_000, 300_000):
        words, rare = np.random.default_rng(v).permutation(np.arange(1, 10**6, dtype=np.uint64))[:v] * np.uint64(0x9E3779B97F4A7C15), np.arange(v, dtype=np.int32) % n
        known = language_model.Vocabulary(words, rare, np.arange(v, 0, -1), v * (v + 1) // 2, v, np.ones(n), np.ones(n))
        told = min(v, language_model.frequent_words(v))
        assert known.places(words).tolist() == list(range(v)) and (known.places(words + np.uint64(1)) < 0).sum() > 0.9 * v
        assert len(set(known.ids(rare[:told], known.places(words[:told])).tolist())) == told >= min(v, 1024)
        net = language_model.Network(known)
        every = np.concatenate([np.arange(told), known.frequent + np.arange(n)])
        logp, _ = net.loss(np.full((len(every), language_model.HIDDEN), 0.3, np.float32), every)
        assert abs(np.exp(logp).sum() - 1) < 1e-3
    assert language_model.frequent_words(10**6) > language_model.frequent_words(300_000) > 1024


# 4: toxicity


def test_held_out_toxicity(spark):
    r = random.Random(5)
    texts, toxic = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = prose(i, 40, 5000).split()
        if bad:
            for _ in range(1 + i % 5):
                words[r.randrange(40)] = r.choice(["nasty", "horrid", "vile"])
        texts.append(" ".join(words))
        toxic.append((i, int(bad)))
    docs, labels = make(spark, texts), spark.createDataFrame(toxic, "doc_id long, toxic int")
    model = toxicity.train(docs, labels.where("doc_id < 200"))
    found = {x.doc_id: x for x in toxicity.severity(docs, model).collect()}
    assert all(found[i].toxic == bool(t) for i, t in toxic if i >= 200)
    assert list(model.cuts) == sorted(model.cuts)
    assert found[204].severity > found[200].severity or found[204].grade >= 1


def test_toxicity_without_labels(spark):
    docs = make(spark, ODD)
    labels = spark.createDataFrame([(0, None), (None, 1)], "doc_id long, toxic int")
    assert [r.toxic for r in toxicity.toxicity(docs, labels).collect()] == [False] * len(ODD)


def test_labels_behind_one_banner_all_count(spark):
    banner = "please note that this page is an archived copy of the original"
    texts = [f"{banner} {prose(i, 40)}{' vile scum' if i % 4 == 0 else ''}" for i in range(120)] + ["", None, "  "]
    docs = make(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 120 and i % 4 == 0)) for i in range(123) if i % 3], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, labels)
    assert sample.count() == sum(1 for i in range(120) if i % 3)
    found = {r.doc_id: r.toxic for r in toxicity.toxicity(docs, labels).collect()}
    assert all(found[i] == (i % 4 == 0) for i in range(120)) and not (found[120] or found[121])


def test_ordinal_likelihood_and_gradient_equal_brute_force():
    r = np.random.default_rng(5)
    x = r.integers(0, 3, (12, 4)).astype(float)
    grades, p = r.integers(0, toxicity.GRADES, 12), np.array([0.4, 0.0, 1.1, 0.3, 0.2, -0.3, 0.1])
    rows, cols = np.nonzero(x)
    args = (rows, cols, x[rows, cols], grades, 4, 0.1)

    def brute(p):
        w, c = p[:4], [p[4], p[4] + math.exp(p[5]), p[4] + math.exp(p[5]) + math.exp(p[6])]
        total = 0.1 * sum(w * w) / 2
        for row, g in zip(x, grades):
            above = [1.0, *(1 / (1 + math.exp(cut - row @ w)) for cut in c), 0.0]
            total -= math.log(above[g] - above[g + 1])
        return total / 12

    value, g = toxicity.objective(p, *args)
    assert abs(value - brute(p)) < 1e-9
    for i in range(len(p)):
        step = np.eye(len(p))[i] * 1e-5
        assert abs((brute(p + step) - brute(p - step)) / 2e-5 - g[i]) < 1e-6
    w, cuts = toxicity.fit_ordinal(*args[:5], penalty=0.1)
    best = toxicity.objective(np.concatenate([w, [cuts[0]], np.log(np.diff(cuts))]), *args)[0]
    for _ in range(200):
        near = np.concatenate([np.maximum(w + r.normal(0, 0.1, 4), 0), [cuts[0] + r.normal(0, 0.1)], np.log(np.diff(cuts)) + r.normal(0, 0.1, 2)])
        assert toxicity.objective(near, *args)[0] > best - 1e-4


def test_severities_equal_brute_force(spark):
    model = toxicity.Model({"vile": 0, "scum*": 1}, np.array([1.5, 0.7]), np.array([0.5, 1.0, 2.5]))
    texts = ["vile vile scums", "Scumbag!", "fine", None, "vile " * 5000]
    for row in toxicity.severity(make(spark, texts).withColumn("GRADE", F.lit(9)), model).collect():
        w = (row.text or "").lower().split()
        line = 1.5 * math.log1p(w.count("vile")) + 0.7 * math.log1p(sum(x.strip("!").startswith("scum") and len(x.strip("!")) > 4 for x in w))
        above = [1 / (1 + math.exp(c - line)) for c in (0.5, 1.0, 2.5)]
        each = [a - b for a, b in zip([1, *above], [*above, 0])]
        assert abs(row.severity - sum(above)) < 1e-9 and row.toxic == (above[0] >= 0.5) and row.grade == each.index(max(each))


# 5: n-gram Jaccard join


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


def test_join_equals_brute_force(spark, monkeypatch):
    r = random.Random(3)
    passage, texts = prose(99, 60), [None, "", "one two", "One TWO", "one two three four five"]
    for g in range(12):
        words = prose(g, r.choice([30, 80, 200])).split()
        for _ in range(r.randrange(1, 9)):  # chains of small changes
            words = list(words)
            words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
            texts.append(" ".join(words) + (f" {passage}" if g % 2 else ""))
    texts += [f"{prose(1000 + i, 15)} {passage}" for i in range(40)] + [texts[8]] * 5
    for list_block in (2_000_000, 300):
        monkeypatch.setattr(ngram_join, "LIST_BLOCK", list_block)
        found = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.jaccard_components(make(spark, texts)).collect()}
        assert found == brute_components(texts)


def family(size, seed=5):
    """Copies of one text with 1 to 20 words changed, most of them to one of a few others."""
    r, words = random.Random(seed), prose(seed, 120).split()
    out = []
    for _ in range(size):
        copy = list(words)
        for i in r.sample(range(120), r.randrange(1, 20)):
            copy[i] = f"new{r.randrange(12)}"
        out.append(" ".join(copy))
    return out


def test_large_families_equal_brute_force_and_list_few_pairs(spark):
    texts = [*family(400), *(prose(i, 60) for i in range(20))]
    docs = make(spark, texts)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.jaccard_components(docs).collect()} == brute_components(texts)
    nodes = ngram_join.peeled(docs.select("text"), ngram_join.text_rows, 100_000)[0].withColumn("node", F.monotonically_increasing_id()).persist()
    posts = ngram_join.postings(nodes)
    pairs = ngram_join.pivot_pairs(posts)
    assert 0 < pairs.count() < 4 * len(texts)
    roots = ngram_join.components(ngram_join.linked(pairs, nodes))
    assert ngram_join.cross_links(posts, roots, nodes).count() < len(texts)
    nodes.unpersist()


@pytest.mark.parametrize("often", [1, 4, 1000])
def test_row_blocks_come_back_with_their_shared_shingles(monkeypatch, often):
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "OFTEN", often)
    monkeypatch.setattr(ngram_join, "ROW_BLOCK", 400)
    monkeypatch.setattr(ngram_join, "TaskContext", type("Task", (), {"get": lambda: type("T", (), {"partitionId": lambda self: 3})()}))
    texts = [*family(30), *(prose(i, 40, 3000) for i in range(10)), None, "", "few words"]
    batches = list(ngram_join.row_blocks(ngram_join.text_rows, 7)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])))
    sent = pa.Table.from_batches(batches)
    back = pa.concat_tables([ngram_join.counted(sent.filter(pa.array(sent["col"].to_numpy() == c))) for c in range(7)])
    rows = pa.concat_tables([ngram_join.restored(80)(back.filter(pa.array(back["base"].to_numpy() == b))) for b in np.unique(back["base"].to_numpy())])
    assert len(batches) > 3
    counts = Counter(g for t in texts for g in shingles(t))
    wanted = sorted((len(x), sum(counts[g] > 1 for g in x)) for x in map(shingles, texts) if x and 100 * sum(counts[g] > 1 for g in x) >= 80 * len(x))
    assert wanted == sorted((n, len(t) // 8) for n, t in zip(rows["n"].to_pylist(), rows["tokens"].to_pylist()))


def test_shingle_sets_follow_words_not_bytes(monkeypatch):
    import pyarrow as pa
    from contestry.llm import shingles as hashed

    texts = ["", None, "a", "A b", "a  B\n", "b a", " lead", "trail ", "x" * 300, "e\u0301 \u00df \u2003 z", "one two three four five six one two three four five six", *ODD, *family(5)]
    for slab in (4 << 20, 16):
        monkeypatch.setattr(hashed, "SLAB", slab)
        sets = hashed.shingle_sets(pa.array(texts).slice(1))
        assert sets.sizes.tolist() == [len(shingles(t)) for t in texts[1:]]
        parts = [set(sets.part(i, i + 1).tokens.tolist()) for i in range(len(texts) - 1)]
        for a, b in itertools.combinations(range(len(texts) - 1), 2):
            assert len(parts[a] & parts[b]) == len(shingles(texts[a + 1]) & shingles(texts[b + 1]))


def test_components_of_a_long_chain(spark):
    n = 60
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])) + [(100, 101), (101, 102)], "a long, b long")
    found = {r.node: r.root for r in ngram_join.components(links).collect()}
    assert found == {**{i: 0 for i in range(n)}, 100: 100, 101: 100, 102: 100}


def test_one_document_of_each_group_stays(spark):
    text = prose(7, 50)
    docs = make(spark, [text, text, prose(8, 50), None, text], ids=[4, 2, 5, 6, 2])
    assert sorted((r.doc_id, r.text) for r in ngram_join.one_of_each(docs).collect()) == sorted([(2, text), (5, prose(8, 50)), (6, None)], key=lambda x: x[0])


# 6: quality rules


def test_host_of_failures_loses_all_its_documents(spark):
    texts = [prose(i, 40) for i in range(60)]
    bad = ["short"] * 30 + [prose(500, 40)]
    docs = make(spark, texts + bad, lambda i: ["x", "y", "z"][i % 3] if i < 60 else "junk")
    found = {r.doc_id: r for r in quality.quality_digest(docs).collect()}
    assert all(found[i].kept for i in range(60)) and not any(found[i].kept for i in range(60, 91)) and not found[90].base_failed


def test_repeats_equal_brute_force(spark):
    r = random.Random(2)
    texts = [" ".join(r.choice("abc") for _ in range(n)) for n in (5, 8, 9, 20, 60, 300)] + ["x y\nx y\n\n\nz\nx y", "#a$ <b>|" * 3]
    for row, text in zip(quality.quality_digest(make(spark, texts)).orderBy("doc_id").collect(), texts):
        w = text.split()
        grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        hit = {p for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
        lines = [x for x in text.split("\n") if x.split()]
        assert (row.n_words, row.n_repeat_words, row.n_dup_lines) == (len(w), len(hit), len(lines) - len(set(lines)))
        assert row.n_symbols == sum(c in "#*$%&|<>" for c in text) and row.word_chars == sum(map(len, w))


# 7: sharding


def test_shards_are_even_gapless_and_shuffled(spark):
    docs = make(spark, [f"text {i}" for i in range(1003)])
    out = sharding.assign_shards(docs, shards=10, bucket_bytes=500).collect()
    sizes = Counter(r.shard for r in out)
    assert set(sizes.values()) == {100, 101} and len({r.doc_id for r in out}) == 1003
    for k in range(10):
        assert sorted(r.slot for r in out if r.shard == k) == list(range(sizes[k]))
    ids = [r.doc_id for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    assert abs(np.corrcoef(ids, range(1003))[0, 1]) < 0.2


def test_reruns_agree_over_any_partitions(spark):
    docs = make(spark, [f"text {i // 3}" for i in range(900)] + ["same"] * 100, ids=[*range(900), *[7] * 100])
    runs = [sorted((r.shard, r.slot, r.doc_id, r.text) for r in sharding.assign_shards(docs.repartition(n), shards=7, bucket_bytes=400).collect()) for n in (5, 7)]
    assert runs[0] == runs[1] and len(runs[0]) == 1000
    same = Counter(shard for shard, _, _, text in runs[0] if text == "same")
    assert sum(same.values()) == 100 and max(same.values()) < 40


def test_shards_are_those_of_a_plain_run(spark):
    """Buckets, their order, the permutation of its numbers and the ranges of the shards, one record at a time; Spark only hashes."""
    docs = make(spark, [prose(i, 5 + i % 40) for i in range(300)] + [None, "", "same", "same"], ids=[*range(300), None, 7, 8, 8])
    shards, seed = 7, sharding.SEED
    volume = sum(len((r.text or "").encode()) + 16 for r in docs.collect())
    buckets = max(sharding.LEAST_BUCKETS, -(-volume // 500))
    hashed = docs.withColumn("copy", F.lit(0))
    draws = [sharding.record_hash(docs, seed + k, "copy").alias(n) for k, n in enumerate("hab")]
    by_bucket = {}
    for r in hashed.select("doc_id", "text", *draws).collect():
        by_bucket.setdefault(r.h % buckets, []).append(r)
    numbers = spark.createDataFrame([(b, at) for b, rows in by_bucket.items() for at in range(1, len(rows) + 1)], "bucket long, at int")
    drawn = {(r.bucket, r["at"]): r.draw for r in numbers.withColumn("draw", F.xxhash64(F.lit(seed + 3), "bucket", "at")).collect()}
    order = []
    for b in sorted(by_bucket):
        rows = sorted(by_bucket[b], key=lambda r: (r.a, r.b))
        order += [rows[at - 1] for at in sorted(range(1, len(rows) + 1), key=lambda at: drawn[b, at])]
    wanted, first = Counter(), {}
    for place, r in enumerate(order):
        shard = place * shards // len(order)
        wanted[r.doc_id, r.text, shard, place - first.setdefault(shard, place)] += 1
    found = sharding.assign_shards(docs.repartition(3), shards=shards, bucket_bytes=500).collect()
    assert Counter((r.doc_id, r.text, r.shard, r.slot) for r in found) == wanted


def test_rows_that_cannot_be_compared_are_sharded_too(spark):
    docs = make(spark, [f"text {i % 5}" for i in range(100)]).withColumns({"m": F.create_map(F.lit("a"), F.col("doc_id")), "draw": F.lit(1), "copy": F.lit("c")})
    out = sharding.assign_shards(docs, shards=4)
    assert out.columns == [*docs.columns, "shard", "slot"] and len({(r.shard, r.slot) for r in out.collect()}) == 100


def test_whole_documents_are_written_to_shards(spark):
    texts = ["wörd " * 200_000, None, "", *["same"] * 300, *(prose(i, 30) for i in range(200))]
    docs = make(spark, texts, ids=[0 if t == "same" else i for i, t in enumerate(texts)])
    folders = lambda: set(glob.glob(f"{common.shared_dir(spark)}/shards-*".removeprefix("file://").removeprefix("file:")))
    before = folders()
    out = sharding.shard_digest(docs).collect()
    (made,) = folders() - before
    assert len(glob.glob(f"{made}/shard=*")) == sharding.SHARDS
    files = {(r.shard, r.slot): r for r in spark.read.parquet(f"file://{made}").collect()}
    assert Counter(r.text for r in files.values()) == Counter(texts) and len(files) == len(out) == len(texts)
    for r in out:
        data = (files[r.shard, r.slot].text or "").encode()
        assert (r.doc_id, r.size, r.text_crc32) == (files[r.shard, r.slot].doc_id, len(data) + 16, zlib.crc32(data))


# 8: decontamination


def brute_hits(words, items):
    hit, found = set(), set()
    for item, w in items:
        n = min(13, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return hit, found


@pytest.mark.parametrize("block_words", [400_000, 40])
def test_search_equals_brute_force(spark, block_words):
    r = random.Random(4)
    items = [(i, prose(i, n, 40)) for i, n in enumerate([1, 2, 5, 13, 14, 30, 60])] + [(8, ""), (9, None), (None, "w1 w2")]
    texts = [None, "", "W3-w4, w5"] + [prose(200 + i, 50, 40) for i in range(20)]
    texts += [f"{prose(300 + i, 30)} {' '.join(r.choice(items[4:7])[1].split()[:20])} {prose(400 + i, 30)}" for i in range(10)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.search_items(make(spark, texts), bench, "hits", block_words).select("doc_id", "hits", decontaminate.hit_words(F.col("hits")).alias("n")).collect()
    for row in found:
        words = decontaminate.tokens(texts[row.doc_id])
        hit, names = brute_hits(words, [(str(i), decontaminate.tokens(t)) for i, t in items if i is not None])
        assert (row.hits.n_words, row.n, set(row.hits["items"])) == (len(words), len(hit), names)


def test_one_block_of_patterns_at_a_time(spark):
    bench = spark.createDataFrame([(i, prose(i, 30)) for i in range(6)], "item_id long, text string")
    docs = make(spark, [prose(i, 200) for i in range(5)] + [None]).withColumns({"row_": F.lit(1), "hits": F.lit("x")})
    found = decontaminate.search_items(docs, bench, "hits", block_words=40)
    assert found.count() == 6 and set(found.columns) == set(docs.columns)
    assert [sorted(r.hits["items"]) for r in found.orderBy("doc_id").collect()] == [[] if i > 4 else [str(i)] for i in range(6)]


def test_no_items_have_the_digest_of_nothing(spark):
    bench = spark.createDataFrame([(1, prose(1, 20))], "item_id long, text string")
    row = decontaminate.contamination(make(spark, ["clean"]), bench).first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest() and not row.contaminated


# 9: surrogates


def test_surrogates_keep_type_format_and_identity(spark):
    texts = ["write to Ann.Lee@mail.example.com, ANN.LEE@mail.example.com", "call +1 (017) 555-7713 or +1-017-555-7713", "card 4845168114407329 not 4845168114407328", "from 10.2.3.4.", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "Mrs. Anna Smith and Mr. Smith", "nothing 3.14 here 1234567", None]
    found = {r.doc_id: r for r in surrogates.surrogate_texts(make(spark, texts)).collect()}
    a, b = found[0].text.removeprefix("write to ").split(", ")
    assert a.lower() == b.lower() != "ann.lee@mail.example.com" and a.endswith(".com") and a[0].isupper()
    x, y = (["".join(c for c in t if c.isdigit()) for t in found[1].text.removeprefix("call ").split(" or ")])
    assert x == y != "10175557713" and x.startswith("1")
    assert found[2].text.endswith("not 4845168114407328") and "4845168114407329" not in found[2].text
    assert found[4].text.startswith('token = "') and len(found[4].text) == len(texts[4]) and "04dbebab" not in found[4].text
    assert "Smith" not in found[5].text and found[5].text.split()[2] == found[5].text.split()[-1]
    assert found[6].text == texts[6] and found[6].n_entities == 0 and found[7].text is None


def test_colliding_surrogates_are_drawn_again(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "SYLLABLES", {k: [v[0]] for k, v in surrogates.SYLLABLES.items()})
    texts = [f"Mr. {n}" for n in ("Able", "Baker", "Cole")]
    found = [r.text for r in surrogates.surrogate_texts(make(spark, texts)).collect()]
    assert len(set(found)) == 3


def test_formats_that_are_used_up_widen(spark):
    import string

    texts = [" ".join(f"{a}@{b}.co" for a in string.ascii_lowercase for b in string.ascii_lowercase)]
    (row,) = surrogates.surrogate_texts(make(spark, texts)).collect()
    assert row.n_entities == 676 and len(set(row.text.split())) == 676 and not set(row.text.split()) & set(texts[0].split())


def test_names_keep_script_and_person(spark):
    texts = ["Mr. John Smith came. Later Smith left; Smithson stayed, SMITH.", "Mr. Smith and Mrs. Anna Smith", "Κύριος Κώστα", "Госпожа Анна Ким-Петрова", "Mr. 王伟 came", "Mr. Jean-Luc O'Neil", "\ufdd0 Mr. Smith \ufdd1"]
    found = {r.doc_id: r.text for r in surrogates.surrogate_texts(make(spark, texts)).collect()}
    smith = found[1].split()[1]
    assert found[0].split()[2] == f"{smith}" and found[0].split()[3] == "came." or found[0].split()[2].rstrip(".") == smith
    assert "Smithson" in found[0] and f"Later {smith} left" in found[0] and "SMITH" in found[0] and found[1].split()[-1] == smith
    assert found[2].split()[0] == "Κύριος" and all("α" <= c.lower() <= "ω" for c in found[2].split()[1])
    assert "Петрова" not in found[3] and found[3].count("-") == 1 and all(c in " -" or "а" <= c.lower() <= "я" for c in found[3])
    assert "王伟" not in found[4] and all("\u4e00" <= c <= "\u9fff" for c in found[4].split()[1]) and found[4].endswith(" came")
    first, last = found[5].split()[1:]
    assert first.count("-") == 1 and last.count("'") == 1 and "Luc" not in first and "Neil" not in last
    assert found[6].startswith("\ufdd0 Mr. ") and found[6].endswith(f"{smith} \ufdd1")


def test_numbers_beside_others_are_found(spark):
    texts = ["4111 1111 1111 1111 12/26", "4845168114407329 123", "2023 555-123-4567", "+33 6 12 34 56 78", "IBAN DE89 3704 0044 0532 0130 00.", "XX00 1234 5678 9012", "from 2001:db8:0:0:1:0:0:1 or fe80::1:2", "a::b std::c 12:30:45"]
    found = {r.doc_id: r for r in surrogates.surrogate_texts(make(spark, texts)).collect()}
    assert [found[i].kinds for i in range(8)] == ["card", "card", "phone", "phone", "iban", "", "ipv6", ""]
    assert "4111 1111" not in found[0].text and found[0].text.endswith(" 12/26") and found[2].text.startswith("2023 ") and found[2].text != texts[2]
    code = found[4].text.removeprefix("IBAN ").rstrip(".").replace(" ", "")
    assert code[:2] == "DE" and code != "DE89370400440532013000" and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1
    assert found[6].n_entities == 2 and found[7].text == texts[7] and found[5].text == texts[5]


def test_each_text_is_searched_once_a_stage(spark, monkeypatch):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    plans = []
    monkeypatch.setattr(surrogates, "written", lambda df, *a: (plans.append(plan(df)), common.written(df, *a))[1])
    out = surrogates.surrogate_texts(make(spark, ["to ann@mail.example.com", "Mr. Smith"]))
    # a search has the pattern twice: what lies between entities, and the entities
    assert plans[0].count(surrogates.ENTITY) == 2 and plan(out).count(surrogates.ENTITY) == 2


def test_no_entity_is_passed_over_for_want_of_a_hint(spark):
    texts = ["from a:b:c:d:e:f:a:b", "from fe::a:b", "(Token: abcdefghijk", "_PASSWD='abcdefghijk", "my api_key=abcdefghijk", "éMr. Smith, Mr. Jones", "«Señora Núñez»", "Госпожа Анна", "Κυρία Κώστα", "v10.2.3.4", "x4845168114407329", "a+b@c.de"]
    docs = make(spark, [*texts, "subscript tokens, Mrs, Srs. a:g:b, unsecret, mistoken=abcdefghijk"])
    held = F.regexp_count("text", F.lit("|".join([surrogates.EMAIL, surrogates.SECRET, surrogates.IP, surrogates.IPV6, surrogates.CARD, surrogates.NAME])))
    found = {r.doc_id: r for r in surrogates.surrogate_texts(docs).collect()}
    wanted = {r.doc_id: r.n for r in docs.select("doc_id", held.alias("n")).collect()}
    assert {i: r.n_entities for i, r in found.items()} == wanted and [i for i, n in wanted.items() if not n] == [3, 12]
    assert found[0].kinds == "ipv6" and found[0].text != texts[0]


# 10: WARC


def test_archives_round_trip(spark, tmp_path):
    big = "é" * 600
    pages = spark.createDataFrame([(1, "http://a/\r\nx", big), (2, "http://b", big), (3, None, None), (4, "http://d", "small"), (5, "http://e", "small")], "page_id long, url string, html string")
    found = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert found[1].record_type == "revisit" and found[1].refers_to == 2 and found[1].payload_bytes == 1200
    assert found[1].payload_digest == found[2].payload_digest == hashlib.sha1(big.encode()).hexdigest()
    assert [found[i].record_type for i in (2, 3, 4, 5)] == ["response"] * 4
    assert warc.round_trip(pages.where("false")).count() == 0


def test_headers_come_back_as_written(spark, tmp_path):
    pages = spark.createDataFrame([(1, " http://a/%0D\r\nx\u00e9 ", "x"), (1, "http://b", "y" * 2000), (None, "http://b", "y" * 2000), (2, None, None)], "page_id long, url string, html string")
    warc.register(spark)
    path = str(tmp_path / "w")
    records = warc.to_records(pages).withColumn("content_type", F.when(F.col("page_id") == 2, "image/png").otherwise(F.col("content_type")))
    records.write.format("warc").mode("append").save(path)
    back = spark.read.format("warc").load(path)
    columns = [c for c in back.columns if c != "payload"]
    key = lambda rows: sorted(map(str, rows))
    assert key(back.select(columns).collect()) == key(records.select(columns).collect())
    assert back.where("content_type like 'text/html%'").count() == 3 and back.where("content_type = 'image/png'").count() == 1
    records.write.format("warc").mode("append").save(path)
    assert spark.read.format("warc").load(path).count() == 8 and len(list((tmp_path / "w").glob("_manifest-*.json"))) == 2
    records.limit(1).write.format("warc").mode("overwrite").save(path)
    assert spark.read.format("warc").load(path).count() == 1 and len(list((tmp_path / "w").glob("*.warc.gz"))) == 1


def test_records_of_other_writers_tell_their_type(spark, tmp_path):
    import gzip

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/css\r\n\r\nbody"
    record = lambda kind, block: b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: " + kind + b"\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(record(b"application/http; msgtype=response", http)) + gzip.compress(record(b"text/dns", b"x")))
    warc.register(spark)
    read = spark.read.format("warc").load(str(tmp_path))
    assert sorted((r.content_type, bytes(r.payload)) for r in read.collect()) == [("text/css", b"body"), ("text/dns", b"x")]
    assert read.where("content_type = 'text/css'").count() == 1


def test_header_filters_are_pushed_and_skip_payloads(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://h{i % 2}/{i}", "x" * 10 * i) for i in range(20)], "page_id long, url string, html string")
    warc.register(spark)
    path = str(tmp_path / "w")
    warc.to_records(pages).write.format("warc").mode("append").save(path)
    df = spark.read.format("warc").load(path).where("target_uri like 'http://h1/%' and page_id > 10")
    assert sorted(r.page_id for r in df.select("page_id").collect()) == [11, 13, 15, 17, 19]
    bare = spark.read.format("warc").option("payload", "false").load(path)
    assert bare.where("payload is not null").count() == 0 and bare.count() == 20
    reader = warc.WarcReader({"path": path})
    from pyspark.sql.datasource import EqualTo

    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit")])) == [] and len(reader.partitions()) >= 1
    assert list(itertools.chain.from_iterable(map(reader.read, reader.partitions()))) == []


# shared


def test_most_counted_stays_within_its_bound(spark):
    counts = spark.createDataFrame([(i, i + 1) for i in range(100)], "k long, n long")
    top = common.most_counted(counts, "n", 10).collect()
    assert 0 < len(top) <= 10 and min(r.n for r in top) > 80


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert set(docs.columns) < set(out.columns) and out.count() > 0
    assert out.join(docs, "doc_id", "left_anti").count() == 0


def test_rejected_records_of_other_writers_are_not_read():
    import io

    class Counted(io.BytesIO):
        most = 0

        def read(self, n=-1):
            got = super().read(n)
            self.most = max(self.most, len(got))
            return got

    def record(kind, http, payload):
        block = http + payload
        return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    plain, page = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n\r\n", b"HTTP/1.1 200 OK\r\nX: " + b"x" * 20_000 + b"\r\nContent-Type: text/html\r\n\r\n"
    data = record("response", plain, b"a" * 5_000_000) + record("response", page, b"<p>") + record("request", page, b"b" * 3_000_000)
    for conditions, kept in (([("record_type", "equal", "nothing")], 0), ([("content_type", "equal", "text/html")], 2), ([("content_type", "equal", "text/html"), ("record_type", "equal", "response")], 1)):
        reader = warc.WarcReader({"path": "x"})
        reader.conditions = [warc.Condition(c, next(t for f, t in warc.TESTS.items() if f.__name__ == "EqualTo"), v) for c, _, v in conditions]
        stream = Counted(data)
        found = list(reader.records(stream))
        assert len(found) == kept and (stream.most < 200_000 or kept == 2)
    names = list(warc.HEADERS)
    assert [r[names.index("content_type")] for r in found] == ["text/html"] and found[0][-1] == b"<p>"
