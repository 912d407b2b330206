import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import neardup
from tidemark.llm.components import components
from tidemark.llm.neardup import document_frequencies, drop_near_duplicates, near_duplicates
from tidemark.llm.shingles import Idf, WeightedSampler, shingles, weighted_jaccard


def _plain(texts, words=5):
    """Shingles with the words themselves."""
    out = []
    for t in texts:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        runs = [tuple(w[i:i + words]) for i in range(max(len(w) - words, 0) + 1)] if w else []
        out.append({r: runs.count(r) for r in set(runs)})
    return out


@pytest.fixture(scope="module")
def texts():
    random.seed(2)
    vocabulary = [f"w{i}" for i in range(500)]
    out = []
    for _ in range(40):
        base = [random.choice(vocabulary) for _ in range(random.choice([3, 6, 60, 200]))]
        out.append(" ".join(base))
        for _ in range(random.randint(0, 4)):
            copy = list(base)
            for _ in range(random.choice([1, 1, 2, 8, 20])):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            out.append(random.choice([" ", "\n"]).join(copy).upper())
    line = " ".join(random.choice(vocabulary) for _ in range(12))
    out += [line + " " + " ".join(random.choice(vocabulary) for _ in range(15)) for _ in range(40)]  # one common line
    out += [out[0]] * 5 + ["", "", " \n", "a", "a", "A", "a b", "ß é ü", "x " * 3000, "x " * 3000 + "y"]
    return out


def test_shingles_against_words(texts):
    of, hashes, n = shingles(pa.array(texts + [None]))
    plain = _plain(texts + [None])
    assert np.bincount(of, minlength=len(plain)).tolist() == [len(p) for p in plain]
    assert np.bincount(of, n, len(plain)).tolist() == [sum(p.values()) for p in plain]
    names = {}
    for i, p in enumerate(plain):
        assert sorted(p.values()) == sorted(n[of == i].tolist())
        for s in p:
            names.setdefault(s, set()).add(i)
    where = {}
    for i, h in zip(of.tolist(), hashes.tolist()):
        where.setdefault(h, set()).add(i)
    assert sorted(map(sorted, where.values())) == sorted(map(sorted, names.values()))


def test_samples_agree_as_often_as_texts(texts):
    idf = Idf({int(f): 30 for f in Idf.feature(shingles(pa.array(texts[:3]))[1])[::3]}, 100)
    a = " ".join(f"w{i}" for i in range(200))
    b = " ".join(f"w{i}" for i in range(30, 230)) + " w31 w32 w33 w34 w35 w36"
    of, hashes, n = shingles(pa.array([a, b]))
    drawn = WeightedSampler(4000).samples(hashes, n * idf.weight[idf.levels(hashes)], np.flatnonzero(np.diff(of, prepend=-1)))
    similar = weighted_jaccard(shingles(pa.array([a])), shingles(pa.array([b])), idf, 1)[0]
    assert abs((drawn[0] == drawn[1]).mean() - similar) < 0.03


def test_classes_against_all_pairs(spark, texts):
    rows = [(i * 2, t, 7) for i, t in enumerate(texts)] + [(9001, None, 7), (9002, None, 7), (None, texts[0], 7), (None, "alone here", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, class_id int").repartition(3)
    found = near_duplicates(df)
    assert found.columns == ["doc_id", "class_id", "kept"]
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in found.collect() if r["doc_id"] is not None}
    idf = document_frequencies(df)
    class_of = list(range(len(texts)))
    for i in range(len(texts)):
        part = pa.array([texts[i]] * i)
        similar = weighted_jaccard(shingles(part), shingles(pa.array(texts[:i])), idf, i) if i else []
        for j in range(i):
            if texts[i] == texts[j] or similar[j] >= 0.8:
                a, b = class_of[i], class_of[j]
                class_of = [min(a, b) if c in (a, b) else c for c in class_of]
    assert {k: v[0] for k, v in got.items() if k < 9000} == {i * 2: c * 2 for i, c in enumerate(class_of)}
    assert all(kept == (c == d) for d, (c, kept) in got.items()) and got[9001] == (9001, True)
    assert len(set(class_of)) < len(texts) - 30
    left = drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == sorted({c * 2 for c in class_of}) + [9001, 9002]
    assert left.filter("doc_id IS NULL").count() == 2


def test_frequencies_do_not_depend_on_size(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    one, two = document_frequencies(df, rare=0.05), document_frequencies(df.union(df), rare=0.05)
    assert np.array_equal(one.level, two.level) and one.level.max() > 0


def test_nothing_or_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], schema)).collect() == []
    assert drop_near_duplicates(spark.createDataFrame([], schema)).collect() == []
    twice = spark.createDataFrame([(4, "some words"), (4, "some words"), (5, "some words")], schema)
    assert [r["doc_id"] for r in drop_near_duplicates(twice).collect()] == [4]
    assert sorted(tuple(r) for r in near_duplicates(twice).collect()) == [(4, 4, True), (4, 4, True), (5, 4, False)]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    random.seed(seed)
    links = [(random.randrange(60), random.randrange(60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 140)]
    label = {n: n for l in links for n in l}
    for _ in range(200):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert all(found.get(n, n) == c for n, c in label.items())


def _edited(copies, words, spans, seed, first):
    """A text and copies of it, each with words replaced on its own in so many places; its id is the smallest or the largest."""
    draw = random.Random(seed)
    source = [f"s{seed}w{i}" for i in range(words)]
    texts = []
    for n in range(copies):
        copy = list(source)
        for i in draw.sample(range(words), draw.choice(spans)):
            copy[i] = f"c{n}w{i}"
        texts.append(" ".join(copy))
    return [" ".join(source), *texts] if first else [*texts, " ".join(source)]


def _classes_of_all_pairs(df, texts):
    idf = document_frequencies(df)
    class_of = np.arange(len(texts))
    for i in range(1, len(texts)):
        similar = weighted_jaccard(shingles(pa.array([texts[i]] * i)), shingles(pa.array(texts[:i])), idf, i)
        for j in np.flatnonzero(similar >= 0.8):
            a, b = class_of[i], class_of[j]
            class_of[(class_of == a) | (class_of == b)] = min(a, b)
    return dict(enumerate(class_of.tolist()))


def test_large_groups_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neardup, "_GROUP", 6)
    texts = [t for i in range(3) for t in _edited(40, 200, [1, 4], i, i < 2)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = _classes_of_all_pairs(df, texts)
    assert {r["doc_id"]: r["class_id"] for r in near_duplicates(df).collect()} == wanted and len(set(wanted.values())) < 30


def test_partners_after_the_likeliest(spark):
    texts = _edited(250, 400, [7, 8, 9], 11, False)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = _classes_of_all_pairs(df, texts)
    assert {r["doc_id"]: r["class_id"] for r in near_duplicates(df).collect()} == wanted


def test_rows_that_share_an_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, __own string")
    left = lambda rows: sorted(tuple(r) for r in drop_near_duplicates(make(rows)).collect())
    assert left([(1, a, "x"), (2, b, "y"), (2, a, "z")]) == [(1, a, "x"), (2, b, "y")]
    assert left([(7, a, "x"), (7, b, "y"), (8, a + " tail", "z"), (3, c, "w")]) == [(3, c, "w"), (7, a, "x"), (7, b, "y")]
    found = near_duplicates(make([(7, a, "x"), (7, b, "y"), (8, b + " tail", "z"), (9, None, "n"), (9, None, "m")]))
    assert sorted(tuple(r) for r in found.collect()) == [(7, 7, True), (7, 7, True), (8, 7, False), (9, 9, True), (9, 9, True)]


def test_links_that_join_components():
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [random.choice(vocabulary) for _ in range(80)]
    some = []
    for _ in range(60):
        copy = list(base)
        for i in random.sample(range(80), random.choice([0, 1, 2, 5, 40])):
            copy[i] = random.choice(vocabulary) + "x"
        some.append(" ".join(copy))
    of, hashes, n = shingles(pa.array(some))
    idf = Idf({}, 100)
    component, seeks = np.arange(60) // 3, np.arange(60) % 7 < 5
    for at_once in (1, 500, 1 << 21):
        neardup._AT_ONCE, before = at_once, neardup._AT_ONCE
        found = neardup._joining(of, hashes, n * idf.weight[idf.levels(hashes)], component, seeks, 0.8)
        neardup._AT_ONCE = before
        joined = component.copy()
        for a, b in found:
            assert joined[a] != joined[b] and weighted_jaccard(shingles(pa.array([some[a]])), shingles(pa.array([some[b]])), idf, 1)[0] >= 0.8
            joined[joined == joined[b]] = joined[a]
        for a in np.flatnonzero(seeks):
            similar = weighted_jaccard(shingles(pa.array([some[a]] * 60)), shingles(pa.array(some)), idf, 60)
            assert (joined[np.flatnonzero(similar >= 0.8)] == joined[a]).all()
        assert len(found) > 5


@pytest.mark.parametrize("block", [512, 7])
def test_recall_of_links_in_a_large_group(spark, monkeypatch, block):
    """Two thousand copies, each edited on its own, of which only some are linked: every link within a class."""
    monkeypatch.setattr(neardup, "_BLOCK", block)
    texts = _edited(2000 if block > 100 else 200, 150, [1, 2, 3, 4, 5, 9, 20, 40], 5, True)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    idf = document_frequencies(df)
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(df).collect()}
    of, hashes, n = shingles(pa.array(texts))
    everything = np.ones(len(texts), bool)
    class_of = np.array([found[i] for i in range(len(texts))])
    assert neardup._joining(of, hashes, n * idf.weight[idf.levels(hashes)], class_of, everything, 0.8) == []
    assert 1 < len(set(found.values())) < len(texts)


def test_pairs_within_tells_what_it_leaves_out():
    group = np.repeat(np.arange(4), [3, 2, 5, 4])  # two closed rows; one; four partners a row; three
    signature = np.zeros((len(group), 64), np.uint8)
    for row in np.flatnonzero(group >= 2):
        signature[row, row % 9 * 5:row % 9 * 5 + 5] = row
    left, right, more = neardup._pairs_within(group, signature, 36, 58)
    assert {(0, 1), (0, 2), (3, 4)} <= set(zip(left.tolist(), right.tolist())) and set(group[more].tolist()) == {0, 2}
