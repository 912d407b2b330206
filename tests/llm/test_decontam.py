import hashlib
import random
import re

import pytest

from tidemark.llm.decontam import contamination, remove_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is not None and w:
            for s in range(max(len(w) - n, 0) + 1):
                windows.setdefault(tuple(w[s:s + n]), set()).add(item)
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for s in range(len(w) - size + 1):
                if tuple(w[s:s + size]) in windows:
                    hit.update(range(s, s + size))
                    found |= windows[tuple(w[s:s + size])]
        names = ",".join(sorted(map(str, found)))
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit))
    return out


@pytest.fixture(scope="module")
def data():
    random.seed(5)
    vocabulary = ["a", "bb", "ccc", "Dd", "élan", "7", "x1", "Größe"]
    some = lambda n: [random.choice(vocabulary) for _ in range(n)]
    items = [(i, some(random.choice([1, 4, 9, 10, 11, 25]))) for i in range(25)]
    items += [(100, items[3][1]), (101, ["z"] * 30), (3, some(12)), (None, some(12)), (102, [])]
    docs = []
    for i in range(120):
        w = some(random.randint(0, 40))
        for _ in range(random.randint(0, 3)):
            cut = random.choice(items)[1]
            at = random.randint(0, len(w))
            w[at:at] = cut[random.randint(0, 3):][:random.randint(1, 30)]
        docs.append((i, random.choice([" ", " - ", "\n"]).join(w)))
    docs += [(500, None), (501, ""), (502, "... "), (503, "z " * 3000), (504, "\x00Z,z" * 9)]
    return docs, [(i, " ".join(w)) for i, w in items]


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 2])
def test_against_plain_loops(spark, data, broadcast_bytes):
    docs, items = data
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n_hit long").repartition(3)
    bench = spark.createDataFrame(items + [(55, None)], "item_id long, text string")
    found = contamination(df, bench, broadcast_bytes=broadcast_bytes)
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = {r[0]: tuple(r)[1:] for r in found.collect()}
    assert got == plain(docs, items) and 0 < sum(v[4] for v in got.values()) < len(got)


def test_removal(spark, data):
    docs, items = data
    df = spark.createDataFrame([(*d, [1]) for d in docs] + [(None, "fine text", [2])], "doc_id long, text string, runs array<int>")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain(docs, items)
    left = remove_contaminated(df, bench)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.filter("doc_id IS NOT NULL").collect()) == sorted(d for d, v in want.items() if not v[4])
    assert left.filter("doc_id IS NULL").count() == 1
    cut = {r["doc_id"]: r["text"] for r in remove_contaminated(df, bench, remove="spans").collect()}
    assert len(cut) == len(docs) + 1
    for doc, text in docs:
        assert len(words(cut[doc])) == want[doc][0] - want[doc][1] and (want[doc][4] or cut[doc] == text)


def test_empty_tables_and_repeats(spark, data):
    docs, items = data
    df = spark.createDataFrame([(1, items[0][1]), (1, "unrelated"), (1, items[0][1])], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(r["contaminated"] for r in contamination(df, bench).collect()) == [False, True, True]
    assert not contamination(df, bench.limit(0)).filter("contaminated OR n_items > 0").count()
    assert contamination(df.limit(0), bench).collect() == []


def test_the_set_is_sent_only_within_its_bound(spark, data):
    docs, items = data
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    plans = [contamination(df, bench, broadcast_bytes=b)._jdf.queryExecution().optimizedPlan().toString() for b in (64 << 20, 2)]
    assert "strategy=broadcast" in plans[0] and "strategy=broadcast" not in plans[1]


def test_a_long_text(spark, data):
    _, items = data
    bench = spark.createDataFrame(items, "item_id long, text string")
    text = "plain words " * 150_000 + items[5][1] + " end" * 100_000
    [row] = contamination(spark.createDataFrame([(1, text)], "doc_id long, text string"), bench).collect()
    assert tuple(row)[1:] == plain([(1, text)], items)[1]


def test_collisions_are_verified(spark, data, monkeypatch):
    from tidemark.llm import decontam

    docs, items = data
    monkeypatch.setattr(decontam.F, "xxhash64", lambda *c: decontam.F.pmod(decontam.F.hash(*c), decontam.F.lit(3)).cast("bigint"))
    found = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == plain(docs, items)
