import random
import zlib

import pytest

from tidemark.llm import sharding
from tidemark.llm.sharding import _Ends, _cuts, _smallest_capacity, shard_documents


class Line(_Ends):
    """The same line, in memory."""

    def __init__(self, sizes):
        self.ends, at = [0], 0
        for n in sizes:
            at += n
            self.ends.append(at)
        self.total, self.largest = at, max(sizes)

    def last_by(self, points):
        return [max(e for e in self.ends if e <= p) for p in points]

    def around(self, point):
        return max(e for e in self.ends if e <= point), min((e for e in self.ends if e >= point), default=self.total)


def _fits_plainly(ends, capacity, shards):
    at = 0
    for _ in range(shards):
        at = max(e for e in ends if e <= at + capacity)
    return at == ends[-1]


@pytest.mark.parametrize("seed", range(60))
def test_the_capacity_is_the_smallest_and_kept(seed):
    random.seed(seed)
    sizes = [random.choice([16, random.randint(16, 400)]) for _ in range(random.choice([1, 3, 40, 150]))]
    if seed % 3 == 0:
        sizes[random.randrange(len(sizes))] = sum(sizes) // 2 + 16
    shards, line = random.choice([1, 2, 9, 40]), Line(sizes)
    capacity = _smallest_capacity(line, shards)
    assert _fits_plainly(line.ends, capacity, shards) and (capacity == max(sizes) or not _fits_plainly(line.ends, capacity - 1, shards))
    ends = [0, *_cuts(line, shards, capacity), line.total]
    assert len(ends) == shards + 1 and ends == sorted(ends) and set(ends) <= set(line.ends)
    assert max(b - a for a, b in zip(ends, ends[1:])) <= capacity


@pytest.mark.parametrize("cells", [4, 60, 1 << 15])
def test_places_are_looked_into_until_nothing_is_guessed(spark, monkeypatch, cells):
    monkeypatch.setattr(sharding, "_CELLS", cells)
    random.seed(cells)
    sizes = [random.choice([16, random.randint(16, 400), 3000]) for _ in range(800)]
    plain, looks = Line(sizes), []
    line = _Ends(spark.createDataFrame([(e,) for e in plain.ends[1:]], "upto long").repartition(3), plain.total, plain.largest)
    while True:
        cuts = _cuts(line, 40, _smallest_capacity(line, 40))
        if not line.guessed:
            break
        looks.append(len(line.guessed))
        line.look()
    assert cuts == _cuts(plain, 40, _smallest_capacity(plain, 40)) and len(looks) < (5 if cells > 1000 else 25)
    assert set(line.known.tolist()) <= set(plain.ends)


def test_few_jobs(spark):
    df = spark.createDataFrame([(i, f"text {i} " * (i % 50)) for i in range(4000)], "doc_id long, text string")
    spark.sparkContext.setJobGroup("shards", "shards")
    shard_documents(df).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("shards")) <= 24


def test_documents(spark):
    random.seed(1)
    texts = [random.choice([None, "", "same" * 30, "x" * random.randint(0, 300), "é" * 20]) for _ in range(300)]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(None, "n", 0), (5, texts[5], 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int").repartition(4)
    found = shard_documents(df, 7).collect()
    assert len(found) == len(rows)
    text_of = dict((r[0], r[1]) for r in rows)
    places, groups = {}, {}
    for r in found:
        data = (text_of[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "bytes", None)
        places.setdefault(r["shard"], []).append(r["slot"])
        groups.setdefault(text_of[r["doc_id"]], set()).add(r["shard"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and set(places) <= set(range(7))
    assert all(len(s) == 1 for s in groups.values())


def test_few_or_no_documents(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b" * 90)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["slot"]) for r in shard_documents(df, 40).collect()) == [(1, 0), (2, 0)]
    empty = shard_documents(df.limit(0), 40)
    assert empty.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"] and empty.collect() == []
