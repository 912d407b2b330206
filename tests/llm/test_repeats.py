import hashlib
import random

import numpy as np
import pytest

from tidemark.llm.repeats import remove_repeats
from tidemark.llm.suffixes import suffix_array


@pytest.mark.parametrize("letters", [1, 2, 3, 9])
def test_suffix_array_against_sorting(letters):
    random.seed(letters)
    for _ in range(400):
        s = [random.randrange(letters) for _ in range(random.randint(0, 30))]
        s = s[:4] * 6 if random.random() < 0.2 else s
        assert suffix_array(np.array(s, int)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def _plain(docs, least):
    data = [((1 << 63) - 1 if i is None else i, i, (t or "").encode()) for i, t in docs]
    first = {}
    for key, _, b in data:
        for p in range(len(b) - least + 1):
            first[b[p:p + least]] = min(key, first.get(b[p:p + least], key))
    out = []
    for key, i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - least + 1):
            if first[b[p:p + least]] < key:
                gone[p:p + least] = b"\1" * least
        spans = [p for p in range(len(b) + 1) if (p < len(b) and gone[p]) != (p > 0 and gone[p - 1])]
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(spans) // 2, hashlib.sha256(kept).hexdigest(), list(zip(spans[::2], spans[1::2]))))
    return sorted(out, key=str)


def _docs(seed):
    random.seed(seed)
    base = ["".join(random.choice("abcdé e") for _ in range(400)) for _ in range(5)]
    docs = []
    for i in range(100):
        cuts = [(random.choice(base), random.randint(0, 350)) for _ in range(random.randint(0, 6))]
        text = "".join(b[a:a + random.randint(10, 120)] for b, a in cuts)
        docs.append((i * 3, text + random.choice(["", "", "\0" * random.randint(0, 120), base[0][:60] * 3])))
    docs += [(1000 + i, docs[i][1]) for i in range(15)] + [(2000, None), (2001, ""), (2002, "x" * 49), (2003, "x" * 49), (2004, "x" * 400), (2005, "x" * 120)]
    docs += [(3000, base[0] * 30), (3000, "y" + base[0] * 2), (4, base[1]), (4, base[1]), (None, base[2]), (None, base[2]), (None, "z" + base[2][:100])]
    random.shuffle(docs)
    return docs


@pytest.mark.parametrize("options", [{}, {"frequent": 2}, {"block_bytes": 3000, "frequent": 5}, {"least": 33}])
def test_against_every_string(spark, options):
    docs = _docs(len(options))
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, n_removed int").repartition(3)
    found = remove_repeats(df, **options)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    got = sorted(((*tuple(r)[:5], [tuple(s) for s in r["spans"]]) for r in found.collect()), key=str)
    assert got == _plain(docs, options.get("least", 50))


def test_nothing(spark):
    schema = "doc_id long, text string"
    assert remove_repeats(spark.createDataFrame([], schema)).collect() == []
    alone = remove_repeats(spark.createDataFrame([(1, None), (2, "short")], schema)).collect()
    assert sorted(tuple(r)[:4] for r in alone) == [(1, 0, 0, 0), (2, 5, 0, 0)]
