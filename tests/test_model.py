"""Random merges against a model in plain Python: hundreds of small cases in one table each."""

import random

import pytest

from tests.conftest import rows
from tidemark import TableSpec, merge

GROUPS, KEYS = 300, 6
SCHEMA = "grp int, k string, a int, b double, c string"
VALUES = {"a": [None, 0, 1], "b": [None, 0.0, 2.5], "c": [None, "", "x"]}


def make(seed):
    rng = random.Random(seed)
    keys = [None, *"pqrst"][:KEYS]
    return {
        (g, k): tuple(rng.choice(VALUES[c]) for c in "abc")
        for g in range(GROUPS) for k in keys if rng.random() < 0.5
    }


def frame(spark, table):
    return spark.createDataFrame([(*key, *row) for key, row in table.items()], SCHEMA)


def model(target, source, operation, null_safe, compare="abc", assign="abc", where=None, drop=None):
    """The new table as a list and the actions by key."""
    out, actions = [], []
    match = {k: v for k, v in source.items() if null_safe or k[1] is not None}
    at = ["abc".index(c) for c in compare]
    for key, old in target.items():
        new = match.get(key) if null_safe or key[1] is not None else None
        row = old
        if new is not None:
            if operation == "delete":
                actions.append(("D", key))
                continue
            changed = any(old[i] != new[i] for i in at) and (where is None or where(old, new))
            if operation in ("update", "upsert", "sync") and changed:
                row = tuple(n if c in assign else o for c, n, o in zip("abc", new, old))
                actions.append(("U", key))
        elif operation == "sync" and (drop is None or drop(old)):
            actions.append(("D", key))
            continue
        out.append((*key, *row))
    if operation in ("insert_absent", "upsert", "sync"):
        for key, new in source.items():
            if key not in target or (key[1] is None and not null_safe):
                out.append((*key, *new))
                actions.append(("I", key))
    return out, actions


def ordered(records):
    return sorted(records, key=lambda r: [(v is None, v) for v in r])


CASES = [
    dict(),
    dict(compare="a", settings=dict(include_on_compare=["a"])),
    dict(assign="bc", settings=dict(exclude_on_update=["a"])),
    dict(where=lambda o, n: None not in (o[0], n[0]) and n[0] > o[0], settings=dict(where="s.a > t.a")),
    dict(drop=lambda o: o[0] == 1, settings=dict(delete_filter="a = 1")),
]


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("case", range(len(CASES)))
def test_random_merges(spark, case, null_safe):
    target, source = make(2 * case), make(2 * case + 1)
    t, s = frame(spark, target).cache(), frame(spark, source).cache()
    spec = TableSpec("m", key=("grp", "k"), nullable=frozenset({"k"}))
    options = {**CASES[case]}
    settings = options.pop("settings", {})
    operations = ["sync"] if "drop" in options else ["upsert", "update", "sync"]
    if not options:
        operations += ["insert_absent", "delete"]
    for operation in operations:
        table, actions = model(target, source, operation, null_safe, **options)
        expected = sorted(a for a, _ in actions)
        for strategy in ("outer", "split"):
            result = merge(t, s, spec, operation, strategy=strategy, null_safe_keys=null_safe, **settings)
            assert rows(result.result) == ordered(table), (operation, strategy)
            found = rows(result.changes, "__action", "grp", "k")
            assert found == ordered((a, *key) for a, key in actions), (operation, strategy)
            assert tuple(result.stats.first()) == tuple(expected.count(a) for a in "IUD")
    t.unpersist(), s.unpersist()
