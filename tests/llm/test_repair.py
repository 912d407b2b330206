import hashlib
import itertools
import random
import re
import zlib

import pytest

from tidemark.llm import repair
from tidemark.llm.queries import QUERIES
from tidemark.llm.repair import damage, repair_conversations

TYPES = "conv_id long, turn long, role string, text string, conv string, n int"


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
        out.append("b" if not last else "d" if (role, text) in seen else "t" if last not in ".!?" else "-")
        seen.add((role, text))
    return out


def _best(rows, faults):
    """The least (cost, audit) of all scripts: every audit's prefix is kept for every sequence of roles it leaves."""
    best = {}  # written so far, as roles: (cost, audit); the grammar only needs the last and whether it began
    open_ = {"": (0, "")}

    def keep(into, roles, value):
        if re.fullmatch(r"s?(ua)*u?", roles):
            left = roles if roles in ("", "s") else "u" if roles[-1] == "u" else "ua"
            into[left] = min(into.get(left, value), value)

    def with_inserts(states):
        for _ in range(3):
            for roles, (cost, audit) in list(states.items()):
                for x in "ua":
                    keep(states, roles + x, (cost + 2, audit + "I"))
        return states

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for roles, (cost, audit) in with_inserts(open_).items():
            keep(after, roles, (cost + 3, audit + "D"))
            if fault not in "bd":
                extra = fault == "t"
                if role[:1] in ("s", "u", "a"):
                    keep(after, roles + role[:1], (cost + extra, audit + "K"))
                for x in "ua":
                    keep(after, roles + x, (cost + 2 + extra, audit + "R"))
        open_ = after
    best = [v for roles, v in with_inserts(open_).items() if roles in ("", "ua")]
    return min(best)


def _repaired(rows, audit):
    out, at, expected = [], 0, "user"
    for letter in audit:
        if letter == "I":
            out.append((expected, ""))
        else:
            _, role, text = rows[at]
            at += 1
            if letter == "D":
                continue
            out.append((expected if letter == "R" else role, text))
        expected = "user" if out[-1][0][:1] in ("s", "a") else "assistant"
    return out


def _want(rows):
    """The summary of every conversation of (conv, turn, role, text) by plain loops."""
    found = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0), r or "", x or "") for c, t, r, x in rows if c == conv)
        faults = _faults(mine)
        cost, audit = _best(mine, faults)
        turns = [t for (some, t), *_ in mine if some]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        text = "\n".join(f"{r}:{t}" for r, t in _repaired(mine, audit))
        found[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return found


def _make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], TYPES).repartition(3)


def _found(df):
    return {r["conv_id"]: tuple(r)[1:] for r in repair_conversations(df).summary.collect()}


def _random_rows(seed, conversations=60):
    random.seed(seed)
    roles, texts = ["user", "assistant", "system", "tool", "user", "assistant", "", None, "sage"], ["a.", "b!", "c", " \n", "", None, "d? \t", " ", "e.", "f.", "g.", "h"]
    rows = [(c, random.choice([t, t, t + 2, None]), random.choice(roles), random.choice(texts)) for c in range(conversations) for t in range(random.randint(1, 9))]
    return rows + [(1000, t, ["user", "assistant"][t % 3 == 0], f"{t}.") for t in range(40)] + [(1001, 1, "user", "same.")] * 9 + [(None, None, None, "x.")] * 3


def test_all_scripts_of_short_conversations():
    """The program against every script that is no longer than it could be worth."""
    def scripts(rows, faults, roles="", at=0, cost=0, audit=""):
        if cost > 3 * len(rows):  # deleting all is cheaper
            return
        if at == len(rows) and re.fullmatch(r"(s?(ua)+)?", roles):
            yield cost, audit
        for x in "ua":
            yield from scripts(rows, faults, roles + x, at, cost + 2, audit + "I")
        if at < len(rows):
            extra = faults[at] == "t"
            yield from scripts(rows, faults, roles, at + 1, cost + 3, audit + "D")
            if faults[at] not in "bd":
                yield from scripts(rows, faults, roles + (rows[at][1][:1] or "?"), at + 1, cost + extra, audit + "K")
                for x in "ua":
                    yield from scripts(rows, faults, roles + x, at + 1, cost + 2 + extra, audit + "R")

    random.seed(5)
    for _ in range(60):
        rows = [(t, random.choice(["user", "assistant", "system", "tool"]), random.choice(["a.", "b", "", "c."])) for t in range(random.randint(0, 3))]
        faults = _faults(rows)
        want = min(scripts(rows, faults))
        assert _best(rows, faults) == want
        symbols = [(r[1][0] if r[1][0] in "sua" else "?") + f for r, f in zip(rows, faults)]
        collapsed = repair.runs(symbols, [1] * len(rows))
        audit, _ = repair.unroll(collapsed, 0, repair._END, True)
        cost = repair._times(repair.transition(collapsed), repair._END)[0]
        assert (cost, audit) == want


@pytest.mark.parametrize("bits", [12, 1, 0])
def test_against_plain_loops(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "_SEGMENT_BITS", bits)
    rows = _random_rows(bits)
    assert _found(_make(spark, rows)) == _want(rows)


def test_powers_are_repeated_products():
    for symbol in ("u-", "at", "s-", "?b", "ud"):
        step = want = repair._power(symbol, 0)
        for _ in range(12):
            want = repair._times(step, want)
        assert (repair.transition([(symbol, 13)]) == want).all()


def test_one_long_conversation_is_split(spark):
    rows = [(7, t, random.choice(["user", "user", "assistant"]), f"{t}.") for t in range(9000)]
    assert _found(_make(spark, rows)) == _want(rows)


def test_turns(spark):
    rows = [(1, 0, "tool", "x."), (1, 1, "user", ""), (1, 2, "assistant", "y"), (1, 3, "system", "z.")]
    [row] = repair_conversations(_make(spark, rows)).turns.collect()
    audit = _want(rows)[1][6]
    assert "".join(t["edit"] for t in row["turns"]) == audit
    kept = [(t["role"], t["text"]) for t in row["turns"] if t["edit"] != "D"]
    assert kept == _repaired([(None, r, t) for _, _, r, t in rows], audit)


def test_long_text_and_empty_table(spark):
    rows = [(1, 0, "user", "a" * 3_000_000), (1, 1, "assistant", "b" * 2_000_000 + "."), (2, 0, "user", "\n" * 100_000)]
    assert _found(_make(spark, rows)) == _want(rows)
    assert _found(_make(spark, rows).limit(0)) == {}


def _damaged(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(hit, text)
            yield from [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)


def test_damage(spark):
    rows = _random_rows(9) + [(c, c, "assistant", "Well. Yes! No?") for c in range(2000, 2100)]
    found = [tuple(r) for r in damage(_make(spark, rows)).collect()]
    assert sorted(found, key=repr) == sorted(_damaged(rows), key=repr)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in {r[0] for r in rows}} | _want(list(_damaged(rows)))
    found = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op11_structure_repair"](spark, folder).collect()}
    assert found == want
