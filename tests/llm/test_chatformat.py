import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chatformat
from tidemark.llm.chatformat import conversation_digests, format_conversations, read_back

TYPES = "conv_id long, turn long, role string, text string, turns int, segment string"
PIECES = ["#", "##", "###", "\\", "\\\\", "<", "</", "</turn>", "</turn>\n", "<part>", "part>", "/turn>", ": ", ":", " ", "\n", "### user: ", "é", "😀", "x", ""]


def _make(spark, rows):
    return spark.createDataFrame([(*r, 1, "s") for r in rows], TYPES).repartition(3)


def _want(rows):
    """Digests straight from the rows, and the formatted text by a plain loop."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        said = "".join(f"{role}\n{text}\n" for *_, role, text in mine)
        learnt = "".join(text for *_, role, text in mine if role == "assistant")
        chars, previous = 0, None
        for *_, role, text in mine:
            marks = lambda s: s.count("\\") + s.count("</turn>") + s.count("<part>") + sum(s[i:i + 3] == "###" for i in range(len(s)))
            chars += len(text) + marks(text) + (6 if role == previous else 4 + len(role) + marks(role) + role.count(": ") + 2 + 8)
            previous = role
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(mine), sha(said), len(learnt), sha(learnt), chars)
    return out


def _found(df):
    return {r[0]: tuple(r[1:]) for r in conversation_digests(format_conversations(df)).collect()}


@pytest.mark.parametrize("bits", [10, 2, 0])
def test_round_trip(spark, monkeypatch, bits):
    """Control strings in texts and roles, repeated rows, NULL, many segments: all comes back."""
    monkeypatch.setattr(chatformat, "_SEGMENT_BITS", bits)
    random.seed(bits)
    messy = lambda n: "".join(random.choices(PIECES, k=n))
    rows = [(c, t, random.choice(["user", "assistant", "assistant", "system", None, messy(3)]), messy(random.randint(0, 12))) for c in range(30) for t in range(random.randint(1, 9))]
    rows += [(50, t // 3, "assistant", messy(4)) for t in range(70)] + [(None, None, None, None), (None, 1, "user", "a"), (51, 5, "user", "same")] + [(51, 5, "user", "same")] * 3
    assert _found(_make(spark, rows)) == _want(rows)


def test_text(spark):
    rows = [(1, 0, "system", "Be kind"), (1, 1, "user", "Hi"), (1, 2, "user", "a < b </turn>"), (1, 3, "assistant", "Yes \\ ####"), (1, 4, "assistant", "ok")]
    [row] = read_back(format_conversations(_make(spark, rows).coalesce(1))).collect()
    assert row["formatted"] == ("### system: Be kind</turn>\n### user: Hi<part>a < b <\\/turn></turn>\n"
                                "### assistant: Yes \\\\ ##\\#\\#<part>ok</turn>\n")
    assert [row["formatted"][s["start"]:s["end"]] for s in row["loss"]] == ["Yes \\\\ ##\\#\\#", "ok"]
    assert row["learnt"] == ["Yes \\ ####", "ok"] and [tuple(t) for t in row["turns"]] == [r[2:] for r in rows]


def test_one_long_conversation_is_split(spark):
    rows = [(7, t, ["user", "assistant"][t % 2], f"text {t}") for t in range(3000)]
    df = _make(spark, rows)
    segments = format_conversations(df).select("segment", F.size("loss").alias("n")).collect()
    assert len(segments) >= 3 and sum(r["n"] for r in segments) == 1500 and max(r["n"] for r in segments) <= 512
    assert sorted(r["segment"] for r in segments) == list(range(len(segments)))
    assert _found(df) == _want(rows)


def test_long_text_and_empty_table(spark):
    rows = [(1, 0, "assistant", "ab\\###" * 200_000), (2, 0, "user", "")]
    assert _found(_make(spark, rows)) == _want(rows)
    assert _found(_make(spark, rows).limit(0)) == {}
