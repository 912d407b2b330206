import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.tokens import PieceCounter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "one two  three\n\n\tfour ", "it's they'll WE'RE I'd", "a<|endoftext|>b <|endoftext|>", "<|endoftext|>" * 3, "x" * 5000,
    "naïve façade 東京 кот 123 4567", "՘ young \U0003fc3b letters", "\x00\x1c\x85  　odd", "é" * 300 + " " * 300 + "!?" * 50, "👩‍👩‍👧 \U0001f600",
]


@pytest.fixture(scope="module")
def counts():
    tokenizer = Tokenizer.from_file(PATH)
    return [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in TEXTS]


def test_counts(spark, counts):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(0, None, "x"), (None, "ab", "x"), (3, TEXTS[3], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = count_tokens(df, PATH, limit=5, batch_bytes=64)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len(t.encode()), n, n > 5) for i, (t, n) in enumerate(zip(TEXTS, counts))]
    want += [(0, 0, 0, False), (None, 2, 1, False), want[3]]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_a_small_memory_changes_nothing(counts):
    counter = PieceCounter(PATH, most=3)
    assert [counter.counts([t])[0] for t in TEXTS] == counts


def test_characters_that_are_not_assigned():
    """Random mixtures of assigned and unassigned characters, marks and blanks, against the library."""
    import random

    random.seed(8)
    tokenizer, counter = Tokenizer.from_file(PATH), PieceCounter(PATH)
    some = ["\u0378", "\U0003fc3b", "\u2fe0", "a", "é", "7", " ", "  ", "\n", "!", "'s", "<|endoftext|>", "\x1c", "\u3000", "東"]
    texts = ["".join(random.choices(some, k=random.randint(1, 40))) for _ in range(300)] + ["\u0378" + "long text " * 200_000]
    assert counter.counts(texts) == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
