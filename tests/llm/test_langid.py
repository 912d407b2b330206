import numpy as np
import public_tokenizers
import pytest

from tidemark.llm.langid import (LanguageModel, expected_counts, identify_languages, keep_languages, learn_languages, log_likelihoods,
                                 pieces_of, words_of)

PATH = public_tokenizers.path("piece_bpe_32k.model")


def _segmentations(word):
    if not word:
        yield []
    for i in range(1, len(word) + 1):
        for rest in _segmentations(word[i:]):
            yield [word[:i], *rest]


def _number(pieces, piece):
    """The piece's number; the unknown one for other characters, else None."""
    return pieces.names.index(piece) + 1 if piece in pieces.names else 0 if len(piece) == 1 else None


@pytest.mark.parametrize("word", ["the", "straße", "año", "x東q", "ordinateur"])
def test_all_segmentations_are_summed(word):
    pieces = pieces_of(PATH)
    probability = np.random.default_rng(1).random((pieces.size, 2))
    probability /= probability.sum(axis=0)
    total, counts = np.zeros(2), np.zeros((pieces.size, 2))
    for parts in _segmentations("▁" + word):
        numbers = [_number(pieces, p) for p in parts]
        if None not in numbers:
            p = probability[numbers].prod(axis=0)
            total += p
            for n in numbers:
                counts[n] += p
    assert np.allclose(log_likelihoods(pieces, probability, [word, "a", word])[[0, 2]], np.log(total))
    assert np.allclose(expected_counts(pieces, probability, ["b", word], np.array([[0, 0], [3.0, 5.0]])), counts / total * [3, 5])


def test_words():
    assert words_of("Ab1c_d  É! 東京") == ["ab", "c", "d", "é", "東京"]
    assert [len(w) for w in words_of("x" * 100)] == [40, 40, 20]


EN = ["the cat and the dog were sitting on the mat with another thing", "which of these would they rather have than nothing"]
DE = ["der hund und die katze sitzen auf der matte mit einem anderen ding", "welche von diesen würden sie lieber haben als nichts"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, (EN if i % 2 else DE)[i // 2 % 2], "en" if i % 2 else "de", "x") for i in range(60)]
    rows += [(100, None, "en", "x"), (101, "123 ... !", "de", "x"), (102, "", None, "x"), (None, EN[0], "xx", "x"), (104, "the " * 50_000, None, "x"),
             (105, "q" * 100_000, None, "x"), (1, EN[0], "en", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_edges(docs):
    model = learn_languages(docs, PATH)
    assert model.languages == ("de", "en") and np.allclose(model.probability.sum(axis=0), 1)
    found = identify_languages(docs, model, batch_bytes=500)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert all(by[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(60))
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (100, 101, 102))
    assert by[104]["lang_pred"] == by[None]["lang_pred"] == "en" and not by[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in rows)
    kept = keep_languages(docs, model, languages=("en",))
    assert kept.schema == docs.schema and kept.filter("doc_id < 60").count() == 31 and not kept.filter("doc_id IN (100, 101, 102)").count()


def test_only_other_folds_teach(spark, docs):
    import zlib

    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    wrong = docs.filter("doc_id IS NOT NULL").selectExpr("doc_id", "text", f"CASE WHEN doc_id IN ({', '.join(map(str, held))}) THEN 'zz' ELSE lang END AS lang")
    assert learn_languages(wrong, PATH).languages == ("de", "en")


def test_order_and_partitions_do_not_matter(docs):
    a, b = learn_languages(docs, PATH), learn_languages(docs.repartition(7), PATH)
    assert np.array_equal(a.probability, b.probability)


def test_nothing_to_learn_from(docs):
    model = learn_languages(docs.filter("lang IS NULL"), PATH)
    assert isinstance(model, LanguageModel) and model.languages == ()
    assert {(r["lang_pred"], r["score"]) for r in identify_languages(docs, model).collect()} == {("und", 0.0)}
    assert identify_languages(docs.limit(0), model).collect() == [] and keep_languages(docs, model).collect() == []


def test_numbers_are_no_letters_and_short_texts_stay(spark):
    docs = spark.createDataFrame([(i, t, l, 1) for i, (t, l) in enumerate(
        [("the cat is here", "en"), ("le chat est ici", "fr"), ("el gato es", "es"), ("½ ² ³", None), ("Ⅷ", None), ("ok", None), ("ID 5", None), ("½a²b", None), (None, "en")])],
        "doc_id long, text string, lang string, score int")
    model = learn_languages(docs, public_tokenizers.path("piece_bpe_32k.model"), folds=10**9)
    found = {r["doc_id"]: r["lang_pred"] for r in identify_languages(docs, model).collect()}
    assert {i for i, l in found.items() if l == "und"} == {3, 4, 8}
    assert {r["doc_id"] for r in keep_languages(docs, model).collect()} == {0, 1, 2, 5, 6, 7}
