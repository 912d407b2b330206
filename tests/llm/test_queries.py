"""Every registered query of the package against its SQL, or its contract."""

import zlib

import pytest

from tests.oracle import connect, differences
from tidemark.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) == []


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_languages_of_held_out_documents(spark):
    found = {r["doc_id"]: r for r in QUERIES["op1_language_id"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(found) == len(docs)
    for d in docs:
        assert found[d["doc_id"]]["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0)
    held = [d for d in docs if found[d["doc_id"]]["held_out"]]
    right = sum(found[d["doc_id"]]["lang_pred"] == d["lang"] for d in held)
    assert right >= 0.95 * len(held) > 0


def test_token_counts_are_the_librarys(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    found = QUERIES["op10_token_counts"](spark, FOLDER).collect()
    assert len(found) == len(texts)
    for r in found:
        n = len(tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 1024)
