"""Token counts beside the library's own."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contestry.llm import token_counts
from contestry.llm.queries import QUERIES
from tests.llm.test_operators import ODD, make, prose

FILE = public_tokenizers.path(token_counts.FILE)
#: Letters, digits, marks, white space of several kinds, contractions, added tokens, characters of the newest Unicode.
PARTS = ["a", "Z", " ", "  ", "\n", "\t", "'", "'s", "'ll", "1", "٣", "½", "é", "é", "!", "#", "日", "\xa0", "　", "\x85", "\x1c", "​", "᠎", "😀", "<|endoftext|>", "<|endo", "ⅷ", "\U000323b0", "ᲊ", "꟎", "͸"]


def by_library(texts, file=FILE):
    return [len(e) for e in Tokenizer.from_file(file).encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys(spark):
    r = random.Random(5)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randrange(1, 40))) for _ in range(2000)] + ["", " ", "\n \n", "a" * 5000, prose(3, 20_000), "one 's' <|endoftext|> two"]
    found = {x.doc_id: x for x in token_counts.token_counts(make(spark, texts).repartition(5), FILE).collect()}
    assert [found[i].n_tokens for i in range(len(texts))] == by_library(texts)
    assert all(found[i].n_bytes == len(t.encode()) and found[i].over_limit == (found[i].n_tokens > 512) for i, t in enumerate(texts))


def test_the_query_counts_whole_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = {r.doc_id: r.n_tokens for r in QUERIES["op13_token_counts"](spark, folder).collect()}
    assert found == dict(zip((d.doc_id for d in docs), by_library([d.text or "" for d in docs])))


def test_proved_strings_are_one_token():
    proved = token_counts.prove(FILE)
    assert len(proved.alone) > 49_000 and set(by_library(sorted(proved.alone))) == {1}
    assert "<|endoftext|>" not in proved.alone and "don't" not in proved.alone


def test_merging_is_left_for_the_rest_only():
    count = token_counts.counter(FILE, token_counts.prove(FILE))
    assert count(["the the zzqx", "the"]) == by_library(["the the zzqx", "the"])
    assert count(["the the zzqx", "the"]) == by_library(["the the zzqx", "the"]) and count([]) == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_tokenizers_of_another_build_count_whole_texts(spark, name):
    path, texts = public_tokenizers.path(name), ["One TWO  three", "", "ünï 日本", prose(1, 300)]
    found = {r.doc_id: r.n_tokens for r in token_counts.token_counts(make(spark, texts), path).collect()}
    if name.endswith(".json"):
        wanted = by_library(texts, path)
    else:
        from sentencepiece import SentencePieceProcessor

        wanted = [len(x) for x in SentencePieceProcessor(model_file=path).encode(texts)]
    assert [found[i] for i in range(len(texts))] == wanted


def test_odd_rows_and_clashing_columns(spark):
    docs = make(spark, ODD).union(make(spark, [None, "twice"], ids=[None, 3])).union(make(spark, ["twice"], ids=[3])).withColumns({"n_bytes": F.lit("x"), "n_tokens": F.lit(1), "over_limit": F.lit(2)})
    found = token_counts.token_counts(docs, FILE)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and found.count() == docs.count()
    assert found.where("doc_id IS NULL").first().n_tokens == 0 and found.where("doc_id = 3").count() == 3
    assert token_counts.token_counts(docs.where("false"), FILE).count() == 0
