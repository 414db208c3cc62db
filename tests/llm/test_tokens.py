import random

import public_tokenizers
import pytest
import sentencepiece

from docloom.llm import merging, pieces
from tests.llm.helpers import documents

ODD = [
    None, "", " ", "a  b", " a b ", "a\nb", "a\tb\r\n", "Ｆｕｌｌ ﬁ", "<s>x</s> </s><unk>", "▁▁a", "a\xa0b", "é", "a\x00b", "\n", "\n\n a", "a \n b", "😀😀 😀x", "x" * 3000, "ab" * 700 + " " * 300,
    " " * 1000, "日本語のテキスト" * 100, "don't  stop\n\n\n  ok", "The quick brown fox", "The quick brown fox",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def some_texts():
    r = random.Random(3)
    return ODD + ["".join(r.choice("ab the in\n\t.,éß▁日😀xyz0") for _ in range(r.randint(0, 300))) for _ in range(300)]


def test_counts_are_the_librarys(spark, library):
    texts = some_texts()
    got = {r["doc_id"]: r for r in merging.count_tokens(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert got[i]["n_tokens"] == len(library.encode(text or "")), text
        assert got[i]["n_bytes"] == len((text or "").encode())


def test_limit_and_clashing_columns(spark):
    rows = documents(spark, ["a b c", None]).withColumnRenamed("n_chars", "n_tokens")
    got = merging.count_tokens(rows, limit=2).orderBy("doc_id").collect()
    assert [r["over_limit"] for r in got] == [True, False]
    assert merging.count_tokens(documents(spark, [])).count() == 0


def test_ids_are_the_librarys_and_decode(spark, library):
    texts = some_texts()
    got = {r["doc_id"]: r for r in pieces.encode_decode(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "")
        assert got[i]["ids"] == ids, text
        assert got[i]["decoded"] == library.decode(ids)
        assert got[i]["round_trip"]
        assert got[i]["lang"] == "en"


def test_encoder_with_a_tiny_memory(library):
    encoder = pieces.Encoder(memory=3)
    for text in some_texts():
        assert encoder.encode([text or ""])[0].tolist() == library.encode(text or "")


def test_encode_replaces_clashing_columns_and_empty_table(spark):
    rows = documents(spark, ["x y"]).withColumnRenamed("n_chars", "ids")
    assert pieces.encode_decode(rows).first()["n_tokens"] > 0
    assert pieces.encode_decode(documents(spark, [])).count() == 0
