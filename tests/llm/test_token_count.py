import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weekloom.llm import ragged
from weekloom.llm.queries import QUERIES
from weekloom.llm.token_count import token_counts
from tests.conftest import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " \n", "it's we'll DON'T '", "aaaa aaaaa aaaaaa", "a" * 3000, "#" * 70_000, "x<|endoftext|>y <|startoftext|>", "<|ENDOFTEXT|>",
    "Σας ΟΔΟΣ İstanbul ﬁ", "\x1c a b\x85d", "école ́", "12345 ½ ²", "日本語テスト 😀😀 👩‍👩‍👧", "a\x00b", "no break",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def wanted(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_odd_texts(spark, library, monkeypatch):
    monkeypatch.setattr(ragged, "SLICE_BYTES", 50)
    rows = [(i, t, 0) for i, t in enumerate(ODD)] + [(None, "x y", 0), (3, ODD[3], 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    out = token_counts(docs, PATH).collect()
    assert [r.n_tokens for r in out] == wanted(library, [t for _, t, _ in rows])
    assert [r.n_bytes for r in out] == [len((t or "").encode()) for _, t, _ in rows]
    assert [r.doc_id for r in out] == [d for d, _, _ in rows]
    assert [r.over_limit for r in out] == [r.n_tokens > 2048 for r in out]
    assert token_counts(docs.limit(0), PATH).collect() == []


def test_query_counts_like_the_library(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], wanted(library, [r.text for r in docs]), strict=True))
    assert {r.doc_id: r.n_tokens for r in QUERIES["op9_token_counts"](spark, SMALL).collect()} == want
