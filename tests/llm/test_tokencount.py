import public_tokenizers
import pytest
from llm_rows import SCHEMA, document

from shoptrail.llm import tokencount
from shoptrail.runtime import work_folder

RANKS, SPECIAL = "byte_bpe_50k.tiktoken", {"<|endoftext|>": 50256}


def rows_of(docs, name, cache, special=None):
    found = tokencount.token_counts(docs, public_tokenizers.path(name), cache, special)
    return sorted(map(tuple, found.collect()), key=repr)


def expected(rows, name):
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        encode = lambda t: Tokenizer.from_file(public_tokenizers.path(name)).encode(t, add_special_tokens=False).ids
    else:
        from sentencepiece import SentencePieceProcessor

        encode = SentencePieceProcessor(model_file=public_tokenizers.path(name)).encode
    return sorted(((r[0], len((r[1] or "").encode()), len(encode(r[1] or ""))) for r in rows), key=repr)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_the_librarys(spark, edge_docs, edge_rows, name):
    assert rows_of(edge_docs, name, work_folder(spark, "cache")) == expected(edge_rows, name)


def test_rank_file_counts_as_the_vocabulary_file(spark, edge_rows):
    odd = ["<|endoftext|>", "a<|endoftext|> b", "<|endoftext|", "    x \r\n\n 12345 don't I'LL", "\x00\x01\x7f", "ab" * 9000, "!" * 9000]
    rows = edge_rows + [document(900 + k, t) for k, t in enumerate(odd)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(docs, RANKS, work_folder(spark, "cache"), SPECIAL) == expected(rows, "byte_bpe_50k.json")


def test_rank_file_agrees_on_every_character():
    whole = tokencount.counter(public_tokenizers.path("byte_bpe_50k.json"), ())
    ranks = tokencount.counter(public_tokenizers.path(RANKS), tuple(SPECIAL.items()))
    texts = [f"ab{c}cd {c}1{c} {c}{c}!\n{c}" for c in map(chr, [*range(1, 0xD800), *range(0xE000, 0x110000)])]
    texts = ["".join(texts[k : k + 500]) for k in range(0, len(texts), 500)]
    assert whole(texts) == ranks(texts)


def test_only_distinct_misses_are_encoded(spark, edge_docs, edge_rows):
    cache = work_folder(spark, "cache")
    stored = lambda: spark.read.parquet(cache).count()
    first = rows_of(edge_docs, RANKS, cache, SPECIAL)
    n = len({r[1] or "" for r in edge_rows})
    assert stored() == n
    assert rows_of(edge_docs, RANKS, cache, SPECIAL) == first
    assert stored() == n
    more = edge_docs.union(spark.createDataFrame([document(1000, "a new text")], SCHEMA))
    assert len(rows_of(more, RANKS, cache, SPECIAL)) == len(first) + 1
    assert stored() == n + 1
    rows_of(edge_docs, RANKS, cache)  # another version of the tokenizer has counts of its own
    assert stored() == 2 * n + 1


def test_empty(spark, no_docs):
    assert rows_of(no_docs, RANKS, work_folder(spark, "cache"), SPECIAL) == []
