"""SentencePiece codec against the library, and its edge cases."""

import random

import pytest

from tariffscope.llm import piece_codec

public_tokenizers = pytest.importorskip("public_tokenizers")
SIGNS = "ab ▁\n\té中①\U0001f600<0x4>/ś\x00�.,the"


@pytest.fixture(scope="module")
def codec():
    return piece_codec.codec(public_tokenizers.path("piece_bpe_32k.model"))


def _text(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice(SIGNS) for _ in range(n))


def test_any_text_is_encoded_as_by_the_library(codec):
    texts = [_text(i, i % 60) for i in range(1500)]
    assert codec.encode(texts) == [codec.library.encode(t) for t in texts]


def test_any_ids_are_decoded_as_by_the_library(codec):
    rng = random.Random(5)
    for _ in range(3000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(259) for _ in range(8)]
        assert codec.decode(ids) == codec.library.decode(ids)


def test_list_of_pairs_and_heap_agree(codec):
    for i in range(300):
        chunk = "▁" + _text(i, 25).replace(" ", "").replace("▁", "")
        assert codec._ids(codec._by_heap(chunk)) == codec._side_by_side([chunk])[0]


def test_long_chunks_and_ties(codec):
    texts = ["a" * 60_000, " " * 20_000, "ab" * 20_000 + " c", "\n" * 5_000, "é①" * 3_000]
    assert codec.encode(texts) == [codec.library.encode(t) for t in texts]


def test_memory_of_chunks_changes_nothing(codec, monkeypatch):
    monkeypatch.setattr(piece_codec, "CACHED_CHUNKS", 3)
    text = _text(1, 500)
    assert codec.encode([text]) == codec.encode([text]) == codec.encode([text]) == [codec.library.encode(text)]


def test_table_with_nulls_repeats_and_extra_columns(spark, codec):
    rows = [(1, None, 0, "x"), (1, None, 0, "x"), (None, "", 0, "y"), (3, "a  b ", 1, "z"), (4, "</s> and <0x41>", 1, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int, decoded string")
    got = piece_codec.encode(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert sorted((r.doc_id or 0, tuple(r.ids), r.decoded, r.as_library) for r in got) == sorted(
        (i or 0, tuple([*codec.library.encode(t or ""), 2]), t or "", True) for i, t, *_ in rows
    )
    none = piece_codec.encode(docs.limit(0), public_tokenizers.path("piece_bpe_32k.model"), end_id=False)
    assert none.columns == ["doc_id", "ids", "decoded", "as_library"] and none.count() == 0


def test_other_models_are_refused(codec):
    kinds = b"\x0a\x07\x0a\x03abc\x18\x04"
    with pytest.raises(ValueError, match="merge-type"):
        codec._accept(codec.library.serialized_model_proto() + kinds)
