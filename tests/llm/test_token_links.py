"""Cross-tokenizer alignment against brute force, and its edge cases."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tariffscope.llm import token_links

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = "the of and price list hospital charges über Straße naïve 12345 x=1 don't --- été № 日本語 \U0001f600 a b tab\there new\nline <|endoftext|> </s>".split(" ")


@pytest.fixture(scope="module")
def paths():
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _texts():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(40))) + rng.choice(["", " ", "\n", "  \n "]) for _ in range(60)]
    return [*texts, texts[3], texts[3], None, "", " ", "\n\n", "mark ▁ inside", "a" * 3000, " " * 500 + "x", "the", "the"]


def _brute(texts, paths):
    """Rows by two plain loops: the libraries' own tokens, all overlaps, counts in a dictionary."""
    from tokenizers import Tokenizer

    from tariffscope.llm import piece_codec

    first = Tokenizer.from_file(paths[0])
    first.encode_special_tokens = True
    second = piece_codec.codec(paths[1])
    table = token_links.ByteLevel(paths[0]).token_bytes
    rows, documents = [], Counter()
    for text in texts:
        whole = b" " + (text or "").encode()
        a = [(i, table[i]) for i in first.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(i, second.token_bytes[i]) for i in second.library.encode(text)] if text else []
        if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            rows.append((0, 0, [], ""))
            continue
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, t in side:
                out.append((i, at, at + len(t)))
                at += len(t)
            spans.append(out)
        links = [(x[0], y[0]) for x in spans[0] for y in spans[1] if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in spans[0]} & {y[2] for y in spans[1]})
        groups = []
        for lo, hi in zip([0, *cuts], cuts, strict=False):
            sides = [",".join(str(i) for i, s, e in side if lo <= s and e <= hi) for side in spans]
            groups.append("|".join(sides))
        documents.update(set(links))
        rows.append((len(a), len(b), links, ";".join(groups)))
    highest = defaultdict(int)
    for (x, _), n in documents.items():
        highest[x] = max(highest[x], n)
    return [
        (a, b, g.count(";") + 1 if g else 0, len(k), sum(documents[p] == highest[p[0]] for p in k), sum(documents[p] for p in k), g)
        for a, b, k, g in rows
    ]


def _rows(found):
    return sorted((r.id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in found.collect())


@pytest.mark.parametrize(("block_bytes", "fan_in"), [(2 << 20, 128), (300, 2)])
def test_against_brute_force(spark, paths, monkeypatch, block_bytes, fan_in):
    monkeypatch.setattr(token_links, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(token_links, "FAN_IN", fan_in)
    texts = _texts()
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "id bigint, text string, pairs string").repartition(9)
    got = _rows(token_links.token_links(docs, *paths, id_col="id"))
    assert got == [(i, *r) for i, r in enumerate(_brute(texts, paths))]


def test_digest_repeated_rows_null_ids_and_empty_table(spark, paths):
    rows = [(None, "the price"), (1, "the price"), (1, "the price"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = token_links.token_links(docs, *paths, with_groups=False).collect()
    (_, _, _, n, best, total, groups), *_ = _brute([t for _, t in rows], paths)
    digest = hashlib.sha256(groups.encode()).hexdigest()
    assert sorted((r.doc_id or 0, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got) == sorted(
        [(i or 0, n, best, total, digest) for i in (None, 1, 1)] + [(2, 0, 0, 0, "")]
    )
    assert token_links.token_links(docs.limit(0), *paths).collect() == []


def test_runs_are_read_as_written():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**36, 3 * token_links.FRAME))
    counts = rng.integers(1, 2**40, len(keys))
    read = token_links.whole_run(token_links.write_run(keys, counts))
    assert np.array_equal(read[0], keys) and np.array_equal(read[1], counts)
    halves = [token_links.write_run(keys[i::2], counts[i::2]) for i in (0, 1)]
    merged = token_links.whole_run(token_links.merge_runs([*halves, halves[0]]))
    assert np.array_equal(merged[0], keys) and merged[1].sum() == counts.sum() + counts[::2].sum()


def test_chunks_are_encoded_as_the_whole_text(paths):
    own = token_links.ByteLevel(paths[0])
    rng = random.Random(7)
    signs = "ab ,.'s\n\t 　​\x1c\x85é中12_\U0001f600"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 40))) for _ in range(2000)]
    assert own.encode(texts) == [own._one(t) for t in texts]
