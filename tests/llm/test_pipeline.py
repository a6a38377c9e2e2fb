"""The corpus pipeline against what brute force expects of every stage."""

import random
from collections import Counter

import corpus_pipeline
from tariffscope.llm import mixing

WORDS = [a + b + c for a in ("ba", "ko", "mi", "tu", "sel", "dra") for b in ("ran", "lit", "vor", "nem", "pas") for c in ("ta", "do", "rim", "", "eshk")]


def _prose(n, seed):
    chosen = random.Random(seed)
    return " ".join(chosen.choice(WORDS) for _ in range(n))


def _shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_each_stage_decides_as_brute_force(spark, tmp_path):
    passage = _prose(60, 900)
    texts = {i: _prose(60 + i % 50, i) for i in range(60)}
    texts |= {60: texts[3], 61: texts[3] + " extra", 62: texts[4].upper(), 63: "too short", 64: "again " * 80, 65: None, 66: ""}
    texts |= {67: f"{_prose(40, 67)} {passage} {_prose(40, 68)}", 68: passage}
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(i, t, "en", "web", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    clean = {i: t for i, t in texts.items() if t and len(t.split()) >= 10 and i != 64}
    first = {}
    for i in sorted(clean):
        sets = _shingles(clean[i])
        alike = [j for j in first if 100 * len(sets & _shingles(clean[j])) >= 80 * len(sets | _shingles(clean[j]))]
        if not alike:
            first[i] = clean[i]
    expected = {i: t for i, t in first.items() if passage not in t}
    assert set(expected) == set(range(60))

    docs = spark.createDataFrame([(i, t) for i, t in expected.items()], "doc_id bigint, text string")
    topics = {r.doc_id: r.topic for r in docs.select("doc_id", mixing.topic_of(docs["text"]).alias("topic")).collect()}
    tokens = Counter()
    for i, t in expected.items():
        tokens[topics[i]] += len(t.split())
    powers = {k: n**mixing.TEMPERATURE for k, n in tokens.items()}
    share = sum(tokens.values()) / sum(powers.values())
    below = {k for k in tokens if powers[k] * share / tokens[k] >= 1}
    kept = {r.doc_id for r in got}
    assert below and kept <= set(expected) and {i for i in expected if topics[i] in below} <= kept
    assert len(kept) == len(got) and len(kept) > len(expected) // 2

    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(24)) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in counts.items())


def test_repeated_rows_and_null_ids(spark, tmp_path):
    passage = _prose(60, 900)
    a, b, c, d, e, f = (_prose(70, i) for i in range(100, 106))
    rows = [(1, a), (1, a), (None, b), (None, b), (None, "too short"), (None, c), (2, d), (2, "too short"), (2, f"{e} {passage}"), (None, passage), (3, b), (None, f), (2, f)]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (1, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    told = []
    for name, stage in corpus_pipeline.STAGES[:3]:
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        assert now.columns == docs.columns
        told.append(Counter((r.doc_id, r.text) for r in now.collect()))
    good = Counter(r for r in rows if r[1] != "too short")
    assert told[0] == good
    assert told[1] == Counter({r: 1 for r in good if r not in ((None, b), (None, f))})
    assert told[2] == Counter([(1, a), (3, b), (None, c), (2, d), (2, f)])
    assert corpus_pipeline.quality(spark, docs, str(tmp_path)).count() == sum(good.values())
    got = Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert 0 < sum(got.values()) <= 5 and all(n <= Counter([1, 3, None, 2, 2])[i] for i, n in got.items())


def test_verdicts_as_bits_choose_the_same_rows_with_and_without_broadcast(spark, monkeypatch):
    rows = [0, 1, 63, 64, 127, 5000, 1 << 40, (1 << 40) + 63, 3 << 40]
    docs = spark.createDataFrame([(r, f"t{r}") for r in range(6000)] + [(r, "far") for r in rows if r >= 6000], "_row bigint, text string")
    chosen = spark.createDataFrame([(r,) for r in [*rows, 7]], "_row bigint")
    for limit in (corpus_pipeline.MARKED_CHUNKS, 1):
        monkeypatch.setattr(corpus_pipeline, "MARKED_CHUNKS", limit)
        kept = corpus_pipeline._chosen(docs, chosen, keep=True)
        assert kept.columns == ["text"] and kept.count() == len(rows) + 1
        assert Counter(r.text for r in kept.collect())["far"] == 3
        assert corpus_pipeline._chosen(docs, chosen, keep=False).count() == docs.count() - len(rows) - 1
