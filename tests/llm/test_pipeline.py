"""The corpus pipeline against the same steps done one document at a time."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from tapeworks.llm import decontam, toxicity
from test_llm_small import WORDS, brute_lines, brute_simhash, check_places, corpus, crc, direct, text


def test_pipeline_is_the_steps_by_hand(spark, tmp_path):
    rng = random.Random(21)
    item = text(rng, 20)
    rows = [(i, t) for i, t in dict(corpus(9)).items() if i is not None]
    rows += [(2000 + i, f"{text(rng, 30)}{' vilex' if i % 4 == 0 else ''}\n{text(rng, 9)}") for i in range(300)]
    rows += [(3000, f"{text(rng, 30)} {item} {text(rng, 9)}"), (3001, item), (3002, f"{rows[0][1]}\nsecond line\nthird line"), (3003, f"{text(rng, 30)}\nsecond line\nthird line")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", F.lit("en").alias("lang"), F.lit("src0").alias("source"), F.length("text").cast("bigint").alias("n_chars"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i, 0, int("vilex" in (t or ""))) for i, t in rows if i >= 2000], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))

    model = toxicity.fit(df, labels)
    kept = [(i, t) for i, t in rows if model.score(t) < toxicity.THRESHOLD]
    toxic_left = sum("vilex" in (t or "") for _, t in kept)
    clean_gone = len(rows) - len(kept) - (75 - toxic_left)
    assert toxic_left <= 4 and clean_gone <= 0.1 * len(rows), (toxic_left, clean_gone)
    lines = brute_lines(kept, 2)
    kept = [(i, lines[i][0]) for i, _ in kept]
    first = {c for _, _, c in brute_simhash(kept)}
    kept = [(i, t) for i, t in kept if i in first]
    automaton = decontam.Automaton([("1", decontam.words_of(item))])
    clean = [(i, decontam.remove_hits(t, automaton.scan(decontam.words_of(t))[0])) for i, t in kept]
    kept = [(i, new) for (i, new), (_, old) in zip(clean, kept, strict=True) if old is None or new is not None]
    assert 3001 not in dict(kept) and item not in dict(kept)[3000]
    enc, want = direct("word_bpe_49k.json"), []
    for i, t in kept:
        ids = enc(t)
        want += [(i, k // 2048, k, len(ids[k : k + 2048]), crc(ids[k : k + 2048])) for k in range(0, len(ids), 2048)]

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    check_places(got, 2048)


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    rows = [(i, " ".join(random.Random(i).choices(WORDS, k=30))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("bigint").alias("n_chars"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, str(tmp_path))
        assert out.dtypes == df.dtypes and sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect())), name
        assert stage(spark, df.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, df.limit(0), str(tmp_path)).count() == 0
