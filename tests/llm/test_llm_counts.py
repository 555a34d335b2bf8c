"""Merkle manifests, importance resampling and token counts against brute force: nulls, blanks, ties, repeats, long texts, none at all."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm_small import corpus, direct, duck, table

from tapeworks.llm import common, crcspans, merkle, resample, tokencache
from tapeworks.llm.common import places, shared_folder
from tapeworks.llm.queries import ORACLE_SQL, tokenizer_file

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
DOCS = "doc_id bigint, source string, lang string, n_chars int, text string, size int, place int, key string, root string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([sha("".join(found[-1][i : i + 3])) for i in range(0, len(found[-1]), 3)])
    return found


def path_of(levels, i):
    out = []
    for nodes in levels[:-1]:
        first = i - i % 3
        out.append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + 3])))
        i //= 3
    return out


def manifest_of(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {s: levels_of([leaf_of(r) for r in by[s]]) for s in sources}
    top = levels_of([trees[s][-1][0] for s in sources])
    out = []
    for j, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            path = path_of(trees[s], i) + path_of(top, j)
            h = leaf_of((*r[:4], r[4].replace("\n", ""))) if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else leaf_of(r)
            for before, after in path:
                h = sha(before + h + after)
            out.append((r[0], leaf_of(r), trees[s][-1][0], top[-1][0], sha("".join(b + a for b, a in path)), h, h == top[-1][0]))
    return out


def sourced(seed, n):
    """Documents of a hot source, of many small ones and of none, with nulls in every column and rows that repeat."""
    rng = random.Random(seed)
    name = lambda: rng.choice(["hot"] * 4 + [None, "", "é", "z", "Z", f"s{rng.randrange(n)}"])
    rows = [(rng.randrange(4 * n) if rng.random() < 0.95 else None, name(), rng.choice(["en", None]), rng.choice([1, None, -5]), rng.choice(["a\nb", "", None, "x\n" * 400, "é\n日", "c"])) for _ in range(n)]
    return rows + rows[:7]


def framed(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k", "r") for r in rows], DOCS)


@pytest.mark.parametrize(("height", "n"), [(1, 90), (2, 200), (6, 60), (6, 1), (1, 0)])
def test_manifest_is_the_tree_by_hand(spark, height, n):
    rows = sourced(n, n)
    low, high = merkle.manifest(framed(spark, rows), height)
    assert table(merkle.proofs(low, high, height)) == sorted(manifest_of(rows), key=repr)
    assert n < 90 or len(low) > 1 and len(high) > 1


def test_manifest_equals_its_sql(spark):
    rows = sourced(3, 120)
    got = table(merkle.verify(framed(spark, rows)))
    assert got == sorted(duck(ORACLE_SQL["op11_merkle_manifest"], documents=(rows, "doc_id BIGINT, source VARCHAR, lang VARCHAR, n_chars INT, text VARCHAR")), key=repr) == sorted(manifest_of(rows), key=repr)


@pytest.mark.parametrize("levels", range(1, 8))
def test_addresses_fill_the_array_and_keep_subtrees_together(levels):
    at = [merkle.address(levels, d, np.arange(3**d)) for d in range(levels)]
    assert sorted(np.concatenate(at).tolist()) == list(range(merkle.nodes(levels)))
    above = levels // 2
    for d in range(above, levels):  # each subtree below the cut is one stretch
        for root in range(3**above):
            inner = at[d][root * 3 ** (d - above) : (root + 1) * 3 ** (d - above)]
            first = merkle.nodes(above) + root * merkle.nodes(levels - above)
            assert first <= inner.min() and inner.max() < first + merkle.nodes(levels - above)


def test_changed_leaf_changes_the_root(spark):
    rows = [(i, "s", "en", 3, f"text {i}") for i in range(30)]
    roots = {merkle.verify(framed(spark, r)).first()["root"] for r in (rows, rows[:-1], [(0, "s", "en", 3, "text X"), *rows[1:]], list(reversed(rows)))}
    assert len(roots) == 3


def features_of(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def resampled(docs, target, share=25):
    crc = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = ([0] * 10000 for _ in range(2))
    for counts, rows in ((s, [x for _, x in docs]), (t, target)):
        for text in rows:
            for f in features_of(text):
                counts[crc(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10000) / ((a + 1) * (sum(t) + 10000)))) for a, b in zip(s, t, strict=True)]
    out = []
    for i, text in docs:
        fs = features_of(text)
        weight = sum(gain[crc(f)] for f in fs) // len(fs) if fs else 0
        h = int(sha(f"7:{'' if i is None else i}")[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= 39), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for k in range(share * len(able) // 100):
        able[k][4] = k + 1
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("stretch", [1 << 18, 1000, 7])
def test_checksums_of_words_and_pairs(monkeypatch, stretch):
    monkeypatch.setattr(resample, "STRETCH", stretch)
    rng = random.Random(4)
    texts = [None, "", " ", "A-b", "日本語テスト " * 40 + "x" * 500, "q" * 5000, ("ab cd" + "z" * 300 + " ") * 9, "ends", "starts"]
    texts += ["".join(rng.choice("abcDEF 01\n.é日🙂") for _ in range(rng.randrange(200))) for _ in range(99)]
    texts.append(" ".join("".join(rng.choice("abcé") for _ in range(rng.choice([1, 3, 8, 63, 64, 65, 129, 700]))) for _ in range(300)))
    got = {i: [] for i in range(len(texts))}
    for of, buckets in resample.features(pa.array(texts, pa.string())):
        for i, b in zip(of.tolist(), buckets.tolist(), strict=True):
            got[i].append(b)
    for i, text in enumerate(texts):
        assert sorted(got[i]) == sorted(zlib.crc32(f.encode()) % 10000 for f in features_of(text))
    assert list(resample.features(pa.array([], pa.string()))) == []
    sliced = pa.array(texts, pa.string()).slice(5, 3)
    assert sum(len(b) for _, b in resample.features(sliced)) == sum(len(features_of(t)) for t in texts[5:8])


def test_long_spans_fold_blockwise():
    data = np.frombuffer(random.Random(5).randbytes(300_000), np.uint8)
    starts, ends = np.array([0, 1, 65, 200, 5000]), np.array([1, 65, 200, 5000, 300_000])
    got = crcspans.sums(data, starts, ends, ends) ^ crcspans.constants(ends - starts)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]


@pytest.mark.parametrize("rows", [corpus(9), [], [(1, None)]])
def test_resampling_by_hand_and_sql(spark, docs, rows):
    target = ["blére thaon oush", None, "", "erti " * 30]
    bench = spark.createDataFrame([(t, i) for i, t in enumerate(target)], "text string, rank int")
    got = table(resample.resample(docs(rows), bench))
    assert got == resampled(rows, target)
    sql = duck(ORACLE_SQL["op12_importance_resampling"], documents=(rows, "doc_id BIGINT, text VARCHAR"), benchmark=([(i, t) for i, t in enumerate(target)], "item_id BIGINT, text VARCHAR"))
    assert got == sorted(sql, key=repr)
    drawn = {r[0] for r in got if r[4] is not None}
    sampled = resample.sample(docs(rows), bench)
    assert sampled.columns == docs(rows).columns and {r["doc_id"] for r in sampled.collect()} == drawn
    assert table(resample.resample(docs(rows), bench.limit(0), share=100)) == resampled(rows, [], share=100)


def test_places_of_a_hot_group_span_many_tasks(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("key"), (F.col("id") % 5).alias("v"), F.lit(0).alias("part_"))
    got = places(common.cut(rows), ["key"], [F.col("v").desc()], "place", "size").collect()
    by = {}
    for r in got:
        by.setdefault(r["key"], []).append((r["place"], -r["v"]))
        assert r["size"] == sum(1 for x in got if x["key"] == r["key"]) if r["place"] == 0 else True
    for found in by.values():
        found.sort()
        assert [p for p, _ in found] == list(range(len(found))) and [v for _, v in found] == sorted(v for _, v in found)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_counts_are_the_library_s(spark, docs, name):
    rows, enc, path = corpus(11), direct(name), tokenizer_file(name)
    rows += [(700, "a  b"), (701, "a b"), (702, " a\tb\n"), (703, "a <|endoftext|>b"), (704, "a  b"), (None, None), (None, None), (705, "blé " * 3000)]
    want = sorted(((i, len((t or "").encode()), len(enc(t)) - 1, len(enc(t)) - 1 > 2048) for i, t in rows), key=repr)
    folder = shared_folder(spark)
    assert table(tokencache.token_counts(docs(rows), path, folder)) == want
    stored = spark.read.parquet(folder)
    assert stored.select("version", "digest").distinct().count() == len({tokencache_form(t, path) for _, t in rows})
    assert table(tokencache.token_counts(docs(rows).limit(0), path, shared_folder(spark))) == []


def tokencache_form(text, path):
    text = text or ""
    return re.sub(r"[\x20\x09-\x0D]+", " ", text).strip(" ") if tokencache.form(path) == "blanks" else text


def test_only_missing_counts_are_made_and_kept(spark, docs):
    path, folder = tokenizer_file("word_bpe_49k.json"), shared_folder(spark)
    rows = corpus(12)
    tokencache.token_counts(docs(rows[:20]), path, folder).collect()
    kept = spark.read.parquet(folder)
    n = kept.count()
    # A stored count is taken as it is: change one, and see it come back.
    marked = kept.withColumn("n_tokens", F.col("n_tokens") + 100_000)
    other = shared_folder(spark)
    marked.write.parquet(other)
    got = tokencache.token_counts(docs(rows), path, other)
    seen = {tokencache_form(t, path) for _, t in rows[:20]}
    for r, (_, text) in zip(sorted(got.collect(), key=repr), sorted(((i, t) for i, t in rows), key=repr), strict=True):
        assert r["n_tokens"] < 100_000 or r["over_limit"]
    assert sum(r["n_tokens"] >= 100_000 for r in got.collect()) == sum(tokencache_form(t, path) in seen for _, t in rows)
    assert spark.read.parquet(other).count() == n + len({tokencache_form(t, path) for _, t in rows} - seen)
    # Counts of another version aren't used.
    foreign = shared_folder(spark)
    kept.withColumn("version", F.lit("other")).withColumn("n_tokens", F.lit(7).cast("long")).write.parquet(foreign)
    enc = direct("word_bpe_49k.json")
    assert table(tokencache.token_counts(docs(rows[:5]), path, foreign).select("n_tokens")) == sorted(((len(enc(t)) - 1,) for _, t in rows[:5]), key=repr)
