"""Long strings in whole texts: operators stay linear in a text's length."""

import base64
import random
import time

from pyspark.sql import functions as F
from test_llm_small import table

from tapeworks.llm import decontam, secretscan


def inline(rng, n):
    return base64.b64encode(rng.randbytes(n)).decode()


def test_secret_scan_takes_an_inline_image_in_seconds(spark, docs):
    rng = random.Random(6)
    image = inline(rng, 750_000)
    assert len(image) == 1_000_000
    texts = [f"before {image} after token=abc123xyz", " ".join(inline(rng, 3000) for _ in range(250)), "a1" * 500_000, "x" * 999_999 + "7", "plain words " * 9]
    began = time.monotonic()
    got = {r["doc_id"]: r["spans"] for r in secretscan.secrets(docs(list(enumerate(texts)))).collect()}
    assert time.monotonic() - began < 60
    assert [(s["kind"], s["start"], s["end"]) for s in got[0]][:2] == [(3, 7, 1_000_007), (0, 1_000_014, 1_000_029)]
    assert len(got[1]) > 230 and all(s["kind"] == 3 and s["end"] - s["start"] == 4000 for s in got[1])  # the rate of false discoveries takes a few
    assert [tuple(s) for s in got[2]] == [(0, 2, 1_000_000)] and got[3] == got[4] == []


def test_battery_is_the_same_for_a_string_wherever_it_stands(spark, docs):
    """One text with many strings, and each string in a text of its own."""
    rng = random.Random(7)
    strings = [inline(rng, rng.choice([20, 45, 300])).rstrip("=") for _ in range(40)] + ["aB1" * 9, "0" * 30, "abcdefghijklmnopqrst0123456789"]
    bins = lambda rows: table(secretscan.scan(docs(rows), "doc_id").select(F.explode("candidates").alias("c")).select("c.test.cell", "c.test.bin"))
    assert bins([(1, " ".join(strings))]) == bins(list(enumerate(strings)))


def windows_by_hand(items, doc, window=10):
    hit, found = [False] * len(doc), set()
    for name, words in items:
        k = min(window, len(words))
        some = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()
        for p in range(len(doc) - k + 1):
            if tuple(doc[p : p + k]) in some:
                found.add(name)
                hit[p : p + k] = [True] * k
    return hit, found


def test_automaton_on_repeated_words():
    """Few distinct words, so states have long chains of suffixes; and time in proportion to the words for one word repeated."""
    for seed in range(120):
        rng = random.Random(seed)
        words = [b"a", b"b", b"c"][: seed % 3 + 1]
        items = [(str(i), [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 5, 9, 10, 11, 30]))]) for i in range(rng.randrange(1, 6))]
        doc = [rng.choice([*words, b"x"] if seed % 2 else words) for _ in range(rng.randrange(60))]
        hit, found = decontam.Automaton(items, 10).scan(doc)
        assert (hit.tolist(), found) == windows_by_hand(items, doc)
    began = time.monotonic()
    hit, found = decontam.Automaton([("i", [b"a"] * 100_000)], 10).scan([b"a"] * 300_000)
    assert hit.all() and found == {"i"} and time.monotonic() - began < 20


def test_repeated_benchmark_items_fall_into_one_block_once(spark, docs):
    words = " ".join(f"w{i}" for i in range(30))
    bench = spark.createDataFrame([("1", words)] * 500 + [("2", "other " * 12)], "item_id string, text string")
    found = list(decontam.blocks(bench, block_words=60))
    assert sum(len(b.pieces) for b in found) == 2
    assert table(decontam.contamination(docs([(1, f"x {words} y")]), bench).select("n_hit", "n_items")) == [(30, 1)]
