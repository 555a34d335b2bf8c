"""Each corpus operator against brute force or a round trip on small tables: nulls, blanks, ties, repeats, long texts, none at all."""

import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tapeworks.llm import decontam, exactdup, jaccard, linedup, packing, secretscan, simhash, store, substring, tokens, toxicity, urlfilter
from tapeworks.llm.common import shared_folder
from tapeworks.llm.queries import ORACLE_SQL, tokenizer_file

WORDS = [a + b for a in ("tha", "ning", "er", "ou", "blé", "ü") for b in ("on", "sh", "re", "ti", "wh", "ñ")]
UPPER = {ord(c): ord(c) - 32 for c in "abcdefghijklmnopqrstuvwxyz"}
ODD = [None, "", " \n\t ", "x", "É", "a\x1cb c", "日本語 テスト", "🙂 " * 3, "it's <|endoftext|> !! ?!", "a  b\n\n c "]


def text(rng, n, words=WORDS):
    return " ".join(rng.choice(words) for _ in range(n))


def corpus(seed=1, n=30):
    """Random texts, copies, shared passages, odd ones, one very long; ids out of order, one null."""
    rng = random.Random(seed)
    shared = text(rng, 60)
    rows = [(i * 7 % 101, text(rng, rng.randrange(1, 90))) for i in range(n)]
    rows += [(200 + i, rows[i][1]) for i in range(5)] + [(300 + i, f"{text(rng, 9)} {shared}\n{text(rng, 9)}") for i in range(4)]
    rows += [(400 + i, t) for i, t in enumerate(ODD)] + [(500, text(rng, 9000)), (501, "a " * 120), (None, text(rng, 40)), (600, rows[0][1]), (600, rows[0][1])]
    rng.shuffle(rows)
    return rows


def table(df):
    return sorted(map(tuple, df.collect()), key=repr)


def duck(sql, **tables):
    """Rows of a registered SQL query over small tables: name=(rows, columns)."""
    con = duckdb.connect()
    for name, (rows, columns) in tables.items():
        con.execute(f"CREATE TABLE {name} ({columns})")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return con.execute(sql).fetchall()


def direct(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file(name))
    return lambda x: [*t.encode(x or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_ids_are_the_library_s(name, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    e, want = tokens.Encoder(tokenizer_file(name)), direct(name)
    texts = [t or "" for _, t in corpus()] + ["Straße, ÉTÉ; Zebra...", "ΑΣ ΟΔΟΣ", "\r\n x", "e\u0301 \u0301a", "İ ﬁ ½ ²", " lead", "trail ", "a\u00a0b", "word,word (word) 'tis 12a4", "\n\n", "a\n b \nc"]
    assert e.kind != "unknown" and e.direct
    rng = random.Random(15)
    parts = ["a", "É", "ß", "9", ".", "'s", '"', "日", "µ", "×", "\u0301", "Σ", "the", "Tion", "İ", "$$", "<|endoftext|>"]
    blanks = [" "] * 9 + ["\n"] * 3 + ["  ", "\t", "\r\n", "\n ", "\u00a0", "\x1c", "\x85"]
    texts += ["".join(rng.choice(parts) + (rng.choice(blanks[: 12 if k % 3 else None]) if rng.random() < 0.5 else "") for _ in range(rng.randrange(40))) for k in range(500)]
    monkeypatch.setattr(tokens, "GROUP_BYTES", 3000)
    got = [ids[a:b].tolist() for ids, at in e.encode(pa.array(texts)) for a, b in itertools.pairwise(at.tolist())]
    assert got == [want(t) for t in texts]
    assert list(e.encode(pa.array([], pa.string()))) == []


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_round_trip(docs):
    rows = corpus()
    packed = packing.pack_documents(docs(rows), tokenizer_file("word_bpe_49k.json"), with_ids=True)
    got, enc = packed.collect(), direct("word_bpe_49k.json")
    want = []
    for i, t in rows:
        ids = enc(t)
        want += [(i, k // 2048, k, len(ids[k : k + 2048]), crc(ids[k : k + 2048])) for k in range(0, len(ids), 2048)]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=repr) == sorted(want, key=repr)
    check_places(got, 2048)
    assert sum(r["n_ids"] * 4 == len(r["ids"]) for r in packing.assemble(packed).collect()) == len({r["sequence_id"] for r in got})
    assert packing.pack_documents(docs(rows).limit(0), tokenizer_file("word_bpe_49k.json")).count() == 0


def one_by_one(hist, cap):
    """Bins of best fit, longest item first, one item at a time."""
    gaps = []
    for n in sorted((n for n, c in hist.items() for _ in range(c)), reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else cap) - n)
    return len(gaps)


def test_best_fit_uses_few_bins():
    rng = random.Random(3)
    for case in range(60):
        cap = rng.choice([10, 64, 2048])
        hist = {}
        for _ in range(rng.randrange(0, 40)):
            hist[rng.randrange(1, cap + 1)] = rng.choice([1, 2, 3, 40])
        bins = packing.best_fit(hist, cap)
        used = {}
        for b in bins:
            assert sum(n * k for n, k in b.items) == cap - b.gap and b.gap >= 0
            for n, k in b.items:
                used[n] = used.get(n, 0) + k * b.count
        assert used == hist, case
        assert sum(b.count for b in bins) <= one_by_one(hist, cap)
    assert packing.best_fit({}) == []
    with pytest.raises(ValueError):
        packing.best_fit({11: 1}, 10)


URLS = [None, "", "nothing", "http://A.Example.ORG/es/1", "https://x.example.org/en/12?q", "https://x.example.org/en/2", "http://b.com/fr/", "http://b.com/de/9#a", "http://org", "http://evilorg/", "//x.org/", "http://shop.net/es/7", "http://shop.net/en/7", "x://u@h.com:80/de/1"]


def test_url_rules_by_hand(spark):
    rows = [(i, u) for i, u in enumerate(URLS * 3)]
    got = urlfilter.judge(spark.createDataFrame(rows, "page_id bigint, url string")).orderBy("page_id").collect()
    assert len(got) == len(rows)
    for r in got:
        u = URLS[r["page_id"] % len(URLS)] or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fit = [(h + p, v) for v, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want = max(fit, key=lambda x: len(x[0])) if fit else (None, None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, want[0])
        assert r["verdict"] == want[1] if want[1] else r["verdict"] in ("allow", "block")
    assert urlfilter.judge(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


def test_url_templates_learn_from_labelled_branches(spark):
    rows = [(i, f"http://h{i % 3}.example.org/{'es' if i % 2 else 'en'}/{20 + i}") for i in range(120)] + [(1000 + i, f"http://new.net/{'es' if i % 2 else 'en'}/{i}") for i in range(20)]
    got = urlfilter.judge(spark.createDataFrame(rows, "page_id bigint, url string")).filter("rule IS NULL").collect()
    assert {(r["path"][1:3], r["verdict"]) for r in got} == {("es", "block"), ("en", "allow")}


def brute_templates(rows):
    """Template and purity of each (host, shape, label) by growing each host's tree one node at a time."""
    counts = {}
    for host, sh, label in rows:
        c = counts.setdefault((host, sh), [0, 0, 0])
        c[0] += 1
        c[1] += label is not None
        c[2] += label or 0
    add = lambda cs: [sum(x) for x in zip(*cs, strict=True)] if cs else [0, 0, 0]
    P = urlfilter.PRIOR
    _, all_l, all_b = add(list(counts.values()))
    base = (all_b + 0.5 * P) / (all_l + P) if all_l else 0.0
    out = {}

    def alike(c, group):
        _, n, b = c
        share = group[2] / group[1] if group[1] else 0
        return n == 0 or (b - n * share) ** 2 <= urlfilter.ALIKE * n * share * (1 - share)

    def grow(node, paths):
        """paths: [(key, rest, purity)]"""
        _, n, b = add([counts[k] for k, _, _ in paths])
        paths = [(k, rest, (b + P * p) / (n + P)) for k, rest, p in paths]
        rests = {tuple(r) for _, r, _ in paths}
        if not 0 < b < n or len(rests) == 1:
            for k, rest, p in paths:
                out[k] = (node + ("".join("/" + x for x in rest) if len(rests) == 1 else "/**"), p)
            return
        at = 0
        while len({(*r, None)[: at + 1] for r in rests}) == 1:
            at += 1
        children = {}
        for k, rest, p in paths:
            children.setdefault(rest[at] if len(rest) > at else "$", []).append((k, rest, p))
        cs = {c: add([counts[k] for k, _, _ in x]) for c, x in children.items()}
        total = add(list(cs.values()))
        names = {}
        many = len(cs) > urlfilter.KINDS and len(cs) > urlfilter.KINDS_SHARE * total[0]
        for c, x in cs.items():
            names[c] = "*" if many or alike(x, total) else "{more}" if x[2] - x[1] * total[2] / total[1] > 0 else "{less}"
        for side in ("{more}", "{less}"):
            mine = [c for c in cs if names[c] == side]
            group = add([cs[c] for c in mine])
            for c in mine:
                if len(mine) < 2 or not alike(cs[c], group):
                    names[c] = c
        merged = {}
        for c, x in children.items():
            merged.setdefault(names[c], []).extend((k, rest[at + 1 :], p) for k, rest, p in x)
        shared = "".join("/" + x for x in paths[0][1][:at])
        for name, x in merged.items():
            grow(f"{node}{shared}/{name}", x)

    for host in {h for h, _ in counts}:
        start = []
        for k in counts:
            if k[0] == host:
                _, n, b = add([c for (_, sh), c in counts.items() if sh == k[1]])
                start.append((k, k[1][1:].split("/") if k[1] else [], (b + P * base) / (n + P)))
        grow("", start)
    return out


def test_url_trees_are_brute_force(spark):
    rng = random.Random(31)
    rows = []
    for i in range(900):
        host = rng.choice(["a.org", "a.org", "b.com", "c.net"])
        parts = [rng.choice(["en", "es", "de"]), *(rng.choice(["x", "y", "z", "", "*", "q{n}"]) for _ in range(rng.randrange(6)))]
        if rng.random() < 0.3:
            parts = ["p", "q", "r", rng.choice(["de", "good", "bad", "fine"]), f"slug{rng.randrange(40)}"]
        path = rng.choice(["", "/" + "/".join(parts)]) if i % 50 == 0 else "/" + "/".join(parts)
        odds = 0.9 if "/de" in path or "bad" in path or "/x/y" in path else 0.1
        rows.append((i, host, path, None if rng.random() < 0.4 else int(rng.random() < odds)))
    df = spark.createDataFrame(rows, "page_id bigint, host string, path string, label int").withColumn("shape", urlfilter.shape(F.col("path")))
    got = {(r["host"], r["shape"]): (r["template"], r["purity"]) for r in urlfilter.templates(df).collect()}
    want = brute_templates([(r["host"], r["shape"], r["label"]) for r in df.collect()])
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9, k
    assert {x for t, _ in want.values() for x in t.split("/")} >= {"{more}", "{less}", "*", "**"}


def test_url_templates_differ_in_their_last_segments(spark):
    rows = [(i, f"http://h.example.org/p/q/r/{'de' if i % 2 else 'good'}/s/t/{i}") for i in range(60)]
    rules = [("block", "example.org", f"/p/q/r/de/s/t/{d}") for d in (1, 3)] + [("allow", "example.org", f"/p/q/r/good/s/t/{d}") for d in (2, 4)]
    got = urlfilter.judge(spark.createDataFrame(rows, "page_id bigint, url string"), rules).filter("rule IS NULL").collect()
    assert len(got) > 20 and {("/de/" in r["path"], r["verdict"]) for r in got} == {(True, "block"), (False, "allow")}
    assert {r["template"] for r in got} == {"/p/q/r/de/s/t/{n}", "/p/q/r/good/s/t/{n}"}


def brute_spans(t):
    t = t or ""
    pattern = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end()) for m in pattern.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24])


def test_secret_base_spans(docs):
    rng = random.Random(5)
    h = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    texts = [*ODD, f"é token = {h(40)} x", f'PASSWORD:"abc" secret=\'abcdef\' api_key : {h(5)} apikey={h(30)}', "token: token = abcdef", "token=token=abcdef", "AKIA" + "A1" * 8, "AKIA" + "A1" * 7, f"🙂{h(23)}g{h(24)}{h(1)}", "x" + h(64) + "\n" + h(24), "secret=" + "a" * 5, "z " * 4000 + f"passwd={h(9)}"]
    got = secretscan.secrets(docs(list(enumerate(texts)))).collect()
    for r in got:
        base = [(s["start"], s["kind"], s["end"]) for s in r["base"]]
        assert base == brute_spans(texts[r["doc_id"]])
        assert base == [(s["start"], s["kind"], s["end"]) for s in r["spans"] if s["kind"] < 3]
    assert len(got) == len(texts) and secretscan.secrets(docs([]).limit(0)).count() == 0


def brute_battery(raw):
    """Encoding, class and bin of a candidate by the three tests' own formulas, one symbol at a time."""
    which = next(i for i, (_, must, _) in enumerate(secretscan.ENCODINGS) if re.search(must, raw))
    s = raw.replace("=", "").replace("-", "+").replace("_", "/")
    s = s.lower() if which == 1 else s
    alphabet = secretscan.ENCODINGS[which][2]
    n, size, v = len(s), len(alphabet), [alphabet.index(c) + 1 for c in s]
    z_chi = (size / n * sum(v.count(k) ** 2 for k in range(1, size + 1)) - n - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n)
    up = [x > size / 2 for x in v]
    runs, k = 1 + sum(a != b for a, b in itertools.pairwise(up)), sum(up)
    expected = 2 * k * (n - k) / n + 1
    spread = (expected - 1) * (expected - 2) / (n - 1)
    z_runs = (runs - expected) / math.sqrt(spread) if spread > 0 else math.sqrt(n)
    mean = sum(v) / n
    power = sum((x - mean) ** 2 for x in v)
    z_serial = sum((a - mean) * (b - mean) for a, b in itertools.pairwise(v)) / power * math.sqrt(n) if power > 0 else math.sqrt(n)
    total = max(z_chi, 0) ** 2 + z_runs**2 + z_serial**2
    z = ((total / 3) ** (1 / 3) - (1 - 2 / 27)) / math.sqrt(2 / 27)
    log10_p = -math.log10(1 + math.exp(min(1.5976 * z + 0.07056 * z**3, 690)))
    return which, which * 16 + min(int(math.log2(n)), 12), min(math.floor(-log10_p * secretscan.BINS_A_DECADE), secretscan.BINS)


#: Alphabets of random strings, as they are written.
RANDOM = {"hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}


def test_battery_is_brute_force(docs):
    rng = random.Random(16)
    strings = ["".join(rng.choice(a) for _ in range(n)) for a in (*RANDOM.values(), "0123456789", "ab1", "1") for n in (20, 21, 33, 64, 200)]
    strings += ["the_content_of_page_12_of_section", "a1" * 15, "0" * 30, "ABCDEF0123456789ABCDEF", "getTheDocumentFromTheFirstDatabase"]
    got = secretscan.scan(docs(list(enumerate(strings))), "doc_id").collect()
    seen = 0
    for r in got:
        for c in r["candidates"]:
            t = c["test"]
            which, cell, bin_ = brute_battery(strings[r["doc_id"]][c["start"] : c["end"]])
            assert (t["encoding"], t["cell"]) == (which, cell) and abs(t["bin"] - bin_) <= 1, strings[r["doc_id"]]
            seen += 1
    assert seen >= len(strings) - 1


def test_false_discoveries_are_held(docs):
    """Thresholds are Benjamini-Hochberg's over the binned p-values of each class."""
    rng = random.Random(17)
    strings = ["".join(rng.choice(RANDOM["base64"]) for _ in range(40)) for _ in range(60)] + [f"the_content_of_page_{rng.randrange(10**6):06d}_x" for _ in range(200)]
    scanned = secretscan.scan(docs(list(enumerate(strings))), "doc_id")
    cells = {}
    for r in scanned.collect():
        for c in r["candidates"]:
            cells.setdefault(c["test"]["cell"], []).append(c["test"]["bin"])
    want = {}
    for cell, bins in cells.items():
        ok = [b for b in set(bins) if 10 ** (-b / 20) <= 0.05 * sum(x >= b for x in bins) / len(bins)]
        want[cell] = min(ok, default=secretscan.BINS + 1)
    assert secretscan.thresholds(scanned) == want


@pytest.mark.parametrize("length", [20, 32, 64])
def test_recall_and_precision_by_encoding(docs, length):
    """At least nine of ten random strings of each encoding are found among words, and nine of ten found strings are random."""
    rng = random.Random(length)
    words = ["page", "section", "item", "the", "content", "draft", "chapter", "final"]
    plain = []
    while len(plain) < 900:
        p = "_".join(rng.choice(words) for _ in range(2 + length // 6)) + f"_{rng.randrange(9)}"
        if p[: length + 9].strip("_") and len(p) >= 20:
            plain.append(p)
    secret = [(k, "".join(rng.choice(a) for _ in range(length))) for k, a in RANDOM.items() for _ in range(150)]
    strings = [s for _, s in secret] + plain
    got = {r["doc_id"]: r["spans"] for r in secretscan.secrets(docs([(i, f"see {t} here") for i, t in enumerate(strings)])).collect()}
    hit = [any((s["start"], s["end"]) == (4, 4 + len(t)) for s in got[i]) for i, t in enumerate(strings)]
    for kind in RANDOM:
        mine = [h for h, (k, _) in zip(hit, secret, strict=False) if k == kind]
        assert sum(mine) >= 0.9 * len(mine), (kind, sum(mine))
    assert sum(hit[: len(secret)]) >= 0.9 * sum(hit), sum(hit[len(secret) :])


def test_letters_of_mixed_case_are_tested(docs):
    rng = random.Random(18)
    strings = ["".join(rng.choice(RANDOM["base64"][:52]) for _ in range(40)) for _ in range(50)]
    got = secretscan.secrets(docs([(i, f"see {t} here") for i, t in enumerate(strings)])).collect()
    assert sum(bool(r["spans"]) for r in got) >= 45


def test_redaction(spark):
    """Spans are masked whatever the row's id, overlapping ones as one; columns may have any names."""
    rng = random.Random(19)
    h = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    many = " ".join(h(30) for _ in range(600))
    rows = [(1, f"password={h(30)} é x"), (1, "nothing here"), (None, "password=abcdef123 y"), (3, None), (4, ""), (5, many), (6, f"token={h(24)}g{h(25)}.{h(24)}")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", *(F.lit(1).alias(c) for c in ("spans_", "scanned_", "base_", "candidates_", "base", "candidates", "at")))
    out = secretscan.redact(df)
    assert out.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted([(1, "[secret] é x"), (1, "nothing here"), (None, "[secret] y"), (3, None), (4, ""), (5, " ".join(["[secret]"] * 600)), (6, "[secret]")], key=repr)
    assert secretscan.redact(df.limit(0)).count() == 0


def brute_contamination(t, items, window=10):
    ws = decontam.words_of(t)
    hit, found = set(), set()
    for item, it in items:
        iw = decontam.words_of(it)
        n = min(window, len(iw))
        grams = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(ws) - n + 1):
            if n and tuple(ws[i : i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(item)
    return len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(str(x) for x in found if x is not None)).encode()).hexdigest(), bool(hit)


def test_contamination_is_brute_force(spark, docs):
    rng = random.Random(8)
    few = WORDS[:4]
    items = [(i, text(rng, rng.choice([3, 8, 12, 30]), few)) for i in range(12)] + [(50, None), (51, ""), (52, "Tha-ON!"), (10, text(rng, 12)), (10, text(rng, 11)), (None, text(rng, 9, few)), (None, text(rng, 15, few)), (70, text(rng, 200, few))]
    rows = [(i, text(rng, rng.randrange(1, 80), few if i % 2 else WORDS)) for i in range(40)] + [(90 + i, t) for i, t in enumerate(ODD)] + [(200, f"{text(rng, 20)} {(items[3][1] or '').upper()}, {text(rng, 5)}"), (201, text(rng, 400, few))]
    rows += [(300 + i, rows[-1][1]) for i in range(20)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (200_000, 25):
        got = {r["doc_id"]: tuple(r)[1:] for r in decontam.contamination(docs(rows), bench, block_words=block).collect()}
        assert got == {i: brute_contamination(t, items) for i, t in rows}
    by_sql = duck(ORACLE_SQL["op4_benchmark_decontamination"], documents=(rows, "doc_id BIGINT, text VARCHAR"), benchmark=(items, "item_id BIGINT, text VARCHAR"))
    assert {r[0]: r[1:] for r in by_sql} == got
    every = list(decontam.blocks(bench, block_words=25))
    assert len(every) > 9 and max(sum(len(w.split()) for _, w in b.pieces) for b in every) < 200
    assert sum(len(b.pieces) for b in decontam.blocks(bench)) < sum(len(b.pieces) for b in every)
    assert decontam.contamination(docs(rows), bench.limit(0)).filter("contaminated").count() == 0


def test_decontamination_removes_spans_and_keeps_the_rest(spark, docs):
    rng = random.Random(9)
    item = text(rng, 30)
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    head, tail = text(rng, 12), text(rng, 12)
    rows = [(1, f"{head}, ({item.translate(UPPER)}) {tail}"), (2, item), (3, f"{head}\n\n{tail}"), (4, None), (5, "")]
    for block in (200_000, 11):
        got = {r["doc_id"]: r["text"] for r in decontam.decontaminate(docs(rows), bench, block_words=block).collect()}
        assert got == {1: f"{head}, () {tail}", 3: rows[2][1], 4: None, 5: ""}


def brute_lines(rows, window, least_words=linedup.LEAST_WORDS):
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    seen, out = {}, {}
    for k in order:
        lines = (rows[k][1] or "").split("\n")
        at = [i for i, x in enumerate(lines) if x.strip(" \t\x0b\x0c\r")]
        gone = set()
        for j in range(len(at) - window + 1):
            run = tuple(lines[i].strip(" \t\x0b\x0c\r") for i in at[j : j + window])
            if run in seen:
                gone.update(at[j : j + window])
            seen.setdefault(run, k)
        for i in at:
            line = lines[i].strip(" \t\x0b\x0c\r")
            if len(line.encode()) >= linedup.LEAST_BYTES or len(re.findall(r"[^ \t\x0b\x0c\r]+", line)) >= least_words:
                if line in seen:
                    gone.add(i)
                seen.setdefault(line, k)
        out[rows[k][0]] = ("\n".join(x for i, x in enumerate(lines) if i not in gone) if rows[k][1] is not None else None, len(at), len(gone))
    return out


@pytest.mark.parametrize("window", [1, 2, 3])
def test_line_dedup_is_brute_force(docs, window):
    rng = random.Random(window)
    lines = [text(rng, 3) for _ in range(9)] + ["", "  ", "A", "\tA \r"] + [text(rng, n) for n in (7, 8, 12)] + ["日本語" * 5, "日本語" * 5 + "字", "ไทย" * 20]
    rows = [(i * 13 % 97, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 12)))) for i in range(40)] + [(500 + i, t) for i, t in enumerate(ODD)] + [(700, "\n".join(["same"] * 400))]
    got = {r["doc_id"]: (r["text"], r["n_lines_"], r["n_removed_"]) for r in linedup.dedup_lines(docs(rows), window).collect()}
    assert got == brute_lines(rows, window)
    if window == 2:
        by_sql = duck(ORACLE_SQL["op5_line_dedup"], documents=(rows, "doc_id BIGINT, text VARCHAR"))
        assert sorted(by_sql) == sorted((i, n, k, hashlib.sha256((t or "").encode()).hexdigest()) for i, (t, n, k) in got.items())


def test_winnowing_guarantee():
    rng = np.random.default_rng(0)
    for w in (2, 3, 5):
        h = rng.integers(0, 9, 200).astype(np.uint64)
        at = linedup.minima(h, w)
        assert all(np.any((at >= i) & (at < i + w)) for i in range(len(h) - w + 1))


def test_line_dedup_of_repeated_rows_and_none(docs):
    same = [(1, "a\nb"), (1, "a\nb"), (None, "a\nb"), (None, "x\ny")]
    got = linedup.dedup_lines(docs(same)).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, "a\nb"), (1, "a\nb"), (None, ""), (None, "x\ny")], key=repr)
    assert linedup.dedup_lines(docs(same).limit(0)).count() == 0


def test_fuse_filter_has_no_false_negatives():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 17, 5000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        f = exactdup.build_filter(keys)
        assert exactdup.probe_filter(keys, *f).all()
        other = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
        assert exactdup.probe_filter(other, *f).mean() < 0.002


def brute_exact(rows):
    blank = re.compile(r"[\x20\x09-\x0D]")
    groups = {}
    for i, t in rows:
        groups.setdefault(blank.sub("", t or ""), []).append((-len(t or ""), i is None, i))
    out, done = [], set()
    for i, t in rows:
        bare = blank.sub("", t or "")
        best = min(groups[bare], key=lambda x: (x[0], x[1], x[2] or 0))
        stays = i == best[2] and -len(t or "") == best[0] and bare not in done
        if stays:
            done.add(bare)
        out.append((i, best[2], len(groups[bare]), stays, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_dedup_is_brute_force(docs):
    rows = corpus(2) + [(701, " a b"), (702, "ab\n\n\n"), (703, "ab"), (704, "a\u00a0b"), (1, "a b c d e"), (1, "a b c d e"), (1, "abc d  e "), (None, "qr"), (None, "qr"), (None, None)]
    d = docs(rows)
    half = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(True))
    by_sql = duck(ORACLE_SQL["op6_exact_dedup"], documents=(rows, "doc_id BIGINT, text VARCHAR"))
    assert sorted(by_sql, key=repr) == brute_exact(rows)
    for old in (half, F.lit(False), F.lit(True)):
        assert table(exactdup.dedup(d.filter(old), d.filter(~old))) == brute_exact(rows)
    same = docs([(1, "a b c d e")])
    assert sorted(r["kept"] for r in exactdup.dedup(same, same).collect()) == [False, True]  # across batches
    assert exactdup.dedup(d.limit(0), d.limit(0)).count() == 0


def brute_substring(rows, n=35):
    docs_, count = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows], {}
    for w in docs_:
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            count[k] = count.get(k, 0) + 1
    out = []
    for (i, _), w in zip(rows, docs_, strict=True):
        gone = {j + k for j in range(len(w) - n + 1) if count[tuple(w[j : j + n])] > 1 for k in range(n)}
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_substring_dedup_is_brute_force(docs, monkeypatch):
    rng = random.Random(11)
    two = WORDS[:2]
    rows = corpus(3) + [(800 + i, text(rng, 300, two)) for i in range(4)] + [(820 + i, " ".join(["a", "b"] * 30 + ["c"] * i)) for i in range(4)]
    rows += [(840 + i, " ".join([text(rng, 20), *["run"] * n, text(rng, 20)])) for i, n in enumerate((1, 2, 3, 20, 34, 35, 36, 90))]
    passage = [rng.choice(WORDS) for _ in range(500)]
    for i in range(40):  # passages of 33 to 45 words in other surroundings
        at, n = rng.randrange(400), rng.randrange(33, 46)
        rows.append((900 + i, " ".join([text(rng, rng.randrange(1, 9)), *passage[at : at + n], text(rng, rng.randrange(1, 9))])))
    assert table(substring.removals(docs(rows))) == brute_substring(rows)
    with monkeypatch.context() as m:
        m.setattr(substring, "GROUP_WORDS", 500)
        assert table(substring.removals(docs(rows))) == brute_substring(rows)
    left = {r["doc_id"]: r["text"] for r in substring.remove_repeats(docs(rows)).filter("doc_id >= 900").collect()}
    want = {r[0]: r[3] for r in brute_substring(rows) if (r[0] or 0) >= 900 and r[2]}
    assert {i: hashlib.sha256(left[i].encode()).hexdigest() for i in want} == want
    assert substring.removals(docs(rows).limit(0)).count() == 0


def test_equal_passages_have_equal_symbols_inside():
    assert [substring.unsure(substring.ROUNDS[:k]) for k in substring.LEVELS] == [7, 12]
    rng = np.random.default_rng(4)
    for case in range(300):
        kinds = (2, 6, 40)[case % 3]
        core = rng.integers(0, kinds, 35).astype(np.uint64)
        sides = [rng.integers(0, kinds, rng.integers(0, 20)).astype(np.uint64) for _ in range(4)]
        if case % 5 == 0:  # the passage begins or ends within a run that goes on in one place only
            sides[0][:], sides[3][:] = core[0], core[-1]
        a, b = np.concatenate([sides[0], core, sides[1]]), np.concatenate([sides[2], core, sides[3]])
        for level in (*substring.LEVELS, 1, 2):
            ends = substring.unsure(substring.ROUNDS[:level])
            inside = []
            for x, s in ((a, sides[0]), (b, sides[2])):
                found = zip(*substring.symbols(x, np.array([0]), substring.ROUNDS[:level]), strict=True)
                inside.append({(n, p - len(s), k) for n, p, k in found if p - len(s) >= ends and p - len(s) + k <= 35 - ends})
            assert inside[0] == inside[1]


def test_names_meet_share_by_share():
    """Equal first halves of 128-bit names don't make names equal; singles of one batch that stand in another aren't alone."""
    names = np.array([[1, 1], [1, 2], [1, 1], [5, 9], [5, 8], [5, 9], [7, 0]], np.uint64)
    assert substring._alone(names).tolist() == [False, True, False, False, True, False, True]
    assert substring._alone(np.zeros((0, 1), np.uint64)).tolist() == []
    rng = np.random.default_rng(6)
    sets = [rng.integers(0, 60, 50).astype(np.uint64) << np.uint64(58) for _ in range(3)]
    rows = [r for b, x in enumerate(sets) for r in substring._pack(x[:, None], np.arange(50), np.full(50, 3), b, 7)]
    rows.sort(key=lambda r: r[1])
    got = {(r["batch"], int(p)) for out in substring._meet(1)(substring._rows(rows[i : i + 2]) for i in range(0, len(rows), 2)) for r in out.to_pylist() for p in np.frombuffer(r["a"], "<u4")}
    every = np.concatenate(sets).tolist()
    assert got == {(b, i) for b, x in enumerate(sets) for i, v in enumerate(x.tolist()) if every.count(v) == 1}


def test_masks_cover_every_difference():
    masks = simhash.covering_masks()
    rng = random.Random(2)
    for bits in itertools.chain(itertools.combinations(range(16), 3), (rng.sample(range(64), 3) for _ in range(3000))):
        x = sum(1 << b for b in bits)
        free = [m for m in masks if not x & m]
        assert free and any(not x & f for f in simhash.finer_masks(free[0]))
    assert all(64 - f.bit_count() <= 12 for m in masks for f in simhash.finer_masks(m))


def brute_simhash(rows):
    fps = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        hs = [xxhash.xxh64(" ".join(w[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 2))] if w else []
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, f"{fps[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr)


def test_simhash_is_brute_force(docs, monkeypatch):
    rng = random.Random(12)
    base = text(rng, 400).split()
    rows = corpus(4) + [(1000 + i, " ".join(base[:i] + ["zz"] + base[i + 1 :])) for i in range(0, 300, 9)]
    got = simhash.near_duplicates(docs(rows))
    assert table(got) == brute_simhash(rows)
    kept = [r["doc_id"] for r in simhash.keep_one(docs(rows)).select("doc_id").collect()]
    first = {r["component_id"] for r in got.collect()}
    assert sorted(kept, key=repr) == sorted(first, key=repr)  # one row each, of repeated rows too
    assert simhash.near_duplicates(docs(rows).limit(0)).count() == 0


def brute_jaccard(a, b, k=5):
    sets = []
    for t in (a, b):
        w = t.lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def edited(rng, words, n):
    """``words`` with ``n`` of them replaced."""
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randrange(10**9)}"
    return out


def test_near_copies_over_five_words_go(docs, monkeypatch):
    """All pairs of 0.8 or more are linked, also through third documents and in buckets dealt in blocks; what is less alike stays."""
    rng = random.Random(6)
    rows = []
    for i in range(60):
        base = text(rng, rng.randrange(150, 400)).split()
        rows += [(10 * i, " ".join(base)), (10 * i + 1, " ".join(edited(rng, base, len(base) // 50))), (10 * i + 2, " ".join(edited(rng, base, len(base) // 12)))]
        if i < 9:
            again = edited(rng, rows[-2][1].split(), len(base) // 50)
            rows.append((10 * i + 3, " ".join(again)))
    rows += [(5000, "One two"), (5001, "one  TWO"), (5002, "one three"), (5003, None), (5004, " "), (None, rows[0][1])]
    root = {i: i for i, _ in rows}

    def find(x):
        return x if root[x] == x else find(root[x])

    plain = [(i, t) for i, t in rows if i is not None and (t or "").strip()]
    pairs = [(i, j) for (i, a), (j, b) in itertools.combinations(plain, 2) if brute_jaccard(a, b) >= 0.8]
    for i, j in [*pairs, (5003, 5004)]:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    want = {i for i, _ in rows if i is not None and find(i) == i}  # the null id's text is that of another
    by_simhash = {r["doc_id"] for r in simhash.keep_one(docs(rows)).collect()}
    assert len(by_simhash - want) > 20
    assert {r["doc_id"] for r in simhash.keep_one(docs(rows), 0.8).collect()} == want & by_simhash
    assert simhash.keep_one(docs(rows).limit(0), 0.8).count() == 0

    with monkeypatch.context() as m:
        m.setattr(jaccard, "BLOCK", 1000)
        m.setattr(jaccard, "SPREAD", 2)
        assert {r["doc_id"] for r in simhash.keep_one(docs(rows), 0.8).collect()} == want & by_simhash


def test_members_that_their_leader_does_not_link_meet(docs, monkeypatch):
    """A chain of texts in which neighbours alone are alike, in buckets that any two may share."""
    monkeypatch.setattr(jaccard, "band_keys", lambda found: np.arange(jaccard.BANDS, dtype=np.int64))
    monkeypatch.setattr(jaccard, "BLOCK", 500)
    rng = random.Random(26)
    words = text(rng, 900, [f"w{i}" for i in range(5000)]).split()
    rows = [(i, " ".join(words[30 * i : 30 * i + 300])) for i in rng.sample(range(20), 20)] + [(100 + i, text(rng, 200)) for i in range(10)] + [(50, " ".join(words[:300]))]
    d = docs(rows)
    got = jaccard.components(jaccard.links(d, F.col("doc_id"), 0.8)).collect()
    assert sorted((r["node"], r["root"]) for r in got) == sorted([(i, 0) for i in range(20)] + [(50, 0)])


def test_buckets_come_in_pieces():
    """In one process: links within runs of equal keys, whatever pieces the rows come in."""
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 9, 300))
    fps = rng.integers(0, 1 << 9, 300)
    cuts = [0, 7, 8, 30, 31, 150, 300]
    batches = ((np.stack([np.zeros(b - a, np.int64), keys[a:b]], axis=1), fps[a:b]) for a, b in itertools.pairwise(cuts))
    got = [x for found in simhash.linked(batches) for x in found]

    def classes(pairs):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[find(a)] = find(b)
        return {frozenset(y for y in root if find(y) == find(x)) for x in root}

    want = [(a, b) for k in range(9) for a, b in itertools.combinations(fps[keys == k].tolist(), 2) if (a ^ b).bit_count() <= 3 and a != b]
    assert classes([(a, b) for a, b in got if a != b]) == classes(want)


@pytest.mark.parametrize("bucket", [8, 4096])
def test_large_buckets_are_dealt_again(spark, monkeypatch, bucket):
    """All pairs in the radius are in one component, with buckets that are dealt by finer masks and a hub among them."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(5)
    fps = {rng.getrandbits(20) | 0x5555 << 40 for _ in range(150)} | {0x1234 ^ (1 << i) for i in range(60)} | {0x1234}
    df = spark.createDataFrame([(f,) for f in sorted(fps)], "fp bigint")
    got = {r["node"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(fps), 2):
        if (a ^ b).bit_count() <= 3:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert {f: got.get(f, f) for f in fps} == {f: find(f) for f in fps}


def test_store_round_trip(docs):
    rows = corpus(6)
    enc = direct("byte_bpe_50k.json")
    s = store.write_store(docs(rows), tokenizer_file("byte_bpe_50k.json"))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    got = {}
    for r in store.read_documents(s).collect():
        got[r["start"]] = (r["doc_id"], r["ids"])
    flat = [got[k] for k in sorted(got)]
    assert [i for i, _ in flat] == [i for i, _ in order] and sorted((repr(i), tuple(x)) for i, x in flat) == sorted((repr(i), tuple(enc(t))) for i, t in order)
    digest = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in store.document_digests(s).collect())
    assert digest == [(k, got[k][0], len(got[k][1]), crc(got[k][1])) for k in sorted(got)]
    assert s.chunks.count() == s.chunks.select("hash").distinct().count()
    assert s.manifest.agg(F.sum("documents"), F.sum("ids")).first() == (len(rows), sum(len(enc(t)) for _, t in rows))
    assert store.document_digests(store.write_store(docs(rows).limit(0), tokenizer_file("byte_bpe_50k.json"))).count() == 0


def test_damaged_chunks_are_noticed(spark, docs):
    s = store.write_store(docs([(1, "some words here")]), tokenizer_file("byte_bpe_50k.json"))
    bad = s.chunks.withColumn("payload", F.unhex(F.lit("0000")))
    broken = type("Broken", (store.Store,), {"chunks": property(lambda self: bad)})(spark, s.path)
    with pytest.raises(Exception, match="damaged"):
        store.document_digests(broken).collect()


def test_lost_recipes_and_chunks_are_noticed(spark, docs):
    s = store.write_store(docs([(i, f"some words here {i}") for i in range(9)]), tokenizer_file("byte_bpe_50k.json"))
    fewer = s.recipes.filter("doc_id <> 4")
    none = s.chunks.filter(F.col("hash") != s.chunks.orderBy("hash").first()["hash"])
    damaged = s.chunks.withColumn("payload", F.unhex(F.lit("0000")))
    for part, frame, says in (("recipes", fewer, "manifest"), ("recipes", fewer.limit(0), "manifest"), ("chunks", none, "missing"), ("chunks", damaged, "damaged")):
        broken = type("Broken", (store.Store,), {part: property(lambda self, frame=frame: frame)})(spark, s.path)
        for read in (store.read_documents, store.document_digests):
            with pytest.raises(Exception, match=says):
                read(broken).collect()


def test_chunks_fall_into_step():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 50_000, 30_000).astype(np.uint32)
    b = np.concatenate([rng.integers(0, 50_000, 777).astype(np.uint32), a])
    ends = lambda x: store.chunk_ends(len(x), store.marks(x).tolist())
    cut = lambda x: {x[i:j].tobytes() for i, j in itertools.pairwise([0, *ends(x)])}
    assert len(cut(a) & cut(b)) >= len(cut(a)) - 3
    assert all(n <= store.LONGEST for n in np.diff([0, *ends(a)]))


def test_toxicity_learns_without_held_out_labels(spark, docs):
    rng = random.Random(14)
    bad = ["vilex", "grubon", "skarn"]
    rows = [(i, text(rng, 40) + (" " + rng.choice(bad) if i % 5 == 0 else "")) for i in range(900)] + [(5000 + i, t) for i, t in enumerate(ODD)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0) if zlib.crc32(str(i).encode()) % 4 != 2 else 1) for i in range(0, 900, 2)] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs(rows), labels)
    got = {r["doc_id"]: r for r in toxicity.score(docs(rows), model).collect()}
    held = [i for i in range(900) if got[i]["held_out"]]
    assert held == [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i]["predicted"] == (i % 5 == 0) for i in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs(rows), model).collect()}
    assert kept == {i for i, r in got.items() if not r["predicted"]}
    none = toxicity.fit(docs(rows), labels.limit(0))
    assert toxicity.score(docs(rows), none).filter("predicted = 1").count() == 0


def test_non_negative_risk_recovers_the_positives():
    rng = np.random.default_rng(7)
    x_p = np.column_stack([np.ones(200), rng.integers(0, 2, 200)]).astype(np.float32)
    x_u = np.column_stack([np.r_[np.ones(100), np.zeros(900)], rng.integers(0, 2, 1000)]).astype(np.float32)
    w, b = toxicity.train(x_p, x_u, 0.1)
    p = lambda x: 1 / (1 + np.exp(-(x @ w + b)))
    assert p(np.array([1.0, 0.0])) > 0.5 > 0.3 > p(np.array([0.0, 1.0]))


def test_gradient_is_that_of_the_risk():
    """Against differences of a risk computed one document at a time; below zero it points back."""
    rng = np.random.default_rng(8)

    def risk(x_p, x_u, w, b, prior):
        loss = lambda x, y: math.log1p(math.exp(-y * (sum(a * c for a, c in zip(x, w, strict=True)) + b)))
        negative = sum(loss(x, -1) for x in x_u) / len(x_u) - prior * sum(loss(x, -1) for x in x_p) / len(x_p)
        return prior * sum(loss(x, 1) for x in x_p) / len(x_p), negative

    below = set()
    for case in range(12):
        x_p, x_u = rng.integers(0, 2, (9, 4)).astype(np.float64), rng.integers(0, 2, (15, 4)).astype(np.float64)
        if case % 2:
            x_p[:], x_u[:, 0], w = 1, 0, np.array([6.0, 1, 1, 1])
        else:
            w = rng.normal(size=4)
        b, prior = float(rng.normal()) - 3 * (case % 2), 0.6
        by_w, by_b, *risks = toxicity.gradient(x_p, x_u, w, b, prior)
        positive, negative = risk(x_p, x_u, w, b, prior)
        under = negative < 0
        below.add(under)
        assert np.allclose(risks, (positive, negative))
        for k in range(5):
            step = np.eye(5)[k] * 1e-6
            sides = [risk(x_p, x_u, w + s * step[:4], b + s * step[4], prior) for s in (1, -1)]
            whole = [(-n if under else p + n) for p, n in sides]
            assert abs((whole[0] - whole[1]) / 2e-6 - np.append(by_w, by_b)[k]) < 1e-4
    assert below == {True, False}


def test_repeated_and_contradictory_labels(spark, docs):
    rng = random.Random(23)
    rows = [(i, text(rng, 30) + (" vilex" if i % 5 == 0 else "")) for i in range(400)]
    labels = [(i, int(i % 5 == 0)) for i in range(400)]
    schema = "doc_id bigint, toxic int"
    once = toxicity.fit(docs(rows), spark.createDataFrame(labels, schema))
    again = toxicity.fit(docs(rows), spark.createDataFrame([*labels, *labels, *((i, 0) for i in range(0, 400, 5)), (None, 1), (None, 0)], schema))
    assert once == again
    doubled = toxicity.fit(docs(rows + rows[:50] * 3), spark.createDataFrame(labels, schema))
    assert doubled.prior == once.prior and doubled.score("x vilex") > 0.5 > 0.3 > doubled.score("x")


def test_columns_with_the_names_used_inside(spark):
    """Extra columns named like those that the operators use themselves come through unchanged."""
    rng = random.Random(24)
    names = ["salt_", "n_", "before_", "nth_", "rank_", "gone_id_", "gone_key_", "key_", "places_", "row_", "ranges_", "spans_", "base_", "candidates_", "earlier_hits_", "earlier_items_", "earlier_key_", "fp", "size", "text_", "run", "lines"]
    rows = [(i, f"{text(rng, 40)}\n{text(rng, 9)}") for i in range(12)]
    df = spark.createDataFrame([*rows, rows[0], (None, None)], "doc_id bigint, text string").select("*", *(F.lit(f"own {n}").alias(n) for n in names))
    bench = spark.createDataFrame([(1, text(rng, 12))], "item_id bigint, text string")
    for run in (linedup.dedup_lines, substring.remove_repeats, simhash.keep_one, lambda d: simhash.keep_one(d, 0.8), secretscan.redact, lambda d: decontam.decontaminate(d, bench, block_words=5), lambda d: packing.pack(d.withColumn("length", F.lit(3)), 10, ("doc_id",))):
        out = run(df)
        assert set(df.columns) <= set(out.columns)
        assert out.count() >= 12 and all(r[n] == f"own {n}" for r in out.collect() for n in names)


def test_folders_of_a_cluster_must_be_shared(spark):
    class Elsewhere:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Elsewhere())
