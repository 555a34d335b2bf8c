"""Secret scan with DataFrame functions only.

Three base patterns give spans by themselves. The method adds spans: strings of letters
and digits or of mixed case are tested for randomness (chi-squared uniformity over the alphabet
of their inferred encoding, a runs test, lag-one serial correlation). Strings of words
or counters fail these tests. Within each encoding and length class, what fails is
found with the false-discovery rate held (Benjamini-Hochberg on binned p-values of all
documents); the rest counts as random, that is, as secrets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import cut, fresh

# The base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: A string that may be random: a whole run of 20 or more of these characters, with a digit in it or with a capital
#: after a small letter three times. Shorter ones, and ones of small or of capital letters alone, look like words to the tests.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*(?:[0-9]|(?:[a-z][+/_=-]*[A-Z][A-Za-z+/_=-]*?){3}))[A-Za-z0-9+/_=-]{20,}"

#: Encodings, the first that fits counts: name, what a string must match, alphabet.
ENCODINGS = [
    ("decimal", "^[0-9]+$", "0123456789"),
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("base32", "^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base64", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
]
#: The rate of random strings that may be taken for words.
FALSE_DISCOVERY = 0.05
#: P-values fall into bins of a twentieth of a power of ten, 200 at most; lengths into doubling classes.
BINS, BINS_A_DECADE = 200, 20

#: Matches whose places are summed up together.
BLOCK = 256

_NOTHING = "array<struct<start:int,kind:int,end:int,text:string>>"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _by_blocks(items: Column, total, add, within) -> Column:
    """The arrays ``within(block, value before it)`` of blocks of BLOCK items, in one; values are carried by ``add(value, total(block))`` from 0 on."""

    def block(k: Column) -> Column:
        return F.slice(items, k * BLOCK + 1, F.lit(BLOCK))

    blocks = F.sequence(F.lit(0), F.floor((F.greatest(F.size(items), F.lit(1)) - 1) / BLOCK).cast("int"))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    carried = F.aggregate(F.transform(blocks, lambda k: total(block(k))), nothing, lambda acc, n: F.struct(add(acc["at"], F.coalesce(n, F.lit(0))).cast("int").alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")), lambda acc: acc["all"])
    return F.flatten(F.zip_with(blocks, carried, lambda k, at: within(block(k), at)))


def _running_max(ends: Column) -> Column:
    def within(some: Column, at: Column) -> Column:
        nothing = F.struct(at.alias("at"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(some, nothing, lambda acc, e: F.struct(F.greatest(acc["at"], e).alias("at"), F.concat(acc["all"], F.array(F.greatest(acc["at"], e))).alias("all")), lambda acc: acc["all"])

    return _by_blocks(ends, F.array_max, F.greatest, within)


def _spans(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """Leftmost matches that don't overlap: start, kind, end (code points), text of ``group``.

    The pieces between the matches and the matches' own lengths add up to the places; sums are carried within blocks of
    BLOCK matches and from block to block, so a text with very many takes no quadratic time.
    """
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    each = F.arrays_zip(whole.alias("w"), part.alias("p"), F.slice(between, F.lit(1), F.size(whole)).alias("b"))

    def step(acc: Column, m: Column) -> Column:
        begin = (acc["at"] + m["b"]).cast("int")
        end = (begin + F.length(m["w"])).cast("int")
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), m["p"].alias("text"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def total(matches: Column) -> Column:
        return F.aggregate(matches, F.lit(0), lambda acc, m: (acc + m["b"] + F.length(m["w"])).cast("int"))

    def within(matches: Column, at: Column) -> Column:
        return F.aggregate(matches, F.struct(at.alias("at"), F.array().cast(_NOTHING).alias("spans")), step, lambda acc: acc["spans"])

    return _bound(each, lambda matches: _by_blocks(matches, total, lambda a, b: a + b, within))


def _if(condition: Column, spans: Column) -> Column:
    return F.when(condition, spans).otherwise(F.array().cast(_NOTHING))


def _battery(raw: Column) -> Column:
    """Struct of encoding, cell and bin of p of a candidate: how likely a random string deviates as much. Linear in its length."""
    which = F.lit(len(ENCODINGS) - 1)
    for i, (_, must, _) in reversed(list(enumerate(ENCODINGS[:-1]))):
        which = F.when(raw.rlike(must), F.lit(i)).otherwise(which)
    s = F.translate(F.translate(raw, "=", ""), "-_", "+/")
    s = F.when(which == 1, F.lower(s)).otherwise(s)
    alphabet = F.element_at(F.array(*(F.lit(a) for _, _, a in ENCODINGS)), which + 1)
    made = F.struct(which.alias("encoding"), s.alias("s"), alphabet.alias("alphabet"), F.length(s).alias("n"), F.length(alphabet).cast("double").alias("size"))

    def sums(m: Column) -> Column:
        """One pass over the symbols' places in the alphabet: sums for the serial correlation, how many are high, how often that changes."""
        v = F.transform(F.split(m["s"], "", -1), lambda c: F.call_function("instr", m["alphabet"], c).cast("double"))
        half = m["size"] / 2

        def step(acc: Column, y: Column) -> Column:
            high = (y > half).cast("double")
            return F.struct(
                y.alias("last"), high.alias("was"), (acc["sum"] + y).alias("sum"), (acc["square"] + y * y).alias("square"),
                (acc["lagged"] + acc["last"] * y).alias("lagged"), (acc["high"] + high).alias("high"), (acc["changes"] + F.abs(high - acc["was"])).alias("changes"),
                F.when(acc["first"] == 0, y).otherwise(acc["first"]).alias("first"),
            )

        # Places are from 1 on, so 0 stands for no symbol yet; the first change, from 0, is taken off again.
        start = F.struct(*(F.lit(0.0).alias(x) for x in ("last", "was", "sum", "square", "lagged", "high", "changes", "first")))
        return F.struct(m.alias("m"), F.aggregate(v, start, step).alias("t"))

    def tests(x: Column) -> Column:
        m, t = x["m"], x["t"]
        n = m["n"].cast("double")
        symbols = F.sequence(F.lit(1), m["size"].cast("int"))
        squares = F.aggregate(symbols, F.lit(0.0), lambda acc, k: acc + F.pow(m["n"] - F.length(F.replace(m["s"], F.substr(m["alphabet"], k, F.lit(1)), F.lit(""))), F.lit(2.0)))
        chi = m["size"] / n * squares - n
        z_chi = (chi - (m["size"] - 1)) / F.sqrt(2 * (m["size"] - 1) * (n - 1) / n)
        high, runs = t["high"], 1 + t["changes"] - (t["first"] > m["size"] / 2).cast("double")
        expected = 2 * high * (n - high) / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        z_runs = F.when(spread > 0, (runs - expected) / F.sqrt(F.abs(spread))).otherwise(F.sqrt(n))
        mean = t["sum"] / n
        power = t["square"] - t["sum"] * mean
        product = t["lagged"] - mean * (2 * t["sum"] - t["first"] - t["last"]) + (n - 1) * mean * mean
        z_serial = F.when(n * t["square"] > t["sum"] * t["sum"], product / F.when(power != 0, power) * F.sqrt(n)).otherwise(F.sqrt(n))
        return F.struct(m.alias("m"), (F.pow(F.greatest(z_chi, F.lit(0.0)), F.lit(2.0)) + z_runs * z_runs + z_serial * z_serial).alias("total"))

    def judged(x: Column) -> Column:
        m, total = x["m"], x["total"]
        # About chi-squared with three degrees; its cube root is about normal, whose tail is about logistic.
        z = (F.pow(total / 3, F.lit(1 / 3)) - (1 - 2 / 27)) / (2 / 27) ** 0.5
        log10_p = -F.log10(1 + F.exp(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(690.0))))
        size_class = F.least(F.floor(F.log2(m["n"].cast("double"))), F.lit(12))
        return F.struct(m["encoding"].alias("encoding"), (m["encoding"] * 16 + size_class).cast("int").alias("cell"), F.least(F.floor(-log10_p * BINS_A_DECADE), F.lit(BINS)).cast("int").alias("bin"))

    return _bound(made, lambda m: _bound(sums(m), lambda x: _bound(tests(x), judged)))


def scan(docs: DataFrame, *keep: str, base_name: str = "base", tested_name: str = "candidates") -> DataFrame:
    """The columns ``keep``, base (spans of the three patterns) and candidates with their test results; null texts are empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    assign = F.filter(_if(text.rlike("(?i)passw|secret|token|api_?key"), _spans(text, ASSIGN, 0, 1)), lambda s: F.length(s["text"]) >= LEAST["assign"])
    access = F.filter(_if(text.contains("AKIA"), _spans(text, ACCESS, 1)), lambda s: F.length(s["text"]) >= LEAST["access"])
    # A run of hex digits that is long enough, found only where the run begins.
    long_hex = f"(?<![0-9a-f])[0-9a-f]{{{LEAST['hex']},}}"
    hexes = _if(text.rlike(long_hex), _spans(text, long_hex, 2))
    random = _if(text.rlike(CANDIDATE), _spans(text, CANDIDATE, 3))
    base = F.array_sort(F.concat(*(F.transform(x, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))) for x in (assign, access, hexes))))
    tested = F.transform(random, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), _battery(s["text"]).alias("test")))
    return docs.select(*keep, base.alias(base_name), tested.alias(tested_name))


def thresholds(scanned: DataFrame, rate: float = FALSE_DISCOVERY, tested: str = "candidates") -> dict[int, int]:
    """For each encoding and length class: the least bin of p-values (from 1 downwards) whose strings aren't random.

    Benjamini-Hochberg: the largest p with p <= rate * (strings at or below p) / strings. The counts are of all documents, in at most a few thousand cells.
    """
    cells: dict[int, dict[int, int]] = {}
    for r in scanned.select(F.explode(f"{tested}.test").alias("t")).groupBy("t.cell", "t.bin").count().collect():
        cells.setdefault(r["cell"], {})[r["bin"]] = r["count"]
    found = {}
    for cell, bins in cells.items():
        total, below, least = sum(bins.values()), 0, BINS + 1
        for b in sorted(bins, reverse=True):
            below += bins[b]
            if 10 ** (-b / BINS_A_DECADE) <= rate * below / total:
                least = b
        found[cell] = least
    return found


def _all_spans(base: str, tested: str, least: dict[int, int]) -> Column:
    """Base spans and those of random strings that touch none, in order; ``least``: see ``thresholds``."""
    random = F.col(tested)
    if least:
        limit = F.create_map(*(F.lit(x) for pair in sorted(least.items()) for x in pair))
        random = F.filter(random, lambda s: s["test"]["bin"] < limit[s["test"]["cell"]])
    apart = F.filter(random, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    added = F.transform(apart, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.array_sort(F.concat(base, added))


def secrets(docs: DataFrame, rate: float = FALSE_DISCOVERY) -> DataFrame:
    """doc_id and its spans (array of start, kind, end in order): kinds 0 assign, 1 access, 2 hex, 3 random.

    A random string that touches a base span adds none. Texts without spans have empty arrays;
    null and empty texts are such; repeated rows are scanned each for itself.
    """
    scanned = cut(scan(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id"))
    return scanned.select("doc_id", "base", _all_spans("base", "candidates", thresholds(scanned, rate)).alias("spans"))


KINDS = ("assign", "access", "hex", "random")


def named(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by ``mask``, whatever the row's doc_id; other columns, and null texts, stay."""
    base, tested, spans = (fresh(c, docs.columns) for c in ("base_", "candidates_", "spans_"))
    scanned = cut(scan(docs, *docs.columns, base_name=base, tested_name=tested))
    found = scanned.withColumn(spans, _all_spans(base, tested, thresholds(scanned, tested=tested)))
    text = F.col("text")

    def cleaned(found: Column) -> Column:
        # What lies before each span and after the last; spans that overlap are masked as one.
        starts = F.concat(F.transform(found, lambda s: s["start"]), F.array(F.length(text)))
        reach = F.concat(F.array(F.lit(0)), _running_max(F.transform(found, lambda s: s["end"])))
        pieces = F.zip_with(reach, starts, lambda e, s: F.when(s >= e, F.substr(text, e + 1, s - e)))
        return F.array_join(F.filter(pieces, lambda p: p.isNotNull()), mask)

    masked = F.when(F.size(spans) > 0, _bound(F.col(spans), cleaned)).otherwise(text)
    return found.select(*(masked.alias(c) if c == "text" else F.col(c) for c in docs.columns))
