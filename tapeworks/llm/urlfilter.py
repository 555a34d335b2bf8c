"""URL filter: rules first, then a tree of path templates for each host.

A page that a rule fits gets the rule's verdict and labels its templates. Each host's tree
grows to the paths' ends wherever labels still differ: a node is cut where its paths part, segments that vary too much
become one wildcard, branches whose labels don't differ from their node's are merged, and so are those that differ
alike to the same side. What no rule fits is judged by
the share of blocked pages in its template, each node smoothed towards its parent, the host
towards the same path on all hosts, and that towards the whole table.
All of it is aggregation over distinct paths; no group's pages are gathered. A round takes all nodes one parting further down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import ascii_lower, cut, join_groups

#: Verdict, host, path. A rule fits its host and all subdomains if the path starts with the rule's.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))

#: A level is variable if it has more kinds of segment than KINDS and than this share of its pages.
KINDS, KINDS_SHARE = 20, 0.2
#: Branches are alike below this squared deviation from their siblings (about one in ten by chance).
ALIKE = 2.7
#: Labelled pages that a parent's share weighs as much as, and the share from which a template is rejected.
PRIOR, REJECT = 4.0, 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host (A-Z lower-cased) up to / ? # or the end, then the path up to ? # or the end. Null or no ``://``: both empty."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.when(F.substr(rest, F.length(host) + 1, F.lit(1)) == "/", F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)).otherwise(F.lit(""))
    return ascii_lower(host), path


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text and verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decides, at, under in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(under)
        rule = F.when(fits, F.lit(at + under)).otherwise(rule)
        verdict = F.when(fits, F.lit(decides)).otherwise(verdict)
    return rule, verdict


def shape(path: Column) -> Column:
    """The path with numbers and hexadecimal names as wildcards; signs that templates use are escaped."""

    def general(s: Column) -> Column:
        for sign, code in (("{", "%7B"), ("*", "%2A"), ("$", "%24")):
            s = F.replace(s, F.lit(sign), F.lit(code))
        s = F.regexp_replace(s, r"^[0-9]+(\.[A-Za-z0-9]+)?$", "{n}$1")
        return F.regexp_replace(s, r"^(?=[a-f-]*[0-9])[0-9a-f-]{8,}$", "{h}")

    return F.array_join(F.transform(F.split(path, "/", -1), general), "/")


_COUNTS = ("pages", "labelled", "blocked")
_NODE = ["host", "node"]


def _sums(*more: Column) -> list[Column]:
    return [*(F.sum(c).alias(f"all_{c}") for c in _COUNTS), *more]


def _smoothed(blocked: Column, labelled: Column, towards: Column) -> Column:
    return (blocked + PRIOR * towards) / (labelled + PRIOR)


def _off() -> Column:
    return F.col("blocked") - F.col("labelled") * F.col("all_blocked") / F.nullif(F.col("all_labelled"), F.lit(0))


def _alike() -> Column:
    """A branch's labels don't differ from the share among all of its group."""
    share = F.col("all_blocked") / F.nullif(F.col("all_labelled"), F.lit(0))
    return (F.col("labelled") == 0) | (_off() * _off() <= ALIKE * F.col("labelled") * share * (1 - share))


def _branches(tree: DataFrame, total: int) -> DataFrame:
    """host, node, child, paths and the child's name in the tree: its own, or that of the branch it is merged into. ``total``: no fewer than the children."""
    children = cut(tree.groupBy(*_NODE, "child").agg(*(F.sum(c).alias(c) for c in _COUNTS), F.count("*").alias("paths")))
    parents = children.groupBy(*_NODE).agg(*_sums(F.count("*").alias("kinds")))
    both = join_groups(children, parents, _NODE, "kinds", total)
    variable = (F.col("kinds") > KINDS) & (F.col("kinds") > KINDS_SHARE * F.col("all_pages"))
    side = F.when(variable | _alike(), F.lit("*")).when(_off() > 0, F.lit("{more}")).otherwise(F.lit("{less}"))
    sided = cut(both.select(*_NODE, "child", *_COUNTS, "paths", side.alias("side")))
    sides = sided.filter("side <> '*'").groupBy(*_NODE, "side").agg(*_sums(F.count("*").alias("kinds")))
    apart = join_groups(sided.filter("side <> '*'"), sides, [*_NODE, "side"], "kinds", total)
    name = F.when((F.col("kinds") > 1) & _alike(), F.col("side")).otherwise(F.when(F.col("child") == "/", F.lit("$")).otherwise(F.col("child")))
    merged = sided.filter("side = '*'").select(*_NODE, "child", "paths", F.col("side").alias("name"))
    return merged.unionByName(apart.select(*_NODE, "child", "paths", name.alias("name")))


def templates(pages: DataFrame) -> DataFrame:
    """host, shape (of the path), pages, template and purity, one row per host and shape. ``pages``: host, shape, label (1 block, 0 allow or null).

    A subtree whose labels are all alike, or that has none, isn't split further: ``/**``.
    """
    known = cut(pages.groupBy("host", "shape").agg(F.count("*").alias("pages"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("blocked")))
    whole = known.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l")).first()
    base = (whole["b"] + 0.5 * PRIOR) / (whole["l"] + PRIOR) if whole["l"] else 0.0
    anywhere = cut(known.groupBy("shape").agg(F.count("*").alias("hosts"), F.sum("blocked").alias("b_"), F.sum("labelled").alias("l_")))
    purity = _smoothed(F.col("b_"), F.col("l_"), F.lit(base))
    rest = F.when(F.col("shape") == "", F.array().cast("array<string>")).otherwise(F.split(F.substr("shape", F.lit(2)), "/", -1))
    started = join_groups(known, anywhere, ["shape"], "hosts", known.count()).withColumn("purity", purity)
    tree = cut(started.select("host", "shape", *_COUNTS, "purity", F.lit("").alias("node"), rest.alias("rest")))
    done = None
    while left := tree.count():
        nodes = cut(tree.groupBy(*_NODE).agg(*_sums(F.count("*").alias("paths"), F.min("rest").alias("low"), F.max("rest").alias("high"))))
        both = join_groups(tree, nodes, _NODE, "paths", left).withColumn("purity", _smoothed(F.col("all_blocked"), F.col("all_labelled"), F.col("purity")))
        # What the first and the last path in order share, all paths between them share.
        parts = F.array_position(F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b)), False).cast("int")
        mixed = (F.col("all_blocked") > 0) & (F.col("all_blocked") < F.col("all_labelled"))
        stepped = cut(both.withColumn("at", F.when(mixed, parts).otherwise(0)).withColumn("alone", F.col("low") == F.col("high")).drop("low", "high", "paths", *(f"all_{c}" for c in _COUNTS)))
        whole_rest = F.when(F.size("rest") > 0, F.concat(F.lit("/"), F.array_join("rest", "/"))).otherwise(F.lit(""))
        ended = stepped.filter("at = 0").select("host", "shape", "pages", F.concat("node", F.when(F.col("alone"), whole_rest).otherwise(F.lit("/**"))).alias("template"), "purity")
        done = ended if done is None else done.unionByName(ended)
        open_ones = stepped.filter("at > 0").withColumn("child", F.coalesce(F.get("rest", F.col("at") - 1), F.lit("/")))
        going = open_ones.withColumn("shared", F.when(F.col("at") > 1, F.concat(F.lit("/"), F.array_join(F.slice("rest", F.lit(1), F.col("at") - 1), "/"))).otherwise(F.lit("")))
        named = cut(_branches(going, left))
        joined = join_groups(going, named, [*_NODE, "child"], "paths", left)
        further = F.slice("rest", F.least(F.col("at") + 1, F.size("rest") + 1), F.greatest(F.size("rest") - F.col("at"), F.lit(0)))
        tree = cut(joined.select("host", "shape", *_COUNTS, "purity", F.concat("node", "shared", F.lit("/"), "name").alias("node"), further.alias("rest")))
    return known.select("host", "shape", "pages", F.lit("").alias("template"), F.lit(base).alias("purity")) if done is None else done


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity (share of blocked pages) for each row of ``pages`` (page_id, url).

    Null urls and urls without ``://`` have an empty host and path and are judged like any other.
    Repeated rows are judged each for itself; with no labelled page at all what no rule fits is allowed.
    """
    host, path = host_and_path(F.col("url"))
    read = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, decided = rule_for(F.col("host"), F.col("path"), rules)
    read = read.select("*", rule.alias("rule"), decided.alias("decided"), shape(F.col("path")).alias("shape"))
    read = cut(read.withColumn("label", F.when(F.col("decided") == "block", 1).when(F.col("decided") == "allow", 0).cast("int")))
    joined = join_groups(read, cut(templates(read)), ["host", "shape"], "pages", read.count())
    verdict = F.coalesce("decided", F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow")))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", F.round("purity", 9).alias("purity"))
