"""Operator 2: URL filters by mined association rules, in DataFrame functions and Spark's FP-growth.

A page's url is cut into host, path and tokens (host labels, path segments with digits masked, names
of query arguments). Labelled pages give transactions of their tokens, with one more item if the
page is bad. FP-growth mines the frequent itemsets; a rule is a set of tokens of any size
whose pages are bad, pruned by support (``MIN_SUPPORT`` of the labelled pages and at least
``MIN_PAGES`` bad ones), confidence (``MIN_CONFIDENCE``) and lift (``MIN_LIFT``), all in whole numbers.

Tokens that occur in exactly the same labelled pages (as those of one url template do) are one item for the mining:
all combinations of them have the same pages, so a template of forty arguments costs as much as one token, not 2**40
itemsets. (Equal pages: equal counts and 128 bits of an order-free hash of the pages' numbers.) A mined rule then
holds for each choice of at least one token of each of its items.

Rules match by an inverted index: each is listed under its rarest item only, the distinct token
sets of all pages become sets of items and are joined to the index, and a rule found that way is checked for
its other items. Of several rules the most confident counts, then the one with most of the page's tokens, then the last
in order. Pages then join the token sets that matched, so a host with a third of all pages
costs as many index lookups as it has different token sets.

Fixed rules (host with path, allow or block) come first: a rule fits its host and all subdomains if
the path starts with the rule's; the longest wins, of equal lengths the first in order.

Cases: a null url, or one without ``://``, has empty host and path, no token and the verdict allow; without
labels (or without bad ones) no rule is mined; of several labels for one page any bad one counts;
repeated rows count and are kept each; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tankflow.llm.common import materialise

MIN_SUPPORT = 0.0005
MIN_PAGES = 5
MIN_CONFIDENCE = (1, 2)
MIN_LIFT = (3, 2)
BAD = "!bad"
FIXED_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
               ("net/es/", "block"), ("net/fr/", "block"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column, host_col: Column, path_col: Column) -> Column:
    """Sorted distinct tokens; none for a url without a host."""
    query = F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1), F.lit(""))
    some = lambda text, sep: F.filter(F.split(text, sep), lambda x: x != "")
    return F.array_sort(F.array_distinct(F.concat(
        F.transform(some(host_col, r"\."), lambda x: F.concat(F.lit("h:"), x)),
        F.transform(some(path_col, "/"), lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "#"))),
        F.transform(some(query, "&"), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1))))))


def parts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, tokens) of every page."""
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"),
                     path(F.col(url_col)).alias("path"))
    return p.select("page_id", "host", "path", tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))


def items_of(rows: DataFrame, least: int) -> DataFrame:
    """(token, item) of the tokens that ``least`` or more of ``rows`` (row, tokens) have: tokens of exactly the same rows are
    one item, named by the first of them."""
    t = rows.select("row", F.explode("tokens").alias("token"))
    same = t.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("x"),
                                  F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("y")).where(F.col("n") >= least)
    named = same.groupBy("n", "x", "y").agg(F.min("token").alias("item"))
    return materialise(same.join(named, ["n", "x", "y"]).select("token", "item"))


def mine(cut: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_pages: int = MIN_PAGES) -> tuple[DataFrame, DataFrame]:
    """(rule_id, items, pages, bad, confidence): the rules that pass, from the pages that have a label
    (a row of ``labels`` with the page's id; bad: quality 0 or toxic 1); and (token, item), which tokens an item stands for."""
    judged = (labels.groupBy(F.col("doc_id").alias("label_id"))
              .agg(F.max((F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)))
                         .cast("int")).alias("bad")))
    rows = materialise(cut.join(judged, F.col("page_id") == F.col("label_id")).where(F.size("tokens") > 0)
                       .select("bad", "tokens", F.monotonically_increasing_id().alias("row")))
    total = rows.agg(F.count("*").alias("n"), F.sum("bad").alias("bad")).first()
    if not total.bad:
        number, text = F.lit(0).cast("long"), F.lit("")
        none = cut.limit(0)
        return (none.select(number.alias("rule_id"), F.col("tokens").alias("items"), number.alias("pages"), number.alias("bad"),
                            F.lit(0.0).alias("confidence")), none.select(text.alias("token"), text.alias("item")))
    least = int(max(min_pages, -(-total.n * min_support // 1)))
    items = items_of(rows, least)
    bags = (rows.select("row", "bad", F.explode("tokens").alias("token")).join(items, "token")
            .groupBy("row", "bad").agg(F.collect_set("item").alias("items")))
    bags = materialise(bags.select(F.when(F.col("bad") == 1, F.concat("items", F.array(F.lit(BAD)))).otherwise(F.col("items")).alias("items")))
    # rows without a frequent token are in no set but count for the support
    n = bags.count()
    sets = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / max(n, 1))).fit(bags).freqItemsets
    sets = materialise(sets.select(F.array_sort(F.array_remove("items", BAD)).alias("items"), F.array_contains("items", BAD).alias("with_bad"), "freq"))
    bad = sets.where("with_bad").where(F.size("items") > 0).select("items", F.col("freq").alias("bad"))
    every = sets.where("not with_bad").select("items", F.col("freq").alias("pages"))
    p, q = MIN_CONFIDENCE
    lp, lq = MIN_LIFT
    return (bad.join(every, "items")
            .where((F.col("bad") * q >= F.col("pages") * p)
                   & (F.col("bad") * F.lit(total.n).cast("long") * lq >= F.col("pages") * F.lit(total.bad).cast("long") * lp))
            .select(F.xxhash64("items").alias("rule_id"), "items", "pages", "bad", (F.col("bad") / F.col("pages")).alias("confidence")), items)


def match(cut: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """(tokens, matched, confidence): each distinct token set that a rule matches, with its best rule's tokens."""
    rules = materialise(rules)
    often = rules.select(F.explode("items").alias("item"), "pages").groupBy("item").agg(F.count("*").alias("listed"))
    rarest = (rules.select("rule_id", F.explode("items").alias("item")).join(often, "item")
              .groupBy("rule_id").agg(F.min(F.struct("listed", "item")).alias("least"))
              .select("rule_id", F.col("least.item").alias("item")))
    index = materialise(rules.join(rarest, "rule_id").select("item", F.col("items").alias("needed"), "confidence"))
    sets = cut.where(F.size("tokens") > 0).select("tokens").distinct()
    held = (sets.select("tokens", F.explode("tokens").alias("token")).join(items, "token")
            .groupBy("tokens").agg(F.collect_list(F.struct("token", "item")).alias("pairs"), F.collect_set("item").alias("has")))
    found = (held.select("tokens", "pairs", "has", F.explode("has").alias("item")).join(index, "item")
             .where(F.size(F.array_except("needed", "has")) == 0))
    own = F.array_sort(F.transform(F.filter("pairs", lambda x: F.array_contains("needed", x["item"])), lambda x: x["token"]))
    best = F.max(F.struct("confidence", F.size(own).alias("size"), own.alias("matched"))).alias("best")
    return found.groupBy("tokens").agg(best).select("tokens", "best.matched", "best.confidence")


def fixed_rule(host_col: Column, path_col: Column, rules=FIXED_RULES) -> tuple[Column, Column]:
    """The longest fixed rule that fits, and its verdict; both null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):  # the best one comes last
        h, _, p = text.partition("/")
        fits = ((host_col == h) | host_col.endswith(f".{h}")) & path_col.startswith(f"/{p}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, labels: DataFrame, fixed=FIXED_RULES, min_support: float = MIN_SUPPORT,
          min_pages: int = MIN_PAGES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, matched, confidence) of every page."""
    cut = parts(pages, id_col, url_col)
    matched = materialise(match(cut, *mine(cut, labels, min_support, min_pages)))
    own = matched.select(F.col("tokens").alias("of"), "matched", "confidence")
    rule, says = fixed_rule(F.col("host"), F.col("path"), fixed)
    return (cut.join(own, F.col("tokens") == F.col("of"), "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(says, F.when(F.col("matched").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                    F.array_join("matched", " ").alias("matched"), "confidence"))
