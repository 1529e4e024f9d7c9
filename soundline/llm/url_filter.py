"""URL filters: explicit host and path rules first, then association rules that FP-growth mines from labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label:block"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null and for urls without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def _hosts(host: Column) -> Column:
    """The host and all domains above it."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))


def _rules(rules: list[tuple[str, str]]) -> list[tuple[str, int, str, str, str]]:
    """(host, size, rule, action, path) of rules (text, action): a rule's path is what follows from its first slash on."""
    cut = ((text, action, *text.partition("/")) for text, action in rules)
    return [(h.lower(), len(text), text, action, slash + p) for text, action, h, slash, p in cut]


_FOUND = "struct<size: int, rule: string, action: string>"


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(size, rule, action) of the longest of rules (text, action) that fits, or null.

    A rule is its host, then its path from the first slash on. It fits its host and all subdomains, where the url's
    path starts with its own. Rules are looked up by host suffix in a map in the plan.
    """
    by: dict[str, list] = {}
    for h, *rest in _rules(rules):
        by.setdefault(h, []).append(rest)
    if not by:
        return F.lit(None).cast(_FOUND)
    one = lambda r: F.struct(*(F.lit(x).alias(k) for x, k in zip(r, ("size", "rule", "action", "path"), strict=True)))
    index = F.create_map(*(x for h, rs in by.items() for x in (F.lit(h), F.array(*map(one, rs)))))
    near = F.flatten(F.filter(F.transform(_hosts(host), lambda s: F.try_element_at(index, s)), lambda x: x.isNotNull()))
    return F.array_max(F.transform(F.filter(near, lambda r: path.startswith(r["path"])), lambda r: F.struct(r["size"].alias("size"), r["rule"].alias("rule"), r["action"].alias("action"))))


def rules_joined(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """pages(host, path, ...) with _rule as rule_for has it, by a join of host suffixes: for rules too many for a plan."""
    table = pages.sparkSession.createDataFrame(_rules(rules), "_h string, size int, rule string, action string, _p string")
    asked = pages.select("host", "path").distinct()
    hit = asked.select("host", "path", F.explode(_hosts(F.col("host"))).alias("_h")).join(table, "_h").filter(F.expr("startswith(path, _p)"))
    hit = hit.groupBy("host", "path").agg(F.max(F.struct("size", "rule", "action")).alias("_rule"))
    return pages.join(hit, ["host", "path"], "left")


def url_tokens(url: Column) -> Column:
    """Distinct tokens: scheme, labels of the host, words of the path (digits as one), names in the query, fragment."""
    host, path = parts(url)
    tag = lambda kind, xs: F.transform(F.filter(xs, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return F.array_distinct(F.concat(
        tag("scheme:", F.array(F.regexp_extract(url, r"^([A-Za-z]*)://", 1))),
        tag("host:", F.split(host, r"\.")),
        tag("path:", F.split(F.regexp_replace(F.lower(path), r"[0-9]+", "0"), r"[/._\-]+")),
        tag("query:", F.transform(F.split(query, "&"), lambda x: F.split(x, "=")[0])),
        F.when(url.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    ))


def baskets_of(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(items, bad) of the labelled pages that have tokens: labels(doc_id, quality) are those of page_id."""
    told = labels.filter(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    found = pages.select("page_id", "url").filter("url is not null").join(told, "page_id")
    return found.select(url_tokens(F.col("url")).alias("items"), "bad").filter(F.size("items") > 0)


def mine(pages: DataFrame, labels: DataFrame, support: float = 0.01, lift: float = 2.0, least: int = 5) -> DataFrame:
    """antecedent (sorted), key, confidence, lift and support of token combinations that go with low quality.

    A combination must come with the label block on the share support of the labelled pages and on least pages, and
    have that label at lift times the base rate or more. Only minimal rules stay: one whose tokens contain those of
    another adds nothing. key is the rule's token that fewest labelled pages have. Without labelled pages, or without
    any of low quality, there are no rules. Repeated rows count as pages of their own.
    """
    from pyspark.ml.fpm import FPGrowth

    spark = pages.sparkSession
    baskets = store(baskets_of(pages, labels), "baskets")
    n, bad = baskets.agg(F.count("*"), F.count_if("bad")).first()
    if not bad:
        return spark.createDataFrame([], "antecedent array<string>, key string, confidence double, lift double, support double")
    items = baskets.select(F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=max(support, 1 / n), minConfidence=min(1.0, lift * bad / n)).fit(items)
    found = model.associationRules.filter(F.expr(f"consequent = array('{BAD}')")).filter(F.round(F.col("support") * n) >= least)
    found = store(found.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "lift", "support"), "rules")
    parts = "transform(sequence(1, cast(pow(2, size(antecedent)) as int) - 2), m -> filter(antecedent, (t, i) -> (shiftright(m, i) & 1) = 1))"
    less = found.filter("size(antecedent) > 1").select(F.col("antecedent").alias("whole"), F.explode(F.expr(parts)).alias("antecedent")).join(found.select("antecedent"), "antecedent", "left_semi")
    found = found.join(less.select(F.col("whole").alias("antecedent")).distinct(), "antecedent", "left_anti")
    often = baskets.select(F.explode("items").alias("token")).groupBy("token").count()
    key = found.select("antecedent", F.explode("antecedent").alias("token")).join(often, "token").groupBy("antecedent").agg(F.min(F.struct("count", "token")).alias("key"))
    return found.join(key, "antecedent").select("antecedent", F.col("key.token").alias("key"), "confidence", "lift", "support")


def index_of(rules: DataFrame, most: int = 5000) -> dict[str, list[list[str]]] | None:
    """Rules by their key, or None where there are more than most."""
    rows = rules.select("antecedent", "key").limit(most + 1).collect()
    if len(rows) > most:
        return None
    index: dict[str, list[list[str]]] = {}
    for tokens, key in sorted((sorted(r["antecedent"]), r["key"]) for r in rows):
        index.setdefault(key, []).append(tokens)
    return index


def judge(pages: DataFrame, rules: list[tuple[str, str]], mined: DataFrame, most: int = 5000) -> DataFrame:
    """pages with host, path, rule and verdict (allow or block), which replace input columns of these names.

    The longest explicit rule decides; else a url that holds all tokens of a mined rule is blocked. Null and empty
    urls, and those without ://, have neither and are allowed. Urls of any length are read whole, repeated rows are
    judged alike and all stay, an empty table stays empty. Up to most rules of either kind are looked up in a map in
    the plan; more are joined, explicit ones by host suffix and mined ones by their key.
    """
    host, path = parts(F.col("url"))
    old = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "_tokens", "_bad", "_rule")]
    out = pages.select(*(F.col(f"`{c}`") for c in old), host.alias("host"), path.alias("path"), F.coalesce(url_tokens(F.col("url")), F.array().cast("array<string>")).alias("_tokens"))
    index = index_of(mined, most)
    if index is None:
        asked = out.select("_tokens").distinct()
        hit = asked.select("_tokens", F.explode("_tokens").alias("key")).join(mined.select("antecedent", "key"), "key").filter(F.size(F.array_except("antecedent", "_tokens")) == 0)
        out = out.join(hit.select("_tokens").distinct().withColumn("_bad", F.lit(True)), "_tokens", "left")
    elif index:
        table = F.create_map(*(x for t, sets in index.items() for x in (F.lit(t), F.array(*(F.array(*map(F.lit, s)) for s in sets)))))
        bad = F.exists("_tokens", lambda t: F.coalesce(F.exists(F.try_element_at(table, t), lambda s: F.size(F.array_except(s, F.col("_tokens"))) == 0), F.lit(False)))
        out = out.withColumn("_bad", bad)
    else:
        out = out.withColumn("_bad", F.lit(False))
    out = rules_joined(out, rules) if len(rules) > most else out.withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("_rule.action"), F.when(F.col("_bad"), "block").otherwise("allow"))
    return out.select(*(F.col(f"`{c}`") for c in old), "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"))


RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's url under RULES and the rules mined from labels.quality."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, RULES, mine(pages, spark.read.parquet(f"{sf_dir}/labels.parquet")))
