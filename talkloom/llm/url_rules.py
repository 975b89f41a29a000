"""URL filters: explicit host and path rules first, association rules mined by FP-growth for the rest.

URLs become sets of tokens. FP-growth over the blocked ones of the labelled URLs gives token sets; each is counted in all
labelled URLs, and rules "tokens -> block" are pruned by support (never under a count of rows, however few are labelled),
by the lower bound of their confidence, and to those that no shorter rule of at least that bound implies. Sets that are too long
for FP-growth, or of URLs with too many tokens for it, are found token by token from those that can still become better rules.
Rules match by an inverted index: each stands under its rarest token and is verified on the URL's set.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.common import cut

#: Production parameters: (verdict, host, path) and the limits on mined rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: A rule holds in this part of the labelled URLs at least, and in so many blocked ones.
SUPPORT = 0.002
LEAST_ROWS = 5
#: Least lower bound of the confidence (Wilson's, at Z standard errors).
CONFIDENCE = 0.7
Z = 1.64
#: What FP-growth is given: tokens in a set, and tokens of a URL, those of the highest bound by themselves. They bound what one
#: URL of very many parameters can give to 2**MINED sets. longer() finds the rest, so that they leave no rule out.
LONGEST = 4
MINED = 10


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null and where there is no ://."""
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(rest, "(?s)^[^/?#]*", 0)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or # or the end; empty for null and where there is no ://."""
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3))
    return F.coalesce(F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, null if none does. Of rules of one length the first by name wins."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    out = None
    for verdict, h, p in longest_first:
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        found = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def tokens_of(url: Column) -> Column:
    """The set of a URL's tokens: host, its labels, path words without digits, query keys and values, fragment."""
    host, path = host_of(url), path_of(url)
    words = F.filter(F.split(F.lower(path), "[/._-]+"), lambda x: (x != "") & ~x.rlike("[0-9]"))
    query = F.filter(F.split(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)), "&"), lambda x: x != "")
    fragment = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "#(.*)$", 1))
    parts = F.concat(
        F.array(F.concat(F.lit("host="), host)),
        F.transform(F.filter(F.split(host, "[.]"), lambda x: x != ""), lambda x: F.concat(F.lit("h="), x)),
        F.transform(words, lambda x: F.concat(F.lit("p="), x)),
        F.transform(query, lambda x: F.concat(F.lit("q="), x)),
        F.when(fragment != "", F.array(F.concat(F.lit("f="), fragment))).otherwise(F.array().cast("array<string>")),
    )
    return F.array_distinct(parts)


def lower_bound(hits: Column, n: Column, z: float = Z) -> Column:
    """Wilson's lower bound of the share hits / n."""
    share, z2 = hits / n, z * z
    return (share + z2 / (2 * n) - z * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def set_id_of(tokens: Column) -> Column:
    return F.md5(F.array_join(F.array_sort(tokens), "\n"))


def matches(sets: DataFrame, index: DataFrame) -> DataFrame:
    """The columns of sets (with an array tokens) and of index (token, needed, ...) wherever all of needed is in tokens."""
    hits = sets.withColumn("token", F.explode("tokens")).join(index, "token").drop("token")
    return hits.where(F.size(F.array_except("needed", "tokens")) == 0)


def _under_rarest(found: DataFrame, tokens: DataFrame) -> DataFrame:
    """The rows of found (with a column needed, no two alike) and the rarest token of each."""
    seen = found.select("needed", F.explode("needed").alias("token")).join(tokens, "token")
    return found.join(seen.groupBy("needed").agg(F.min(F.struct("token_n", "token")).alias("least")), "needed").select(*found.columns, F.col("least.token").alias("token"))


def longer(opened: DataFrame, level: DataFrame, floor: int, confidence: float) -> DataFrame | None:
    """All sets (needed, rows, both) that grow out of a level of open sets of one size, until no set is open; None if none is.

    opened: labelled sets (n, both, tokens); level: needed (sorted), token (one of them), rows, both, best (the highest bound of it
    and its subsets). A set is open if a longer one may be a rule that no shorter one implies: it leaves out rows that each of
    its subsets holds, and if all that is blocked in it were all there is, it would have a bound that is enough and higher than
    best. No set that is not open has an open one, or such a rule, above it.
    """
    found = None
    while not level.isEmpty():
        grown = matches(opened, level.select("token", "needed", F.col("token").alias("under")))
        grown = grown.withColumn("more", F.explode(F.filter("tokens", lambda x: x > F.element_at("needed", -1))))
        grown = grown.groupBy(F.concat("needed", F.array("more")).alias("needed"), F.col("under").alias("token")).agg(
            F.sum("n").alias("rows"), F.sum("both").alias("both")
        )
        grown = cut(grown.where(F.col("both") >= floor), "longer")
        rows = grown.select("needed", "rows", "both")
        found = rows if found is None else found.unionByName(rows)
        parts = grown.withColumn("bound", lower_bound(F.col("both"), F.col("rows"))).withColumn("top", lower_bound(F.col("both"), F.col("both")))
        parts = parts.where((F.col("top") >= confidence) & (F.col("bound") < F.col("top")))
        parts = parts.withColumn("part", F.explode(F.transform("needed", lambda x: F.array_remove("needed", x))))
        parts = parts.join(level.select(F.col("needed").alias("part"), F.col("rows").alias("part_rows"), "best"), "part")
        parts = parts.where((F.col("part_rows") > F.col("rows")) & (F.col("best") < F.col("top")))
        parts = parts.groupBy("needed", "token", "rows", "both", "bound").agg(F.count("*").alias("parts"), F.max("best").alias("best"))
        parts = parts.where(F.col("parts") == F.size("needed"))
        level = cut(parts.select("needed", "token", "rows", "both", F.greatest("best", "bound").alias("best")), "open")
    return found


def mine(
    labelled: DataFrame,
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
    least_rows: int = LEAST_ROWS,
    longest: int = LONGEST,
    mined: int = MINED,
) -> DataFrame:
    """Rules (tokens, size, support, confidence, rarest) for "block" from rows (tokens, blocked boolean).

    support is the share of labelled rows that hold the tokens and are blocked, confidence the lower bound. Rows with a
    null label or set are left out; repeated rows count as often as they come. Too few blocked rows give no rule. Ties in
    confidence keep the shorter rule. longest and mined bound what FP-growth is given, not the rules.
    """
    spark = labelled.sparkSession
    none = spark.createDataFrame([], "tokens array<string>, size int, support double, confidence double, rarest string")
    rows = labelled.where("tokens is not null and blocked is not null").select(
        F.array_distinct("tokens").alias("tokens"), F.col("blocked").cast("int").alias("blocked")
    )
    # Labelled URLs of the same tokens are one row with its counts.
    sets = rows.groupBy(set_id_of(F.col("tokens")).alias("set_id")).agg(
        F.first("tokens").alias("tokens"), F.count("*").alias("n"), F.sum("blocked").alias("both")
    )
    sets = cut(sets, "labelled_sets")
    n, blocked = sets.agg(F.sum("n"), F.sum("both")).first()
    floor = max(least_rows, math.ceil(support * (n or 0)))
    if not n or blocked < floor:
        return none
    tokens = sets.select("n", "both", F.explode("tokens").alias("token")).groupBy("token").agg(F.sum("n").alias("token_n"), F.sum("both").alias("token_both"))
    tokens = cut(tokens.where(F.col("token_both") >= floor).withColumn("bound", lower_bound(F.col("token_both"), F.col("token_n"))), "tokens")
    # Longer rules that no shorter one implies hold none but open tokens (see longer()): not in all rows, and a bound to gain.
    most = lower_bound(F.col("token_both"), F.col("token_both"))
    usable = tokens.where((F.col("token_n") < n) & (most >= confidence) & (F.col("bound") < most))
    best = Window.partitionBy("set_id").orderBy(F.desc("bound"), "token")
    items = sets.select("set_id", "n", "both", F.explode("tokens").alias("token")).join(usable, "token").withColumn("nth", F.row_number().over(best))
    items = items.groupBy("set_id", "n", "both").agg(
        F.array_sort(F.collect_list("token")).alias("tokens"), F.collect_list(F.when(F.col("nth") <= mined, F.col("token"))).alias("items")
    )
    opened = cut(items.select("n", "both", "tokens", "items"), "opened")
    items = opened.where("both > 0").select("items", F.explode(F.sequence(F.lit(1), F.col("both").cast("int"))).alias("copy")).select("items")
    items = cut(items, "transactions")
    total = items.count()
    # Sets of one token are known; FP-growth gives those of more.
    counted = tokens.select(F.array("token").alias("needed"), F.col("token_n").alias("rows"), F.col("token_both").alias("both"))
    if total >= floor:
        found = FPGrowth(itemsCol="items", minSupport=(floor - 0.5) / total).fit(items).freqItemsets
        found = cut(found.where((F.size("items") > 1) & (F.size("items") <= longest)).select(F.array_sort("items").alias("needed")), "frequent")
        index = _under_rarest(found, tokens).select("needed", "token")
        shared = matches(opened.select("n", "both", "tokens"), index).groupBy("needed").agg(F.sum("n").alias("rows"), F.sum("both").alias("both"))
        counted = counted.unionByName(shared)
    counted = cut(_under_rarest(counted, tokens).withColumn("bound", lower_bound(F.col("both"), F.col("rows"))), "counted")
    # Where FP-growth has seen all tokens of all sets, what is longer than its sets is left, else all that grows out of single tokens.
    if opened.where((F.col("both") > 0) & (F.size("tokens") > mined)).isEmpty():
        level = counted.where((F.size("needed") == longest) & (F.col("both") >= floor))
        level = level.withColumn("top", lower_bound(F.col("both"), F.col("both"))).where((F.col("top") >= confidence) & (F.col("bound") < F.col("top")))
        below = counted.select("token", F.col("needed"), F.col("rows").alias("part_rows"), F.col("bound").alias("part_bound"))
        level = matches(level.withColumnRenamed("needed", "tokens").withColumnRenamed("token", "under"), below)
        level = level.groupBy(F.col("tokens").alias("needed"), F.col("under").alias("token"), "rows", "both", "top").agg(
            F.max("part_bound").alias("best"), F.count_if(F.col("part_rows") == F.col("rows")).alias("alike")  # it is like itself
        )
        level = level.where((F.col("alike") == 1) & (F.col("best") < F.col("top")))
    else:
        level = counted.where(F.size("needed") == 1).join(usable.select("token"), "token").withColumn("best", F.col("bound"))
    level = cut(level.select("needed", "token", "rows", "both", "best"), "open")
    more = longer(opened.select("n", "both", "tokens"), level, floor, confidence)
    if more is not None:
        counted = counted.select("needed", "rows", "both").unionByName(more).dropDuplicates(["needed"])
        counted = _under_rarest(counted, tokens)
    counted = counted.select("needed", F.col("token").alias("rarest"), "rows", "both")
    rules = counted.withColumn("confidence", lower_bound(F.col("both"), F.col("rows"))).where((F.col("both") >= floor) & (F.col("confidence") >= confidence))
    rules = cut(
        rules.select(F.col("needed").alias("tokens"), F.size("needed").alias("size"), (F.col("both") / n).alias("support"), "confidence", "rarest"),
        "rules",
    )
    # A rule goes if a rule on some of its tokens has at least its confidence; such a rule holds wherever it does.
    shorter = rules.select(F.col("rarest").alias("token"), F.col("tokens").alias("needed"), F.col("confidence").alias("base_confidence"))
    implied = matches(rules.select("tokens", "size", "confidence"), shorter).where(
        (F.size("needed") < F.col("size")) & (F.col("base_confidence") >= F.col("confidence"))
    )
    return rules.join(implied.select("tokens").distinct(), "tokens", "left_anti")


def judge(
    pages: DataFrame,
    labelled: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
    least_rows: int = LEAST_ROWS,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """id, host, path, rule, verdict and confidence for each row of pages; labelled has (tokens, blocked).

    An explicit rule decides where one fits; else the URL is blocked if any mined rule's tokens are all among its own
    (confidence: the highest of these), and allowed otherwise. Null URLs and those without :// have empty host and path,
    fit no rule and are allowed unless a mined rule says otherwise. Repeated rows are returned as often as they come;
    an empty table gives an empty result. Columns other than those named are ignored.
    """
    mined = cut(mine(labelled, support, confidence, least_rows), "mined")
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    cols = urls.select("id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    cols = cols.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    # Each different set of tokens is matched once; pages are joined to what was found by the set's hash.
    cols = cols.withColumn("tokens", tokens_of(F.col("url"))).withColumn("set_id", set_id_of(F.col("tokens")))
    cols = cut(cols.drop("url"), "urls")
    sets = cols.where("fit is null").groupBy("set_id").agg(F.first("tokens").alias("tokens"))
    index = mined.select(F.col("rarest").alias("token"), F.col("tokens").alias("needed"), "confidence")
    hits = matches(sets, index).groupBy("set_id").agg(F.max("confidence").alias("confidence"))
    hits = cut(hits, "matched")
    mined_verdict = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    joined = cols.join(hits, "set_id", "left")
    return joined.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), mined_verdict).alias("verdict"),
        F.when(F.col("fit").isNull(), F.col("confidence")).alias("confidence"),
    )


def page_labels(pages: DataFrame, labels: DataFrame, id_col: str = "doc_id", url_col: str = "url") -> DataFrame:
    """(tokens, blocked) of the pages whose document is labelled; the document's id is the last number of the path.

    A page is blocked if its document is toxic or of quality 0. Labels that repeat are averaged; null ids and
    labels without either mark are left out.
    """
    poor = F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.col("quality") == 0, F.col("toxic") == 1)
    marked = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), poor.cast("int").alias("poor"))
    marked = marked.groupBy("doc").agg(F.avg("poor").alias("poor")).where("poor is not null")
    doc = F.regexp_extract(path_of(F.col(url_col)), r"([0-9]{1,18})(?:\.[A-Za-z]+)?/?$", 1)
    urls = pages.select(doc.try_cast("long").alias("doc"), tokens_of(F.col(url_col)).alias("tokens"))
    return urls.where("doc is not null").join(marked, "doc").select("tokens", (F.col("poor") >= 0.5).alias("blocked"))
