"""URL filters by a sort-merge range join, in DataFrame functions only.

A host is turned into a canonical key: its labels in reverse, each closed by a full stop (``www.example.org`` ->
``org.example.www.``). All hosts below a rule's host have keys that begin with the rule's key, so a rule host is an
interval of keys: from its key up to the key with the last full stop replaced by the character that follows it, and
intervals are nested or apart. One sorted sweep over interval ends and urls carries the stack of rules whose intervals
are open: the last end before a url tells it. Of the stack, the rules whose path begins the url's path apply, and the
longest (host and path together; of equal ones that with the longer host, then a block) gives the verdict.

The sweep is dealt by ranges of keys, cut at rule hosts, and where a range holds many urls by a salt of the url, so that
neither a host with a third of all rows nor few rules put many rows into one task. Each (range, salt) gets the ends
inside its range and one at its beginning with the stack there. Urls are shuffled once, without any other column but their key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of rule hosts; more rules only make the ranges longer.
RANGES = 64
#: Urls of one range that are swept together, unless it has more rules; a range with more urls is salted.
SHARE = 1000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or if null."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or if null."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each closed by a full stop; the empty host has the empty key."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _ends(rules: DataFrame) -> DataFrame:
    """``(key, close, stack)``: the interval ends in key order, each with the rules that are open from there on."""
    known = rules.select(
        F.coalesce(F.translate("host", _UPPER, _LOWER), F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.col("verdict")
    ).withColumn("key", host_key(F.col("host")))
    one = F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"), (F.col("verdict") == "block").alias("blocks"), "path", F.concat("host", "path").alias("rule"), "verdict")
    own = known.groupBy("host", "key").agg(F.array_distinct(F.collect_list(one)).alias("own"))
    # The stack at a host is what its suffixes own; an equi-join over each host's few suffixes.
    labels = F.split("host", r"\.")
    suffixes = F.array_distinct(F.concat(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")), F.array(F.lit(""))))
    up = own.select("host", "key", F.explode(suffixes).alias("suffix"))
    above = up.join(own.select(F.col("host").alias("suffix"), "own"), "suffix")
    stacks = above.groupBy("host", "key").agg(F.flatten(F.collect_list("own")).alias("open"), F.flatten(F.collect_list(F.when(F.col("suffix") != F.col("host"), F.col("own")))).alias("after"))
    begin = stacks.select("key", F.lit(0).alias("close"), F.length("key").alias("depth"), F.col("open").alias("stack"))
    after_key = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/"))
    finish = stacks.where("key <> ''").select(after_key.alias("key"), F.lit(1).alias("close"), (-F.length("key")).alias("depth"), F.col("after").alias("stack"))
    return begin.union(finish)


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Adds ``host, path, rule, verdict`` to the rows of ``pages``; same-named columns of ``pages`` give way.

    ``rules(host, path, verdict)``: a rule fits its host and all hosts below it if the url's path begins with its path.
    A null host or path in a rule is empty; the empty host fits all. ``rule`` is host and path, null where none fits;
    the verdict is then ``default``. Null urls and urls without ``://`` have an empty host and path. Repeated rows are
    judged each; an empty table of rules leaves the default to all.
    """
    spark = pages.sparkSession
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    ends = _ends(rules)
    # At most RANGES cuts: the rule hosts of the least hashes, an even sample that needs no global sort.
    spread = ends.where("close = 0").select("key").orderBy(F.xxhash64("key"), "key").limit(RANGES)
    cuts = sorted({r["key"] for r in spread.collect()} - {""})
    bounds = F.array(*map(F.lit, cuts)) if cuts else F.expr("cast(array() as array<string>)")
    range_of = lambda key: F.size(F.filter(bounds, lambda c: c <= key))

    urls = pages.select(F.struct(*names).alias("row"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    urls = urls.withColumn("key", host_key(F.col("host"))).withColumn("range", range_of(F.col("key")))

    marks = ends.withColumn("range", range_of(F.col("key")))
    # A range opens with the stack that is in force there: the last end of the ranges before it. Each range's last end
    # is one row, so that the window sees at most RANGES + 1 of them.
    lasts = marks.groupBy("range").agg(F.max(F.struct("key", "close", "depth", "stack")).alias("m"))
    starts = spark.range(len(cuts) + 1).select(F.col("id").cast("int").alias("range"), F.get(F.array(*map(F.lit, ["", *cuts])), F.col("id").cast("int")).alias("start"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = starts.join(lasts, "range", "left").select("range", "start", F.last("m.stack", ignorenulls=True).over(earlier).alias("stack")).where("stack is not null")
    marks = marks.select("range", "key", "close", "depth", "stack").union(before.select("range", F.col("start").alias("key"), F.lit(-1), F.lit(0), "stack"))
    # Only ranges that hold many urls are salted, each by its size, and only their rules are copied: so often that all
    # copies are no more than the urls and the rules.
    ruled = marks.groupBy("range").agg(F.count("*").alias("rules"))
    share = F.greatest(F.lit(SHARE), F.coalesce("rules", F.lit(0)))
    sizes = urls.groupBy("range").agg(F.count("*").alias("n")).join(ruled, "range", "left").select("range", F.ceil(F.col("n") / share).cast("int").alias("salts"))
    counted = F.broadcast(sizes)  # at most RANGES + 1 rows
    marks = marks.join(counted, "range").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    urls = urls.join(counted, "range").withColumn("salt", F.pmod(F.xxhash64("row"), F.col("salts")).cast("int")).drop("salts")

    row_type = urls.schema["row"].dataType.simpleString()
    events = marks.select("range", "salt", "key", F.col("close").alias("kind"), "depth", "stack", F.lit(None).cast(row_type).alias("row"), F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"))
    points = urls.select("range", "salt", "key", F.lit(2).alias("kind"), F.lit(0).alias("depth"), F.lit(None).cast(ends.schema["stack"].dataType).alias("stack"), "row", "host", "path")
    sweep = Window.partitionBy("range", "salt").orderBy("key", "kind", "depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.union(points).withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 2")
    best = F.array_max(F.filter("open", lambda r: F.startswith(F.col("path"), r["path"])))
    judged = swept.withColumn("best", best)
    return judged.select("row.*", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


#: The registered query's rules (fixed values).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def default_rules(spark) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in RULES))
    return spark.range(1).select(F.inline(rows))
