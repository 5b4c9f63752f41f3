"""URL filters: pattern rules, indexed by the rarest literal token that each of them must contain.

Rules are a table. A host rule (level 0) is a host with all its subdomains and what its paths start
with: ``example.org/es/``. A pattern rule (level 1) runs on the lower-cased host and path joined:
``*`` stands for anything, ``^`` for signs other than letters and digits or for an end, all else for
itself. ``^casino^`` is that word anywhere, ``casino^`` also ends a longer word.

Expressions and tokens both follow from the rule's text. A token is a run of letters and digits; a
rule's run is one only where the rule has a sign on either side of it, so that no longer run of a
URL can stand there. Tokens of the URLs fetch the rules whose rarest token they are, by counts over
all URLs; only those run their expressions. A rule without a token is fetched by every URL, dealt
out over many keys. Built-in column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recfold.llm.rows import stored

# The rules of the contract, as hosts with paths.
HOST_RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)
# Words, word ends, paths and wildcards that the method adds.
PATTERN_RULES = (
    *(("block", f"^{word}^") for word in (
        "ads", "adult", "adserver", "bets", "betting", "casino", "clickbait", "doorway", "lottery", "malware", "pharma",
        "phishing", "pills", "poker", "porn", "porno", "slots", "spam", "torrent", "viagra", "warez", "webcam", "xxx",
    )),
    ("block", "casino^"), ("block", "^casino"), ("block", "porn^"), ("block", "^poker"),
    ("block", "^ad-banner^"), ("block", "^banner^*^click^"), ("block", "^track^*.gif^"), ("block", "^popup^*.js^"),
    ("block", "^wp-login.php^"), ("block", "^cgi-bin^*.exe^"), ("block", "^download^*.apk^"), ("block", "^tag/xxx"),
    ("allow", "^robots.txt^"), ("allow", "^anti-spam^"), ("allow", "^lottery^*^law^"),
)
_TOKENLESS_KEYS = 256
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower(text: Column) -> Column:
    """A to Z lower-cased, no other letter."""
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    return lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*+)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*+([^?#]*+)", 1)


def listed_rules(spark: SparkSession, hosts=HOST_RULES, patterns=PATTERN_RULES) -> DataFrame:
    """``verdict``, ``name``, ``level`` of rules given in code; longer lists are read as a table of these columns."""
    rows = [(verdict, name, level) for level, rules in enumerate((hosts, patterns)) for verdict, name in rules]
    return spark.createDataFrame(rows, "verdict string, name string, level int")


def compiled(rules: DataFrame) -> DataFrame:
    """``rules`` once each with ``pattern``, its regular expression, and ``tokens`` that a fitting URL has."""
    host_rule = F.col("level") == 0
    name = F.when(host_rule, F.col("name")).otherwise(lower(F.col("name")))
    quoted = F.regexp_replace(name, r"([^A-Za-z0-9*^\x{80}-\x{10FFFF}])", r"\\$1")
    literal = F.regexp_replace(quoted, r"([*^])", r"\\$1")
    wild = F.replace(F.replace(quoted, F.lit("^"), F.lit("(?:[^a-z0-9]+|\\A|\\z)")), F.lit("*"), F.lit(".*"))
    # A host begins where the URL's host or one of its labels does; a path may go on behind the rule's.
    text = F.when(host_rule, F.concat(F.lit("."), lower(name))).otherwise(name)
    signs = F.when(host_rule, F.lit("[^a-z0-9]")).otherwise(F.lit("[^a-z0-9*]"))
    runs = F.regexp_extract_all(text, F.concat(F.lit("(?<="), signs, F.lit(")([a-z0-9]+)(?="), signs, F.lit(")")), F.lit(1))
    return rules.select("verdict", "name", "level").distinct().select(
        "*", F.array_distinct(runs).alias("tokens"),
        F.when(host_rule, F.concat(F.lit(r"(?s)\A(?:[^/]*\.)?"), literal)).otherwise(F.concat(F.lit("(?s)"), wild)).alias("pattern"),
    )


def _keys(count: Column) -> Column:
    return F.concat(F.lit("#"), count.cast("string"))


def judge(pages: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``pattern_rule`` for every row of ``pages``.

    ``rules`` has ``verdict``, ``name``, ``level``; by default the lists above. ``rule`` is the
    longest host rule that fits, and gives the verdict; else the longest pattern rule
    (``pattern_rule``) does, block before allow and then in order of names; else it is allow. A
    NULL URL or one without ``://`` has an empty host and path, which no rule fits. Rows are judged
    one by one, repeated ones alike; an empty table gives no rows. Other columns are not looked at.
    """
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    table = stored(compiled(listed_rules(pages.sparkSession) if rules is None else rules), "rules")
    place = F.concat("host", "path")
    own = F.array_distinct(F.regexp_extract_all(lower(place), F.lit("([a-z0-9]+)"), F.lit(1)))
    any_rule = F.array(_keys(F.pmod(F.xxhash64("url"), F.lit(_TOKENLESS_KEYS))))
    tokens = rows.filter("host != ''").select("url", place.alias("place"), F.explode(F.concat(own, any_rule)).alias("token"))
    literals = table.filter(F.size("tokens") > 0).select("level", "name", "verdict", F.explode("tokens").alias("token"))
    counts = tokens.select("token").join(literals.select("token").distinct(), "token").groupBy("token").count()
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "token")).alias("rarest")
    rule = ["level", "name", "verdict"]
    index = literals.join(counts, "token", "left").groupBy(*rule).agg(rarest).select(*rule, F.col("rarest.token").alias("token"))
    tokenless = table.filter(F.size("tokens") == 0).select(
        *rule, F.explode(F.transform(F.sequence(F.lit(0), F.lit(_TOKENLESS_KEYS - 1)), _keys)).alias("token")
    )
    index = stored(index.unionByName(tokenless).join(table.drop("tokens"), rule), "rule_index")
    read = F.when(F.col("level") == 0, F.col("place")).otherwise(lower(F.col("place")))
    fits = tokens.join(index, "token").filter(F.rlike(read, F.col("pattern")))
    order = F.struct("level", -F.length("name"), (F.col("verdict") != "block"), "name", "verdict")
    best = fits.groupBy("url").agg(F.min(order).alias("best")).select("url", "best.level", "best.name", "best.verdict")
    # Written, so that the join deals both sides anew and Spark can split a URL that very many rows have.
    best = stored(best, "url_verdicts")
    # A row without a host has no rule; a key of its own keeps such rows from meeting in one task.
    key = F.when(F.col("host") != "", F.col("url")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id").cast("string")))
    return rows.withColumn("key", key).join(best.withColumnRenamed("url", "key"), "key", "left").select(
        "page_id", "host", "path",
        F.when(F.col("level") == 0, F.col("name")).alias("rule"),
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("level") == 1, F.col("name")).alias("pattern_rule"),
    )
