"""URL filter: rules by host and path, else logistic regression on character n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of the hashed feature space, n-gram lengths, and the fit.
SLOTS = 4096
NGRAMS = (3, 4)
STEPS = 150
RATE = 2.0
MOMENTUM = 0.9
DECAY = 0.0001

RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

# The labelled table: host words and paths by label, spread over plain hosts by rule.
_BLOCK = (
    "casino casino-win win-casino slots poker free-bets bets betting free-slots jackpot "
    "cheap-pills pills pharma viagra cheap-meds spam-farm spam link-farm farm-links "
    "ads-track ads adserver ad-click tracker track popup banner-ads adult-x adult xxx porn "
    "sex-cams cams-x escort warez crack-keygen torrent-free free-money win-prize lottery "
    "payday-loans replica-watch click-bait malware phish-login"
)
_ALLOW = (
    "news daily journal library museum school university science nature garden kitchen "
    "recipes travel maps weather sports football music film theatre history archive docs "
    "wiki forum open-source python code data health clinic city council times post review "
    "begin within cabin basin latin origin thin thing things nothing evening morning berlin "
    "dublin turin thinking winter window wing swing bring string spring training planet market "
    "theonthe anderent tionesh thereat ouenre dertion einlich schauer leaire ciondo "
    "therenth ththan ereaing shonthe edesti nderhe tionand inghat"
)
_PREFIXES = ("", "www.", "m.", "blog.")
_ENDINGS = ("com", "net", "org")
_PATHS = ("/", "/en/12", "/de/7340.html", "/fr/88/", "/es/405", "/a/b-c")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small table the filter is trained on: host, path, label (1: block)."""
    one = spark.range(1)
    words = one.select(F.posexplode(F.split(F.lit(_BLOCK), " ")).alias("k", "word"), F.lit(1).alias("label"))
    words = words.union(
        one.select(F.posexplode(F.split(F.lit(_ALLOW), " ")).alias("k", "word"), F.lit(0).alias("label"))
    )
    pick = lambda of, step: F.element_at(
        F.array(*map(F.lit, of)), F.pmod(F.col("k") * step + F.col("r"), F.lit(len(of))) + 1
    )
    return words.withColumn("r", F.explode(F.array(*map(F.lit, range(4))))).select(
        F.concat(pick(_PREFIXES, 1), "word", F.lit(".example."), pick(_ENDINGS, 2)).alias("host"),
        pick(_PATHS, 1).alias("path"),
        "label",
    )


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    whole = F.coalesce(url, F.lit(""))
    at = F.locate("://", whole)
    rest = F.when(at > 0, F.substr(whole, at + 3)).otherwise("")
    rest = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/]*)", 1)
    path = F.substr(rest, F.length(host) + 1)
    return F.translate(host, upper, upper.lower()), path


def _slots(text: Column, mark: str) -> Column:
    """Slots of the n-grams of ``text``, its ends marked."""
    marked = F.concat(F.lit(mark + "^"), text, F.lit("$"))
    grams = [
        F.transform(
            F.sequence(F.lit(1), F.length(marked) - (n - 1)),
            lambda i, n=n: F.pmod(F.hash(F.substr(marked, i, F.lit(n)), F.lit(mark)), F.lit(SLOTS)),
        )
        for n in NGRAMS
    ]
    return F.concat(*grams)


def url_slots(host: Column, path: Column) -> Column:
    # Digits of a path say little; they are one sign.
    return F.array_distinct(
        F.concat(_slots(host, "host"), _slots(F.regexp_replace(path, "[0-9]+", "0"), "path"))
    )


def fit_weights(labelled: DataFrame) -> DataFrame:
    """One row, ``weights``: SLOTS numbers and the intercept.

    Gradient descent over the whole labelled table, as one expression: rows as an array
    of slot lists, slots as an array of row lists, a step maps one over the other.  The
    table is small by definition (a few hundred rows).  Rows with a null label or null
    host are left out; without rows the weights are zero.
    """
    rows = (
        labelled.where("label is not null and host is not null")
        .select(
            "label",
            "host",
            "path",
            url_slots(F.col("host"), F.coalesce("path", F.lit(""))).alias("slots"),
        )
        .agg(F.sort_array(F.collect_list(F.struct("host", "path", "label", "slots"))).alias("rows"))
    )
    rows = rows.select(
        F.transform("rows", lambda r: r["slots"]).alias("x"),
        F.transform("rows", lambda r: r["label"].cast("double")).alias("y"),
        F.greatest(F.size("rows"), F.lit(1)).cast("double").alias("n"),
    )
    met = rows.select("x", "y", "n", F.posexplode_outer("x").alias("row", "slots")).select(
        "row", F.explode_outer("slots").alias("slot")
    )
    lists = met.groupBy("slot").agg(F.sort_array(F.collect_list("row")).alias("of"))
    lists = lists.where("slot is not null")
    by_slot = lists.agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "of"))).alias("m")
    ).select(
        F.transform(
            F.sequence(F.lit(0), F.lit(SLOTS - 1)),
            lambda s: F.coalesce(F.col("m")[s.cast("int")], F.array().cast("array<int>")),
        ).alias("of")
    )
    data = rows.select("x", "y", "n", by_slot.scalar().alias("of"))
    step = f"""
        aggregate(
          sequence(1, {STEPS}),
          struct(array_repeat(0D, {SLOTS + 1}) as w, array_repeat(0D, {SLOTS + 1}) as v),
          (m, _) -> transform(
            array(transform(x, (s, i) ->
              y[i] - 1 / (1 + exp(-m.w[{SLOTS}] - aggregate(
                s, 0D, (a, k) -> a + m.w[k]) / sqrt(cast(size(s) + 1 as double)))))),
            e -> transform(
              array(concat(
                transform(of, (r, k) -> {MOMENTUM}D * m.v[k] - {RATE * DECAY}D * m.w[k] +
                  {RATE}D / n * aggregate(
                    r, 0D, (a, i) -> a + e[i] / sqrt(cast(size(x[i]) + 1 as double)))),
                array({MOMENTUM}D * m.v[{SLOTS}] + {RATE}D / n * aggregate(
                  e, 0D, (a, d) -> a + d)))),
              v -> struct(zip_with(m.w, v, (a, b) -> a + b) as w, v as v))[0])[0]).w
    """
    return data.select(F.expr(step).alias("weights"))


def chance_to_block(slots: Column, weights: Column) -> Column:
    logit = F.aggregate(slots, F.lit(0.0), lambda a, k: a + F.get(weights, k))
    scale = F.sqrt((F.size(slots) + 1).cast("double"))
    return 1 / (1 + F.exp(-(F.get(weights, F.lit(SLOTS)) + logit / scale)))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; nulls if none does."""
    text = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (
            F.endswith(F.concat(F.lit("."), host), F.lit("." + rule_host))
            & F.startswith(path, F.lit(rule_path))
        )
        text = F.when(fits, rule_host + rule_path).otherwise(text)
        verdict = F.when(fits, kind).otherwise(verdict)
    return text, verdict


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES) -> DataFrame:
    """A verdict for every page's url: its longest rule's, else the regression's.

    Columns: page_id, host, path, rule (null without one), verdict (allow or block),
    chance (of block, from the regression; null where a rule decides).  A null url, or
    one without ``://``, has an empty host and path and is judged by the regression like
    others; very long urls are read whole; repeated rows are judged each; other columns
    are ignored; no pages, no rows.  There is no shuffle: the weights are a scalar.
    """
    labelled = labelled if labelled is not None else labelled_urls(pages.sparkSession)
    host, path = split_url(F.col("url"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    weights = fit_weights(labelled).scalar()
    judged = (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .select("*", rule.alias("rule"), verdict.alias("given"), weights.alias("weights"))
        .select(
            "*",
            F.when(
                F.col("given").isNull(),
                chance_to_block(url_slots(F.col("host"), F.col("path")), F.col("weights")),
            ).alias("chance"),
        )
    )
    by_chance = F.when(F.col("chance") >= 0.5, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("given", by_chance).alias("verdict"), "chance"
    )
