"""Benchmark decontamination by template windows and slot consistency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.llm.storage import Steps, maybe_at, place_of, text_of, without_places

#: Tokens in a window, those of them that must be words of the text itself where others
#: are placeholders, windows that prove a leak (6 windows of 8 tokens are 13 in a row),
#: and the share of a short item's windows that do.
WINDOW = 8
LITERALS = 4
PROOF = 6
SHARE = 0.6
#: Share of a run's windows with slots that must agree in what stands for what.
AGREEING = 0.75
#: Items of fewer tokens say something only where they are a whole document.
SHORT = 4
#: White space of more signs than these separates texts rather than words.
BREAK = 100
#: Benchmark windows that are broadcast (24 bytes each); beyond, the join shuffles.
BROADCAST_WINDOWS = 200_000

UNITS = (
    "mm cm dm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre "
    "metres kilometer kilometers g kg mg lb lbs oz gram grams kilogram kilograms pound pounds "
    "ounce ounces ton tons l ml liter liters litre litres s sec second seconds min minute "
    "minutes h hour hours day days week weeks month months year years percent dollar dollars "
    "euro euros cent cents degree degrees mph kmh watt watts volt volts joule joules"
).split()
_MARK = "\u0001"
_SPACE = r"[\s\u00a0\u2000-\u200a\u202f\u3000]"
_NUMBER = r"\p{Nd}+(?:[.,:/]\p{Nd}+)*"
# Scripts that put no spaces between words (Thai to Lao, Burmese, Khmer,
# kana, Han); each of their letters is a token.
_UNSPACED = (
    r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
    r"\x{20000}-\x{3ffff}"
)
_WORD = rf"[\p{{L}}&&[^{_UNSPACED}]]+|[\p{{L}}&&[{_UNSPACED}]]"


def marked(text: Column) -> Column:
    """A mark before each name: a capitalised word after a small letter, digit, comma or
    semicolon and white space (of up to BREAK signs)."""
    after = rf"(?<=[\p{{Ll}}\p{{Nd}},;]{_SPACE}{{1,{BREAK}}})"
    return F.regexp_replace(text, rf"(?=\p{{Lu}}\p{{Ll}}){after}", _MARK)


def raw_tokens(marked_text: Column) -> Column:
    """Numbers and words, names with their marks."""
    token = F.lit(rf"({_NUMBER}|{_MARK}?(?:{_WORD}))")
    return F.regexp_extract_all(marked_text, token, F.lit(1))


def plain_token(t: Column) -> Column:
    """A token in small letters, whatever it may stand for."""
    return F.lower(F.ltrim(t, F.lit(_MARK)))


def template_tokens(tokens: Column) -> Column:
    """``#n`` for numbers, ``#u`` for units after a number, ``#p`` for names, else the
    word in small letters."""
    def number(t: Column) -> Column:
        return F.substr(t, F.lit(1), F.lit(1)).rlike(r"\p{Nd}")

    def one(t: Column, i: Column) -> Column:
        small, first = F.lower(t), F.substr(t, F.lit(1), F.lit(1))
        unit = small.isin(UNITS) & (i > 0) & number(F.get(tokens, i - 1))
        # Most words begin with a small ASCII letter: no pattern is tried on these.
        plain = (first >= "a") & (first <= "z")
        return (
            F.when(plain & ~small.isin(UNITS), small)
            .when(number(t), F.lit("#n"))
            .when(first == _MARK, F.lit("#p"))
            .when(unit, F.lit("#u"))
            .otherwise(small)
        )

    return F.transform(tokens, one)


def _hashed(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with ``raw`` tokens of the text and two hashes of each: as in the template
    (``t``) and plain (``p``)."""
    found = rows.withColumn("_marked", marked(text)).withColumns(
        {"raw": raw_tokens(F.col("_marked")), "_typed": F.col("_marked").rlike(rf"[{_MARK}\p{{Nd}}]")}
    )
    raw, is_typed = F.col("raw"), F.col("_typed")
    # Many texts hold no name or number: their tokens are small-letter words.
    small = F.transform(raw, lambda t: F.xxhash64(F.lower(t)))
    kinds = F.transform(template_tokens(raw), lambda k: F.xxhash64(k))
    plain = F.transform(raw, lambda t: F.xxhash64(plain_token(t)))
    hashed = found.withColumn("t", F.when(is_typed, kinds).otherwise(small))
    return hashed.withColumn("p", F.when(is_typed, plain).otherwise(F.col("t"))).drop(
        "_marked", "_typed"
    )


def _windows(size: int) -> Column:
    """Hashes of each run of ``size`` tokens, plain, and after these typed, unless all are
    the same; null if there are fewer tokens."""
    starts = F.sequence(F.lit(1), F.size("t") - (size - 1))

    def of(kind: str) -> Column:
        return F.transform(starts, lambda i: F.xxhash64(F.slice(F.col(kind), i, size)))

    both = F.when(F.col("t") == F.col("p"), of("p")).otherwise(F.concat(of("p"), of("t")))
    return F.when(F.size("t") >= size, both)


def _benchmark_windows(steps: Steps, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items (item, item_id, raw, kinds, size, all_windows, need, typed_windows,
    typed_need) and windows (size, hash, item, at, typed, proves).

    An item shorter than a window is one window of its own length.  Every window is there
    with its plain tokens.  One with placeholders is there ``typed`` as well, if enough
    of its tokens are words of its own.  ``proves``: a window of the template.
    """
    items = (
        benchmark.where(F.col("item_id").isNotNull())
        .transform(_hashed, text_of())
        .dropDuplicates(["item_id", "raw"])
        .select("item_id", "raw", "t", "p", template_tokens(F.col("raw")).alias("kinds"))
        .withColumn("size", F.least(F.size("raw"), F.lit(WINDOW)))
        .withColumn("item", F.xxhash64("item_id", "raw"))
        .where("size > 0")
    )
    starts = F.sequence(F.lit(1), F.size("raw") - F.col("size") + 1)

    def run(of: str) -> Column:
        return F.slice(F.col(of), F.col("at") + 1, F.col("size"))

    literal = F.size(F.filter(run("kinds"), lambda t: ~F.startswith(t, F.lit("#"))))
    cut = (
        items.select("item", "size", "kinds", "t", "p", F.posexplode(starts).alias("at", "_"))
        .select(
            "size", "item", "at",
            F.xxhash64(run("t")).alias("t"), F.xxhash64(run("p")).alias("p"),
            (literal == F.col("size")).alias("bare"),
            ((literal * WINDOW >= F.col("size") * LITERALS) & (F.col("size") >= SHORT)).alias("told"),
        )
    )
    plain = cut.select("size", F.col("p").alias("hash"), "item", "at", F.lit(False).alias("typed"), F.col("bare").alias("proves"))
    typed = cut.where("told and not bare").select(
        "size", F.col("t").alias("hash"), "item", "at", F.lit(True).alias("typed"), F.lit(True).alias("proves")
    )
    windows = steps.store(plain.union(typed))

    def need(n: str) -> Column:
        return F.least(F.lit(PROOF), F.greatest(F.lit(1), F.floor(F.col(n) * SHARE)))

    counts = windows.groupBy("item").agg(
        F.count_if(~F.col("typed")).alias("all_windows"), F.count_if("proves").alias("typed_windows")
    )
    items = items.drop("t", "p").join(counts, "item").withColumns(
        {"need": need("all_windows"), "typed_need": F.when(F.col("typed_windows") > 0, need("typed_windows"))}
    )
    return steps.store(items), windows


def _hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Places where a window of a document is one of the benchmark's."""
    counted = windows.groupBy("size").count().collect()  # at most WINDOW rows
    known = windows
    if sum(r["count"] for r in counted) <= BROADCAST_WINDOWS:
        known = F.broadcast(windows)
    tokens = _hashed(docs.withColumn("place", place_of()), F.col("text")).select("place", "t", "p")
    out = docs.select(place_of().alias("place")).limit(0).selectExpr(
        "place", "0L as item", "0 as at", "false as typed", "false as proves", "0 as pos"
    )
    for row in counted:
        size = row["size"]
        held = tokens if size >= SHORT else tokens.where(F.size("t") == size)
        number = (F.size("t") - (size - 1)).alias("number")
        each = held.select("place", number, F.posexplode(_windows(size)).alias("k", "hash"))
        runs = each.select("place", "hash", (F.col("k") % F.col("number")).alias("pos"))
        found = runs.join(known.where(F.col("size") == size), "hash").select(
            "place", "item", "at", "typed", "proves", "pos"
        )
        out = out.union(found)
    return out


def _agreeing(typed: DataFrame, items: DataFrame, own: DataFrame) -> DataFrame:
    """Of typed hits (place, item, shift, at) those whose slots agree with their run's,
    and whether they are verbatim.

    Along a run (same distance between the places in document and item) each value of the
    item has the value that most windows put in its place, and the other way round.  A
    window agrees if all its slots do.  A run where less than AGREEING of the windows
    agree is a chance hit of the template.
    """
    offsets = F.sequence(F.lit(0), F.col("size") - 1)
    at = F.col("at") + F.col("k")
    run = ["place", "item", "shift"]
    slots = (
        typed.join(items.select("item", "raw", "kinds", "size"), "item")
        .join(own, "place")
        .withColumn("k", F.explode(offsets))
        .where(F.startswith(F.get("kinds", at), F.lit("#")))
        .select(
            *run, "at",
            plain_token(F.get("raw", at)).alias("theirs"),
            plain_token(F.get("doc_raw", at + F.col("shift"))).alias("ours"),
        )
    )
    support = slots.groupBy(*run, "theirs", "ours").agg(F.count(F.lit(1)).alias("n"))
    by_item = support.groupBy(*run, "theirs").agg(
        F.max(F.struct("n", "ours")).getField("ours").alias("ours")
    )
    by_doc = support.groupBy(*run, "ours").agg(
        F.max(F.struct("n", "theirs")).getField("theirs").alias("theirs")
    )
    pair = [*run, "theirs", "ours"]
    good = by_item.join(by_doc, pair).select(*pair, F.lit(True).alias("good"))
    judged = slots.join(good, pair, "left").groupBy(*run, "at").agg(
        F.bool_and(F.coalesce("good", F.lit(False))).alias("good"),
        F.bool_and(F.col("theirs") == F.col("ours")).alias("same"),
    )
    shares = judged.groupBy(*run).agg(F.avg(F.col("good").cast("int")).alias("share"))
    return judged.where("good").join(shares.where(F.col("share") >= AGREEING), run).select(
        *run, "at", "same"
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and benchmark item that leaks into it.

    Numbers, units and names become typed placeholders in both.  Windows of WINDOW
    tokens are joined by hash.  Along each run the slots must be consistent: a value of
    the item always meets the same value in the document, and different values different
    ones (see _agreeing).  So a question with other numbers and names is found, and
    chance hits of a template are not.  Windows are joined with their plain small-letter
    tokens too, so what is copied word for word counts whatever its slots, case or line
    breaks.  An item leaks if PROOF different windows of it are found (of short items,
    SHARE of the windows), all of them, or those of its template.

    Columns: doc_id, item_id, n_windows (found), of_windows, verbatim (all found ones),
    place (hash of id and text).  Letters of scripts without spaces are a token each.
    Null or empty texts leak nothing.  Items of fewer than SHORT tokens leak where they
    are a whole document; items without letters and digits, or with a null id, are not
    looked for.  A null doc_id is reported as null; repeated rows give one row; very long
    texts are read whole; other columns are ignored; an empty table on either side gives
    no rows.
    """
    spark = docs.sparkSession
    with Steps(spark) as steps:
        items, windows = _benchmark_windows(steps, benchmark)
        read = docs.select("doc_id", text_of().alias("text"))
        hits = steps.store(_hits(read, windows).distinct())
        # Enough windows, whatever their slots: only these documents are read again.
        enough = (
            hits.groupBy("place", "item")
            .agg(F.count_distinct("at").alias("n"))
            .join(items.select("item", "need", "typed_need"), "item")
            .where("n >= least(need, typed_need)")
            .select("place", "item")
        )
        runs = steps.store(
            hits.join(enough, ["place", "item"]).withColumn("shift", F.col("pos") - F.col("at"))
        )
        wanted = steps.store(runs.select("place").distinct())
        own = steps.store(
            maybe_at(read, wanted)
            .join(wanted, "place")
            .dropDuplicates(["place"])
            .select("doc_id", "place", raw_tokens(marked(F.col("text"))).alias("doc_raw"))
        )
        typed = runs.where("typed").select("place", "item", "shift", "at").distinct()
        agreeing = _agreeing(typed, items, own.select("place", "doc_raw"))
        counted = (
            runs.where("not typed")
            .select("place", "item", "at", "proves", F.lit(True).alias("same"))
            .union(agreeing.select("place", "item", "at", F.lit(True), "same"))
            .groupBy("place", "item", "at")
            .agg(F.bool_or("proves").alias("proves"), F.bool_or("same").alias("same"))
            .groupBy("place", "item")
            .agg(
                F.count(F.lit(1)).alias("found"),
                F.count_if("proves").alias("proving"),
                F.bool_and("same").alias("verbatim"),
            )
        )
        leaking = (
            counted.join(items.drop("raw", "kinds"), "item")
            .where("found >= need or proving >= typed_need")
            .join(own.select("place", "doc_id"), "place")
        )
        return steps.keep(steps.store(leaking.select(
            "doc_id",
            "item_id",
            F.col("found").alias("n_windows"),
            F.col("all_windows").alias("of_windows"),
            "verbatim",
            "place",
        )))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents into which an item leaks; nulls, empty texts,
    repeated rows and empty tables as in leaks, columns as they are, whatever their names.
    """
    return without_places(docs, leaks(docs, benchmark).select("place").distinct())
