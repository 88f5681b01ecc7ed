"""Random near-dates against a reading of them in plain Python."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from tristrata.functions import dates


def mangled(rng: random.Random) -> str:
    text = (
        f"{rng.choice([1, 20, 200, 1999, 2020, 9998]):04d}-{rng.randint(0, 13):02d}"
        f"-{rng.randint(0, 32):02d}"
    )
    if rng.random() < 0.7:
        text += f" {rng.randint(0, 25):02d}:{rng.randint(0, 61):02d}:{rng.randint(0, 61):02d}"
    chars = list(text)
    for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
        at = rng.randrange(len(chars))
        action = rng.randrange(3)
        odd = rng.choice("0123456789- :TZ+.x/é")
        if action == 0:
            chars[at] = odd
        elif action == 1:
            chars.insert(at, odd)
        elif len(chars) > 1:
            del chars[at]
    return "".join(chars)


def fields(text: str, wanted: int) -> list[int] | None:
    """The leading numbers, if the text starts like a date (or a date and time)."""
    time = r" (\d\d?):(\d\d?):(\d\d?)" if wanted == 6 else ""
    found = re.match(rf"[ ]*(\d{{4,}})-(\d\d?)-(\d\d?){time}(?!\d)", text, re.ASCII)
    return [int(g) for g in found.groups()] if found else None


def expected(text: str, wanted: int):
    try:
        return dt.datetime(*fields(text, wanted))
    except (TypeError, ValueError, OverflowError):
        return None


def test_dates_read_as_in_plain_python(spark):
    rng = random.Random(7)
    texts = sorted({mangled(rng) for _ in range(30_000)})
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    read = df.select(
        "t",
        F.date_format(dates.parse_timestamp("t"), "yyyy-MM-dd HH:mm:ss").alias("second"),
        dates.parse_date("t").cast("string").alias("day"),
    ).collect()
    usual = [r for r in read if not re.match(r"\s*(0000|\d{5,})-", r.t)]
    assert len(usual) > 20_000
    for r in usual:
        second, day = expected(r.t, 6), expected(r.t, 3)
        assert r.second == (second and f"{second:%Y-%m-%d %H:%M:%S}".zfill(19)), r.t
        assert r.day == (day and f"{day:%Y-%m-%d}".zfill(10)), r.t
