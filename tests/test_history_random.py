"""Replay against a plain loop over files, on many random feeds at once."""

import datetime as dt
import random

from pyspark.sql import functions as F

from lakeloom.operators import history
from tests.conftest import rows

OPEN, START = dt.date(9999, 12, 31), dt.date(2024, 1, 1)


def feeds(cases: int, seed: int):
    """Few ids and people per case, so that packs, repeats, unknown deletes and same-day pairs are common."""
    r = random.Random(seed)
    out = []
    for case in range(cases):
        for day in range(8):
            for _ in range(r.randrange(4)):
                person, part = r.randrange(2), r.choice("ab")
                kind = r.choice(["upsert", "upsert", "delete"])
                out.append((f"{case}.{person}", f"{case}.{person}{part}", START + dt.timedelta(day), kind, r.choice("xyz")))
    return out


def loop(feed, full_day):
    """Deletes of a file first, then its upserts; only the newest version of a chain can be closed."""
    chains = {}
    for day in sorted({f[2] for f in feed}):
        today = [f for f in feed if f[2] == day]
        for gone in {f[1] for f in today if f[3] == "delete"}:
            for chain, versions in chains.items():
                if gone in chain.split("|"):
                    versions[-1][1] = OPEN if day == full_day else day - dt.timedelta(1)
        for person in {f[0] for f in today}:
            mine = [f for f in today if f[0] == person and f[3] == "upsert"]
            if mine:
                chain = "|".join(sorted({f[1] for f in mine}))
                chains.setdefault(chain, []).append([day, OPEN, "|".join(sorted({f[4] for f in mine}))])
    return sorted(((c, v[0], v[1], len(vs) - i, v[2]) for c, vs in chains.items() for i, v in enumerate(vs)), key=str)


def test_replay_equals_a_loop_over_files(spark):
    feed = feeds(150, 11)
    full_day = START + dt.timedelta(5)
    df = spark.createDataFrame(feed, "person string, id string, day date, op string, v string")
    for limit in (None, 200):
        out = history.replay(df, "person", "id", "day", "op", full=F.col("day") == F.lit(full_day), max_group_rows=limit)
        assert rows(out, "id", "effective_date", "end_date", "version", "v") == loop(feed, full_day)
