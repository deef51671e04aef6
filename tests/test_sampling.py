import hashlib
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from helpers import actions, rows
from footfall.operators import sampling
from footfall.operators.topn import first_n
from pyspark.sql import functions as F


def make_sessions(spark, per_hour):
    found = []
    for (day, hour), count in per_hour.items():
        start = datetime(2024, 1, day, hour)
        found += [(f"s{day}-{hour}-{n}", start + timedelta(seconds=n)) for n in range(count)]
    return spark.createDataFrame(found, "session_id string, start_time timestamp_ntz")


def expected_sample(per_hour, total, seed):
    days = Counter()
    for (day, _), count in per_hour.items():
        days[day] += count
    picked = set()
    for (day, hour), count in per_hour.items():
        quota = min(count, count * (total // len(days)) // days[day])
        ids = [f"s{day}-{hour}-{n}" for n in range(count)]
        ids.sort(key=lambda text: hashlib.md5(f"{text}{seed}".encode()).hexdigest())
        picked |= set(ids[:quota])
    return picked


PER_HOUR = {(1, 0): 3, (1, 5): 60, (1, 6): 1, (2, 23): 40, (3, 7): 7}


@pytest.mark.parametrize("total, seed", [(100, 42), (100, 43), (30, 42), (2, 42), (5000, 42)])
def test_sample(spark, total, seed):
    sessions = make_sessions(spark, PER_HOUR)
    sampled = [row[0] for row in sampling.sample_sessions(sessions, total, seed).collect()]
    assert len(sampled) == len(set(sampled))
    assert set(sampled) == expected_sample(PER_HOUR, total, seed)


def test_quota(spark):
    counts = sampling.session_hour_counts(make_sessions(spark, PER_HOUR))
    quota = {(row.date, row.hour): row for row in sampling.session_sample_quota(counts, 100).collect()}
    # 3 days, so 33 a day; the first has 64 sessions.
    assert {key: row.quota for key, row in quota.items()} == {
        ("2024-01-01", 0): 1,
        ("2024-01-01", 5): 30,
        ("2024-01-01", 6): 0,
        ("2024-01-02", 23): 33,
        ("2024-01-03", 7): 7,
    }
    assert quota["2024-01-01", 5].day_sessions == 64


def test_no_sessions(spark):
    assert sampling.sample_sessions(make_sessions(spark, {})).collect() == []


def test_report_comes_from_the_actions(spark):
    log = actions(
        spark,
        [
            {"session_id": "a", "search_keyword": "x", "at": 5},
            {"session_id": "a", "click_category_id": 7, "at": 2},
            {"session_id": "b"},
        ],
    )
    sampled = spark.createDataFrame([("a",)], "session_id string")
    detail = sampling.sampled_detail(log, sampled)
    assert detail.count() == 2
    (row,) = sampling.sample_report(detail).collect()
    assert (row.session_id, str(row.start_time), row.search_keywords, row.click_category_ids) == (
        "a",
        "2024-01-01 08:00:02",
        "x",
        "7",
    )


def test_first_n_beyond_the_pruning_limit(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id"))
    for n in (3, 1500):
        best = defaultdict(list)
        for row in first_n(df, ["g"], [F.desc("id")], n).collect():
            best[row.g].append((row["rank"], row.id))
        for g, found in best.items():
            expected = sorted((i for i in range(5000) if i % 2 == g), reverse=True)[:n]
            assert sorted(found) == list(enumerate(expected, start=1))
