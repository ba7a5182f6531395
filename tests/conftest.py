import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.crossJoin.enabled", "false")  # a join without a key fails
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def history_rows():
    """Plays of 40 users over 60 tracks in two taste groups, with user 0 and one very active user."""
    import random

    rng = random.Random(7)
    rows = []
    for user in range(40):
        group = user % 2
        liked = [t for t in range(60) if t % 2 == group]
        n = 30 if user == 3 else 14
        tracks = set(rng.sample(liked, min(n, 13)) if user != 3 else range(45))
        tracks |= set(rng.sample(range(60), 1))
        rows += [(user, t, rng.randint(1, 9)) for t in sorted(tracks)]
    return rows


@pytest.fixture(scope="session")
def plays(spark, history_rows):
    return spark.createDataFrame(history_rows, "user_id int, track_id int, playcount bigint").repartition(4).cache()
