import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corpuskit.session import checkpoint_dir, ship_package

    session = (
        SparkSession.builder.master("local[8]")
        .appName("corpuskit-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(session)
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def corpus(spark):
    texts = [
        "the cat sat on the mat\nthe  dog ran to the cat",
        "low lower lowest newer newest wide wider widest",
        "un été à la plage, l'été dernier vu　là-bas aaa aaaa",
        "",
        "  (5) 98701 98701 ba ab ab cb bab  ",
        "the theme then there these aab aaab abab abab",
    ]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


@pytest.fixture(scope="session")
def texts(corpus):
    return [r["text"] for r in corpus.orderBy("doc_id").collect()]
