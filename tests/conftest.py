import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny(spark):
    """Raw tables of the tiny preset, cached for the session."""
    from bidloom.sources.synthetic import Run, all_datasets

    return {name: df.cache() for name, df in all_datasets(spark, Run()).items()}


@pytest.fixture(scope="session")
def tiny_raw(tiny):
    from bidloom.plans.enrichment import Inputs

    return Inputs(
        bids=tiny["bids"], impressions_same=tiny["impressions_same"], impressions_late=tiny["impressions_late"],
        contextual=tiny["contextual"], advertiser=tiny["advertiser"], settings=tiny["koa_settings"],
        eligible=tiny["matched_user_data"], features=tiny["feature_log"], sib=tiny["sib"],
    )


@pytest.fixture(scope="session")
def tiny_job(tiny_raw):
    from dataclasses import replace

    from bidloom.plans import converters

    return replace(
        tiny_raw,
        eligible=converters.convert_eligible(tiny_raw.eligible).cache(),
        features=converters.convert_features(tiny_raw.features).cache(),
    )
