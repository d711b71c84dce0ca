import pytest

from wattloom.session import build_session


def make_session():
    spark = build_session(
        "wattloom-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()


READING_DDL = "house_id bigint, date string, ts bigint, zip string, label string, meter_id string, power double"


@pytest.fixture
def readings_of(spark):
    """Readings from (house, meter, ts, label, power[, zip]) tuples; dates follow from ts in UTC."""
    from pyspark.sql import functions as F

    def make(*rows):
        full = [(h, m, ts, label, float(p), z[0] if z else "00001") for h, m, ts, label, p, *z in rows]
        frame = spark.createDataFrame(
            full, "house_id bigint, meter_id string, ts bigint, label string, power double, zip string"
        )
        return frame.select(
            "house_id", F.from_unixtime("ts", "yyyy-MM-dd").alias("date"), "ts", "zip", "label", "meter_id", "power"
        )

    return make


def rows_of(frame, *columns):
    """Rows as sorted tuples."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=lambda t: tuple((v is not None, v) for v in t))
