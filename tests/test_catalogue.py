"""Every registered query over the sequence operators against its SQL."""

import os
from pathlib import Path

import duckdb
import pytest

from tempoloom.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def _table(rows):
    return sorted((tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    got = catalogue.queries()[name](spark, DATA)
    want = db.execute(catalogue.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert _table(tuple(r) for r in got.select(*columns).collect()) == _table(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_other_queries_run(spark, name):
    assert catalogue.queries()[name](spark, DATA).count() > 0


def test_the_flagship_query(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_confidence_at_the_threshold_equals_its_sql(spark, tmp_path):
    """Runs of three whose mean is the threshold, but for its last bit in one of the two orders."""
    path = str(tmp_path / "events.parquet")
    db = duckdb.connect(config={"threads": 1})
    db.execute(f"""COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds(i) AS ts, i // 6 AS user_id, CASE WHEN i % 6 < 3 THEN 'click' ELSE 'purchase' END AS event_type,
        [0.7, 24.2, 47.1, 47.1, 24.2, 0.7][i % 6 + 1]::DOUBLE AS value, '{{"k": 1}}' AS props FROM range(60000) t(i)) TO '{path}'""")
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{path}'")
    want = db.execute(catalogue.oracle_sql()["filter_confidence"]).fetchall()
    got = catalogue.queries()["filter_confidence"](spark, str(tmp_path)).collect()
    assert len(got) == 60000 and sorted(map(tuple, got)) == sorted(want)
