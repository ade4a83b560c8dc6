"""Queries against their SQL on small tables drawn for what the test tables lack."""
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
import check

import __spark_entry__ as entry


@pytest.fixture
def agree(spark, tmp_path):
    """Whether a query agrees with its SQL on tables given as DuckDB selects."""
    def run(name, **tables):
        con = duckdb.connect()
        for t, sql in tables.items():
            con.execute(f"COPY ({sql}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
        df = entry.queries()[name](spark, str(tmp_path))
        rel = con.execute(entry.oracle_sql()[name])
        cols = [x[0] for x in rel.description]
        got, want = check.rows_of(df.columns, df.collect()), check.rows_of(cols, rel.fetchall())
        assert want and got == want, [(a, b) for a, b in zip(got, want, strict=False) if a != b][:3]
    return run


def test_times_go_to_the_nearest_second(agree):
    agree("nearest_sample", events="""SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_microseconds(i * 59700000) AS ts, i % 3 AS user_id,
      CASE WHEN i % 2 = 0 THEN 'error' ELSE 'view' END AS event_type, 1.0::DOUBLE AS value, '{"k": 1}' AS props FROM range(200) r(i)""")


def test_capitals_of_a_sharp_s(agree):
    agree("caption_check", conversations="""SELECT i AS conv_id, 3::BIGINT AS turn, 'user' AS role, 'weiß der Achßß erbeäß ß einer Maß groß ﬁn ŉun 𝒜 fußß' AS text FROM range(8) r(i)""")


LINES = """SELECT i::BIGINT AS l_orderkey, k::BIGINT AS l_partkey, k::BIGINT AS l_suppkey, 1::INT AS l_linenumber, {quantity}::DOUBLE AS l_quantity, {price}::DOUBLE AS l_extendedprice,
  0.1::DOUBLE AS l_discount, 0.05::DOUBLE AS l_tax FROM range(1, {keys}) r(k), range({rows}) s(i)"""


def test_deviations_are_rounded_before_they_are_judged(agree):
    # Two takes at the median and one off it by a few parts in ten million, or by a hair more than the bar.
    agree("consensus", lineitem=LINES.format(keys=400, rows=3, quantity="1 + CASE WHEN i < 2 THEN 0 ELSE CASE WHEN k % 10 = 0 THEN 0.15 + 2e-10 ELSE 0.0800005 + k / 1e5 END END", price="1"))


def test_keys_of_few_trials_have_no_tail(agree):
    agree("poisson_binomial_tail", lineitem=f"SELECT * FROM ({LINES.format(keys=14, rows=14, quantity='i', price='1')}) t WHERE l_orderkey < l_partkey")
