"""Each query against its SQL in DuckDB, on the smallest tables."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry
from sedimenta.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value.isoformat() if isinstance(value, datetime.datetime) else value


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in found)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    mine = registry.queries()[name](spark, SF)
    theirs = duck.execute(registry.oracle_sql()[name])
    assert rows(mine.columns, mine.collect()) == rows([d[0] for d in theirs.description], theirs.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_metadata_patch_has_a_page_for_every_order(spark, monkeypatch):
    from sedimenta.plans import queries

    seen, patches = [], queries.repair.topic_patches
    monkeypatch.setattr(queries.repair, "topic_patches", lambda lost, pages: seen.append((lost, pages)) or patches(lost, pages))
    queries.metadata_patch(spark, "/root/testdata/sf0.001")
    assert [(lost.count(), pages.count()) for lost, pages in seen] == [(1500, 1500)]
