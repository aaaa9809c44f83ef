"""Driver contract: entry() runs; every query has a callable; oracle SQL agrees on sf0.001."""
import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "orders", "events", "documents", "pages", "labels"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:9] == ["title", "url", "publish_date", "authors", "source", "domain", "summary",
                              "section", "subsection"]


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else repr(round(v, 6))
    return "∅" if v is None else str(v)


@pytest.mark.parametrize("name", ["site_digest", "url_sections_base", "merge_published", "quota",
                                  "rss_round_trip", "page_paragraphs"])
def test_oracle_agrees_small(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    cols = sorted(sp.columns)
    assert cols == sorted(dk.columns)
    a = sorted("|".join(_norm(r[c]) for c in cols) for r in sp.to_dict("records"))
    b = sorted("|".join(_norm(r[c]) for c in cols) for r in dk.to_dict("records"))
    assert a == b
