"""Registered queries beside their SQL on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from cartulary.plans.queries import ORACLES, QUERIES

TABLES = Path("/root/testdata/sf0.001")
SOME = (
    "q_csv_roundtrip", "q_strict_union", "q_copied_files", "q_uploaded", "q_harvested", "q_xml_files", "q_image_versions", "q_calibrated", "q_associated", "q_landed_events",
    "q_edit_single", "q_edit_dedupe", "q_rewrite_links", "q_dedup_decision", "q_mark_multiple", "q_share_sample", "q_resolution_recap",
)


def _plain(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else round(v, 6) if isinstance(v, float) else v


def test_every_query_has_its_sql():
    names = entry.queries()
    assert set(QUERIES) <= set(names) and set(QUERIES) == set(ORACLES) and set(entry.oracle_sql()) <= set(names)


@pytest.mark.skipif(not TABLES.is_dir(), reason="no tables")
@pytest.mark.parametrize("name", SOME)
def test_query_agrees_with_its_sql(spark, name):
    found = QUERIES[name](spark, str(TABLES))
    columns = sorted(found.columns)
    got = sorted(([_plain(r[c]) for c in columns] for r in found.collect()), key=repr)
    with duckdb.connect() as db:
        for t in TABLES.glob("*.parquet"):
            db.execute(f"CREATE VIEW {t.stem} AS SELECT * FROM '{t}'")
        answer = db.execute(ORACLES[name])
        names = [d[0] for d in answer.description]
        rows = answer.fetchall()
    assert sorted(names) == columns
    assert got == sorted(([_plain(r[names.index(c)]) for c in columns] for r in rows), key=repr)
