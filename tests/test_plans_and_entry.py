"""Plan shape (TakeOrderedAndProject, broadcast anti join, no Python) and the driver contract."""

import __spark_entry__ as entry
from quire.plans.catalog import QUERIES
from quire.plans import bibliography as bib
from quire.sources import fixtures

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_top_authors_is_take_ordered(spark):
    df = bib.top_authors(bib.select_venues(fixtures.publications(spark, SF)))
    assert "TakeOrderedAndProject" in _plan(df)


def test_stop_words_broadcast_anti_join(spark):
    df = bib.title_words(fixtures.document_titles(spark, SF), fixtures.stop_words(spark))
    p = _plan(df)
    assert "BroadcastHashJoin" in p and "LeftAnti" in p


def test_select_venues_pushes_year_filter_to_scan(spark):
    df = bib.select_venues(fixtures.publications(spark, SF))
    df.collect()
    p = _plan(df)
    # the year bound and the title's presence reach the scan of the stored table
    stored = bib.select_venues(fixtures.publications_table(spark, SF))
    scan = [x for x in _plan(stored).splitlines() if "PushedFilters" in x]
    assert any("GreaterThanOrEqual(year,2000)" in x for x in scan), scan


def test_no_python_udfs_in_any_query(spark):
    for name, fn in QUERIES.items():
        if name in ("answer_commands", "stream_titles", "copy_sweep", "copy_timings", "range_copy", "retag_records",
                    "xml_publications", "parquet_roundtrip"):
            continue   # these write first; their read-back plans are plain scans
        p = _plan(fn(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_entry_and_registry(spark):
    df = entry.entry(spark)
    assert df.columns == ["rank", "author", "n"]
    assert df.count() > 0
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 25
