"""Q13-Q15 on the literal logs of FIXTURES.md (day roll, Z1, Z2, Z4, Z5)."""

import os

from quire.operators.ordinal import ordered_lines
from quire.plans import loadlog

LOG_A = """23:58:10 up 3:17, 4 users, load average: 1.25, 0.91, 0.62
23:59:05 up 3:18, 4 users, load average: 2.10, 1.04, 0.00
00:01:00 up 12 days, 3:20, 5 users, load average: 0.75, 0.88, 0.57
00:01:30 up 3:21, 1 user, load average: 0.31, 0.66, 0.00
00:02:10 up 3:22, 1 user, load average: 3.02, 1.20, 0.71
"""
LOG_B = """23:58:11 up 3:17, 4 users, load average: 1.25, 0.91, 0.62
23:59:07 up 3:18, 4 users, load average: 2.10, 1.04, 0.00
00:01:03 up 12 days, 3:20, 5 users, load average: 0.75, 0.88, 0.57
00:01:34 up 3:21, 1 user, load average: 0.31, 0.66, 0.00
"""


def _dated(spark, tmp_dir, name, text, block=loadlog.BLOCK):
    p = os.path.join(tmp_dir, name)
    with open(p, "w") as f:
        f.write(text)
    parsed = loadlog.parse_load_log(ordered_lines(spark, p).select("line_no", "value"))
    return loadlog.with_day_roll(parsed, "2024-01-01", block=block)


def test_parse_with_comma_in_uptime_z2(spark, tmp_dir):
    rows = {r.line_no: r for r in _dated(spark, tmp_dir, "a.log", LOG_A).collect()}
    assert rows[3].uptime == "12 days, 3:20" and rows[3].users == 5 and rows[3].load15 == 0.57
    assert rows[1].load1 == 1.25 and rows[2].load15 == 0.0


def test_report_q14(spark, tmp_dir):
    rep = loadlog.log_report(_dated(spark, tmp_dir, "a.log", LOG_A)).collect()
    stats = {r.section: r.text for r in rep if r.ord == 0}
    assert stats["line_count"] == "5"
    assert stats["span_seconds"] == "240"         # Z4: day roll
    assert stats["positive_load15"] == "3"        # Z1: a true comparison
    assert stats["nonnull_load15"] == "5"         # what the reference counted
    assert stats["even_bytes"] == "115"
    assert sorted(r.ord for r in rep if r.section == "even_line") == [2, 4]


def test_day_roll_across_blocks(spark, tmp_dir):
    # Blocks of 2 lines: the roll between lines 2 and 3 sits on a block edge.
    for block in (1, 2, 3):
        rows = sorted(_dated(spark, tmp_dir, f"a{block}.log", LOG_A, block=block).collect(),
                      key=lambda r: r.line_no)
        assert [r.day for r in rows] == [0, 0, 1, 1, 1]


def test_skew_q15(spark, tmp_dir):
    a = _dated(spark, tmp_dir, "a.log", LOG_A)
    b = _dated(spark, tmp_dir, "b.log", LOG_B)
    got = sorted((r.line_no, r.seconds) for r in loadlog.log_skew(a, b).collect())
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_file_date_s10(spark, tmp_dir):
    import datetime
    p = os.path.join(tmp_dir, "c.log")
    with open(p, "w") as f:
        f.write(LOG_A)
    os.utime(p, (1704067200 + 3600, 1704067200 + 3600))   # 2024-01-01 01:00 UTC
    assert loadlog.file_date(spark, p) == datetime.date(2024, 1, 1)


def test_file_date_of_several_files_is_the_first_files(spark, tmp_dir):
    import datetime
    for name, day in (("part-100000-a.txt", 40), ("part-99999-a.txt", 0)):
        p = os.path.join(tmp_dir, name)
        with open(p, "w") as f:
            f.write(LOG_A)
        at = 1704067200 + day * 86400
        os.utime(p, (at, at))
    assert loadlog.file_date(spark, tmp_dir) == datetime.date(2024, 1, 1)


def test_file_date_of_an_empty_file_is_none(spark, tmp_dir):
    p = os.path.join(tmp_dir, "empty.log")
    open(p, "w").close()
    assert loadlog.file_date(spark, p) is None


def test_report_text_in_order_k8(spark, tmp_dir):
    rep = loadlog.log_report(_dated(spark, tmp_dir, "a.log", LOG_A))
    dest = loadlog.write_report(rep, os.path.join(tmp_dir, "rep"))
    lines = [r.value for r in sorted(ordered_lines(spark, dest).collect(), key=lambda r: r.line_no)]
    a = LOG_A.splitlines()
    assert lines == ["5", "240", "3", "5", a[1], a[3], "115"]


def test_line_with_the_mark_is_no_load_line(spark, tmp_dir):
    rows = _dated(spark, tmp_dir, "m.log", LOG_A.replace("up 3:17", "up 3\u00011:17")).collect()
    assert [r.sec_of_day is None for r in sorted(rows, key=lambda r: r.line_no)] == [True] + [False] * 4


def test_malformed_lines_are_null_not_errors(spark, tmp_dir):
    text = ("23:59:40 up 9 min, 3 users, load average: 0.52, 0.43, 0.29\n"
            "garbage line here\n\n"
            "00:00:10 up 2:41, 1 user, load average: 0.07, 0.11, 0.36\n"
            "25:99:99 up x, 3 users, load average: 1.5, 2, 3\n")
    d = _dated(spark, tmp_dir, "bad.log", text)
    rows = sorted(d.collect(), key=lambda r: r.line_no)
    assert [r.sec_of_day for r in rows] == [86380, None, None, 10, None]
    assert [r.day for r in rows] == [0, 0, 0, 1, 1]
    stats = {r.section: r.text for r in loadlog.log_report(d).collect() if r.ord == 0}
    assert stats["line_count"] == "5" and stats["span_seconds"] == "30"


def test_stored_logs_are_joined_where_they_lie(spark, tmp_dir):
    from tests.test_plans_and_entry import _plan
    a, b = (loadlog.store_log(_dated(spark, tmp_dir, f"{n}.log", text, block=2), f"quire_test_{n}", os.path.join(tmp_dir, n), 4)
            for n, text in (("a", LOG_A), ("b", LOG_B)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        skew = loadlog.log_skew(a, b)
        got, plan = sorted((r.line_no, r.seconds) for r in skew.collect()), _plan(skew)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan


def test_file_facts_read_no_contents_s9_s10(spark, tmp_dir):
    from tests.test_plans_and_entry import _plan
    for name, text, day in (("part-00002.txt", "x" * 10, 3), ("part-00001.txt", "y" * 7, 2)):
        p = os.path.join(tmp_dir, name)
        with open(p, "w") as f:
            f.write(text)
        at = 1_700_000_000 + day * 86_400
        os.utime(p, (at, at))
    facts = {os.path.basename(r.file): r.bytes for r in loadlog.file_facts(spark, tmp_dir).collect()}
    assert facts == {"part-00001.txt": 7, "part-00002.txt": 10}
    row = loadlog.log_facts(spark, tmp_dir).first()
    assert row.bytes == 17 and str(row.date) == "2023-11-16"
    assert "content" not in _plan(loadlog.log_facts(spark, tmp_dir)).split("ReadSchema")[1]
