"""Record-safe XML scan (entities, markup, splits, kinds)."""

import os

from pyspark.sql import functions as F

from quire.sources import xml as X

SAMPLE = """<?xml version="1.0" encoding="ISO-8859-1"?>
<!DOCTYPE bib SYSTEM "bib.dtd">
<bib>
<article key="k/1" mdate="2020"><author orcid="0000">Ann Lee</author><author>J&uuml;rgen &amp; Co</author><title>Query <i>Processing</i> on
Graphs.</title><year>2003</year><url>db/journals/pvldb/a.html</url></article><inproceedings key="k/2"><author>Bob Ng</author><title>Two.</title><year>2001</year><url>db/conf/sigmod/b.html</url></inproceedings>
<www key="w/1"><author>Zed</author><title>Home</title></www>
<mastersthesis key="k/3">
<author></author>
<title>Empty author.</title>
<year>2005</year>
</mastersthesis>
<phdthesis key="k/4"><author>Cy Roe</author><title>Bad year.</title><year>x</year></phdthesis>
<phdthesis key="k/5"><author>Cy Roe</author><author>Dee Poe</author><title>Thesis.</title><year>2010</year><url>u</url></phdthesis>
</bib>
"""


def test_xml_publications_sample(spark, tmp_dir):
    p = os.path.join(tmp_dir, "bib.xml")
    with open(p, "w", encoding="utf-8") as f:
        f.write(SAMPLE)
    got = {r.pub_key: r for r in X.load_publications(spark, p).collect()}
    assert set(got) == {"k/1", "k/2", "k/5"}
    assert got["k/1"].author == ["Ann Lee", "Jürgen & Co"]
    assert got["k/1"].title == "Query Processing on Graphs."
    assert got["k/2"].year == 2001
    assert got["k/5"].author == ["Cy Roe", "Dee Poe"]


def test_unknown_entity_kept_as_text(spark):
    df = spark.createDataFrame([("a &uuml; &bogus; &amp; b",)], "s string")
    assert df.select(X.resolve_entities(F.col("s"))).first()[0] == "a ü &amp;bogus; &amp; b"


def test_many_records_over_small_splits(spark, tmp_dir):
    p = os.path.join(tmp_dir, "big.xml")
    kinds = X.KINDS
    with open(p, "w") as f:
        f.write("<?xml version='1.0'?>\n<bib>\n")
        for i in range(5000):
            k = kinds[i % 4]
            sep = "\n" if i % 3 == 0 else ""
            f.write(f'<{k} key="r/{i}">{sep}<author>A{i % 97}</author>{sep}<title>T {i}.</title>'
                    f'<year>{2000 + i % 20}</year></{k}>')
            if i % 2 == 0:
                f.write("\n")
        f.write("</bib>\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(p).rdd.getNumPartitions() > 20
        got = X.load_publications(spark, p).select("pub_key", "title").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 5000
    assert {r.pub_key for r in got} == {f"r/{i}" for i in range(5000)}
    assert all(r.title == f"T {r.pub_key[2:]}." for r in got)


def test_retag_q1(spark, tmp_dir):
    p = os.path.join(tmp_dir, "in.xml")
    with open(p, "w") as f:
        f.write('<inproceedings key="a"><title>x</title></inproceedings>\n<phdthesis>\n</phdthesis>\n')
    out = X.retag_lines(spark, p, os.path.join(tmp_dir, "out"))
    lines = [r.value for r in spark.read.text(out).collect()]
    assert sorted(lines) == sorted(['<article key="a"><title>x</title></article>', "<article>",
                                    "</article>"])


def test_records_that_used_to_be_lost(spark, tmp_dir):
    """Tag name at line end, decoded comparison signs, self-closing and unclosed records."""
    text = ('<bib>\n<article\n key="a"><author>A</author><title>When x &lt; y and y &gt; z <i>hold</i>.</title>'
            '<year>2001</year></article>\n<article key="e"/>\n'
            + "".join(f"<www key='w{i}'><title>no {i}</title></www>\n" for i in range(50))
            + '<phdthesis key="u"><author>U</author><title>Open.</title><year>2002</year>\n'
            + "".join(f"<book><title>b {i}</title></book>\n" for i in range(50))
            + '<article key="z"><author>Z</author><title>Last.</title><year>2003</year></article>\n'
            + '<article key="z"><author>Z</author><title>Last.</title><year>2003</year></article>\n</bib>\n')
    p = os.path.join(tmp_dir, "lost.xml")
    with open(p, "w") as f:
        f.write(text)
    recs = X.xml_records(spark, p).collect()
    assert len(recs) == 4 and max(len(r.xml) for r in recs) < 300
    got = X.load_publications(spark, p).collect()
    assert sorted(r.title for r in got if r.title != "Open.") == ["Last.", "Last.", "When x < y and y > z hold."]
    assert len({r.pub_id for r in got}) == len(got)


def _expected(text, kinds):
    """The records of one text, by the scan's rule, straightforwardly."""
    import re
    alt, other = "|".join(kinds), "|".join(X.FOREIGN)
    out, start = [], None
    for m in re.finditer(rf"(</(?:{alt})>)|(<(?:{alt})(?:\s[^<>]*)?/>)|(<(?:{alt})(?=[\s>/]|$))|(<(?:{other})(?=[\s>/]|$))", text):
        if start is not None:
            out.append(text[start:m.end()] if m[1] else text[start:m.start()].rstrip("\n"))
        start = m.start() if m[3] else None
    return out


def _messy(kinds, n=400):
    parts = ["<?xml version='1.0'?>\n<bib>\n"]
    for i in range(n):
        k = kinds[i % len(kinds)]
        body = f"<author>A{i % 7}</author>{chr(10) * (i % 3)}<title>T {i} {'long ' * (i % 40)}.</title>"
        if i % 50 == 9:
            body += "\n" + "\n".join(f"<note>{j}</note>" for j in range(300))  # longer than a split
        if i % 31 == 3:
            parts.append(f"<www key='w{i}'><title>none</title></www>")
        if i % 29 == 5:
            parts.append(f'<{k}\n key="e{i}"/>\n')
        parts.append(f'<{k}{chr(10) if i % 5 == 0 else " "}key="r/{i}">{body}')
        parts.append("" if i % 23 == 7 else f"</{k}>")
        parts.append("\n" if i % 4 else "")
    return "".join(parts) + f"<book><title>last</title></book>\n</bib>\n"


def test_records_equal_a_plain_scan_whatever_the_splits(spark, tmp_dir):
    for kinds in (X.KINDS, (X.UNIFIED,)):
        text = _messy(kinds)
        p = os.path.join(tmp_dir, f"messy{len(kinds)}.xml")
        with open(p, "w") as f:
            f.write(text)
        want = sorted(_expected(text, kinds))
        for size in ("700", "5000", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            try:
                rows = X.xml_records(spark, p, kinds).collect()
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
                spark.conf.unset("spark.sql.files.openCostInBytes")
            assert sorted(r.xml for r in rows) == want, (kinds, size)
            ordered = [r.xml for r in sorted(rows, key=lambda r: tuple(r.record))]
            assert ordered == _expected(text, kinds), (kinds, size)


def test_the_text_is_read_once_and_not_shuffled(spark, tmp_dir, capfd):
    from tests.test_plans_and_entry import _plan
    p = os.path.join(tmp_dir, "one.xml")
    with open(p, "w") as f:
        f.write(_messy((X.UNIFIED,), 50))
    plan = _plan(X.xml_records(spark, p, (X.UNIFIED,)))
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan and "Window" not in plan
    with open(p, "w") as f:
        f.write(_messy(X.KINDS, 50))
    scan = X._lines(spark, [p]).mapInArrow(X._scanner(X.KINDS, X.FOREIGN), X.RECORDS_SQL)
    plan = _plan(scan)
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan
    # of the stored records only those at split edges are shuffled
    plan = _plan(X.xml_records(spark, p))
    assert "FileScan text" not in plan
    branches = plan.split("Union")[1]
    whole = [b for b in branches.split("FileScan parquet") if "whole" in b][0]
    assert "Exchange" not in whole.split("+- ")[0]


def test_a_record_is_parsed_once(spark, tmp_dir):
    """the filter on what was parsed is not pushed below the parser, which would parse for every field."""
    path = os.path.join(tmp_dir, "once.xml")
    with open(path, "w") as f:
        f.write("<article key='a'><author>A</author><title>T</title><year>2000</year></article>\n" * 3)
    pubs = X.load_publications(spark, path)
    assert len(pubs.collect()) == 3
    assert pubs._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1
