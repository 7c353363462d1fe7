"""The command line runs the same library functions end to end."""

import os

from quire.operators.ordinal import ordered_lines

from quire.__main__ import main
from tests.test_loadlog import LOG_A
from tests.test_xml import SAMPLE


def test_top_parquet_serve_and_log(spark, tmp_dir):
    xml = os.path.join(tmp_dir, "bib.xml")
    with open(xml, "w", encoding="utf-8") as f:
        f.write(SAMPLE)
    stop = os.path.join(tmp_dir, "stop.txt")
    with open(stop, "w") as f:
        f.write("on\nand\n")
    out = os.path.join(tmp_dir, "top")
    main(["top", "--xml", xml, "--stop", stop, "--out", out, "--venue", "conf/sigmod",
          "--venue", "journals/pvldb"])
    authors = [r.value for r in spark.read.text(f"{out}/authors").collect()]
    assert authors == ["Ann Lee", "Bob Ng", "Jürgen & Co"]
    words = [r.value for r in spark.read.text(f"{out}/words").collect()]
    assert "graphs" in words and "on" not in words

    pq = os.path.join(tmp_dir, "pubs")
    main(["to-parquet", "--xml", xml, "--out", pq])
    assert spark.read.parquet(pq).count() == 3

    cmds = os.path.join(tmp_dir, "cmds")
    os.makedirs(cmds)
    with open(os.path.join(cmds, "c.txt"), "w") as f:
        f.write("author: cy roe\nclique: cy roe, dee poe[1]\n")
    ans = os.path.join(tmp_dir, "ans")
    main(["serve", "--publications", pq, "--commands", cmds, "--out", ans,
          "--checkpoint", os.path.join(tmp_dir, "ck"), "--once"])
    texts = sorted((r.cmd_line, r.rank, r.text) for r in spark.read.parquet(ans).collect())
    assert texts[0] == (1, 0, "1") and texts[2] == (2, 0, "YES")

    log = os.path.join(tmp_dir, "a.log")
    with open(log, "w") as f:
        f.write(LOG_A)
    rep = os.path.join(tmp_dir, "rep")
    main(["log-report", "--log", log, "--date", "2024-01-01", "--out", rep])
    lines = [r.value for r in sorted(ordered_lines(spark, rep).collect(), key=lambda r: r.line_no)]
    assert lines[1] == "240" and lines[-1] == "115"
