"""A hot name (on two thirds of all publications) through the command path,
checked against a brute-force answer computed in Python on the same rows."""

import os

from quire.streaming.commands import CommandService

HOT = "Hot Author"


def _pubs(spark):
    rows = []
    for i in range(3000):
        authors = [f"A{i % 37}", f"B{i % 11}"]
        if i % 3 != 0:
            authors.insert(i % 2, HOT)
        if i % 50 == 0:
            authors.append(HOT)            # listed twice: still one publication
        rows.append((i, f"T{i % 97}.", authors, 1990 + i % 30, f"db/conf/x/{i}.html"))
    return rows, spark.createDataFrame(
        rows, "pub_id bigint, title string, author array<string>, year bigint, url string")


def test_hot_name_answers_match_brute_force(spark, tmp_dir):
    rows, pubs = _pubs(spark)
    src = os.path.join(tmp_dir, "cmds")
    os.makedirs(src)
    with open(os.path.join(src, "c.txt"), "w") as f:
        f.write("author: hot author\nclique: hot author, hot author[1]\n"
                "clique: hot author, a1[5]\n")
    svc = CommandService(spark, pubs)
    got = svc.answer_files(src).collect()
    svc.release()

    mine = [r for r in rows if any(a.lower() == "hot author" for a in r[2])]
    want = sorted(mine, key=lambda r: (-r[3], r[1], r[0]))
    author = sorted((r for r in got if r.cmd_line == 1), key=lambda r: r.rank)
    assert author[0].text == str(len(mine))
    assert [r.text for r in author[1:]] == [r[1] for r in want]
    assert [r.rank for r in author] == list(range(len(mine) + 1))

    twice = [r for r in rows if sum(a.lower() == "hot author" for a in r[2]) >= 2]
    clique = sorted((r for r in got if r.cmd_line == 2), key=lambda r: r.rank)
    assert clique[0].text == "YES" and len(clique) == len(twice) + 1

    with_a1 = [r for r in mine if "A1" in r[2]]
    c3 = sorted((r for r in got if r.cmd_line == 3), key=lambda r: r.rank)
    assert c3[0].text == ("YES" if len(with_a1) >= 5 else "NO")
    assert len(c3) == len(with_a1) + 1


def test_hot_name_spans_files_and_a_changed_table_gets_a_new_index(spark, tmp_dir):
    import glob

    from quire.streaming.commands import build_index, name_bucket
    from pyspark.sql import functions as F
    rows, pubs = _pubs(spark)
    home = build_index(spark, pubs, os.path.join(tmp_dir, "ix"))
    bucket = spark.range(1).select(name_bucket(F.lit("hot author")).alias("b")).first()["b"]
    assert len(glob.glob(f"{home}/entries/bucket={bucket}/*.parquet")) > 1
    assert build_index(spark, pubs, os.path.join(tmp_dir, "ix")) == home
    more = pubs.union(pubs.limit(1))
    assert build_index(spark, more, os.path.join(tmp_dir, "ix")) != home


def test_index_tasks_follow_the_entries(spark, tmp_dir, monkeypatch):
    """a task sorts so many entries, however few the shuffle partitions are."""
    import glob
    import re

    from quire.streaming import commands
    rows, pubs = _pubs(spark)
    entries = sum(len({a.lower() for a in r[2]}) for r in rows)
    monkeypatch.setattr(commands, "RANGE_ENTRIES", entries // 40)
    home = commands.build_index(spark, pubs, os.path.join(tmp_dir, "many"))
    tasks = {re.search(r"part-(\d+)", f).group(1) for f in glob.glob(f"{home}/entries/bucket=*/*.parquet")}
    assert len(tasks) > 24 and spark.read.parquet(f"{home}/entries").count() == entries


def test_files_of_one_name_are_two_files(spark, tmp_dir):
    _, pubs = _pubs(spark)
    for d, line in (("d1", "author: a1"), ("d2", "author: b1")):
        os.makedirs(os.path.join(tmp_dir, d))
        with open(os.path.join(tmp_dir, d, "c.txt"), "w") as f:
            f.write(line + "\n")
    svc = CommandService(spark, pubs)
    heads = [r for r in svc.answer_files([os.path.join(tmp_dir, d) for d in ("d1", "d2")]).collect() if r.rank == 0]
    svc.close()
    assert len(heads) == 2 and all(int(r.text) > 0 for r in heads)
