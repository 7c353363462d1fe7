"""Q12: stream = batch in one, two and three micro-batches; restart adds nothing."""

import os

import pytest

from quire.streaming.commands import CommandService, read_answers

COMMANDS = [
    "author: Ann Lee",
    "foo:bar",
    "author:",
    "coauthor:ann  lee:ignored",
    "clique:bob ng, bob ng[1]",
    "",
]


def _write_files(d, groups):
    os.makedirs(d, exist_ok=True)
    line_lists = []
    for gi, g in enumerate(groups):
        with open(os.path.join(d, f"cmd-{gi}.txt"), "w") as f:
            f.write("\n".join(g) + "\n")
        line_lists.append(g)


def _split(n):
    k = -(-len(COMMANDS) // n)
    return [COMMANDS[i:i + k] for i in range(0, len(COMMANDS), k)]


def _norm(rows):
    return sorted((r.op, r.arg, r.status, r.rank, r.text) for r in rows)


@pytest.fixture()
def service(spark, pubs):
    return CommandService(spark, pubs)


def test_batch_answers(spark, service, tmp_dir):
    _write_files(os.path.join(tmp_dir, "in"), [COMMANDS])
    rows = service.answer_files(os.path.join(tmp_dir, "in")).collect()
    by = {}
    for r in rows:
        by.setdefault(r.cmd_line, []).append(r)
    status = {k: v[0].status for k, v in by.items()}
    assert status == {1: "ok", 2: "unknown command", 3: "invalid input", 4: "ok", 5: "ok",
                      6: "invalid input"}
    author = sorted(by[1], key=lambda r: r.rank)
    assert [r.text for r in author] == ["4", "Other Venue.", "Query Processing on Graphs.",
                                        "Graphs  and Streams.", "Old Data."]
    co = sorted(by[4], key=lambda r: r.rank)
    assert [r.text for r in co] == ["5", "Ann Lee : 4", "ann lee : 4", "Bob Ng : 3", "Cy Roe : 2",
                                    "Dee Poe : 2"]
    cl = sorted(by[5], key=lambda r: r.rank)
    assert [r.text for r in cl] == ["YES", "Ends blank . , [Bob Ng,Bob Ng] , 2003"]
    assert len(by[2]) == 1 and by[2][0].text is None


@pytest.mark.parametrize("n_batches", [1, 2, 3])
def test_stream_equals_batch_and_restart(spark, service, tmp_dir, n_batches):
    src = os.path.join(tmp_dir, "src")
    _write_files(src, _split(n_batches))
    batch = _norm(service.answer_files(src).collect())
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    q = service.start(src, out, ck, available_now=True, max_files_per_trigger=1)
    q.awaitTermination()
    streamed = read_answers(spark, out).collect()
    assert _norm(streamed) == batch
    assert spark.read.parquet(out).select("batch_id").distinct().count() == n_batches
    # Restart from the checkpoint: no new batch, no new rows.
    q2 = service.start(src, out, ck, available_now=True, max_files_per_trigger=1)
    q2.awaitTermination()
    assert _norm(read_answers(spark, out).collect()) == batch


def test_parse_command_statuses_z16_z23(spark):
    from pyspark.sql import functions as F
    from quire.functions.commands import parse_command
    lines = ["author: Ann  Lee ", "author:", "author: ", "", "foo:bar", "coauthor:x:y",
             " CLIQUE : a[1]"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    p = parse_command(F.col("value"))
    got = [(r.op, r.arg, r.status) for r in
           df.select(p["op"].alias("op"), p["arg"].alias("arg"), p["status"].alias("status")).collect()]
    assert got == [("author", "ann lee", "ok"), ("author", "", "invalid input"),
                   ("author", "", "invalid input"), ("", None, "invalid input"),
                   ("foo", "bar", "unknown command"), ("coauthor", "x", "ok"),
                   ("clique", "a[1]", "ok")]


def test_echo_prints_answers(spark, service, tmp_dir, capfd):
    src = os.path.join(tmp_dir, "src")
    _write_files(src, [["author: Ann Lee"]])
    q = service.start(src, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"),
                      available_now=True, echo=20)
    q.awaitTermination()
    assert "Other Venue." in capfd.readouterr().out


def _wait(until, seconds=120):
    import time
    end = time.time() + seconds
    while not until():
        assert time.time() < end, "the service did not answer"
        time.sleep(0.2)


def _put(src, name, lines):
    """A command file that appears at once, as the file source expects."""
    os.makedirs(src, exist_ok=True)
    hidden = os.path.join(src, f".{name}")
    with open(hidden, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.rename(hidden, os.path.join(src, name))


def test_running_service_with_late_files_stop_and_restart(spark, service, tmp_dir):
    """M1, M6: files come while the service runs and while it is stopped; each line is answered once."""
    from quire.streaming.commands import Progress
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("src", "out", "ck"))
    progress = Progress()
    spark.streams.addListener(progress)
    try:
        _put(src, "a.txt", COMMANDS[:2])
        q = service.start(src, out, ck, interval="500 milliseconds")
        _wait(lambda: len(progress.batches) == 1)
        _put(src, "b.txt", COMMANDS[2:4])           # between two triggers
        _wait(lambda: len(progress.batches) == 2)
        assert q.isActive and q.status["message"]
        q.stop()
        _wait(lambda: len(progress.ended) == 1)
        _put(src, "c.txt", COMMANDS[4:])            # while it is down
        q = service.start(src, out, ck, interval="500 milliseconds")
        _wait(lambda: len(progress.batches) == 3)
        q.processAllAvailable()
        q.stop()
        _wait(lambda: len(progress.ended) == 2)
    finally:
        spark.streams.removeListener(progress)
    assert all(n % 2 == 0 for _, n, _ in progress.batches)  # two lines each, read to number them and to answer
    assert [b for b, *_ in progress.batches] == [0, 1, 2] and progress.ended == [None, None]
    assert all(ms["triggerExecution"] >= ms["addBatch"] > 0 for *_, ms in progress.batches)
    streamed = read_answers(spark, out).collect()
    assert _norm(streamed) == _norm(service.answer_files(src).collect())


def test_author_titles_as_a_plain_stream_after_a_restart(spark, service, tmp_dir):
    """The file sink's log makes the stream equal the batch, whatever was left by a failed batch."""
    from quire.streaming.commands import read_titles, title_stream
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("src", "out", "ck"))
    files = [["author: Ann Lee", "clique: bob ng[1]"], ["", "author:BOB NG", "author: nobody"], ["AUTHOR : ann lee"]]
    for i, lines in enumerate(files[:2]):
        _put(src, f"f{i}.txt", lines)
    q = service.start_titles(src, out, ck, available_now=True, max_files_per_trigger=1)
    q.awaitTermination()
    assert "MicroBatch" in q.lastProgress["sources"][0]["description"] or q.lastProgress["batchId"] >= 1
    spark.range(1).selectExpr("'x' as cmd_file", "1L as cmd_line", "'x' as arg", "id as pub_id", "'x' as title", "1L as year") \
        .coalesce(1).write.parquet(os.path.join(tmp_dir, "stray"))
    stray = [f for f in os.listdir(os.path.join(tmp_dir, "stray")) if f.endswith(".parquet")][0]
    os.rename(os.path.join(tmp_dir, "stray", stray), os.path.join(out, stray))  # not in the sink's log
    _put(src, "f2.txt", files[2])
    service.start_titles(src, out, ck, available_now=True, max_files_per_trigger=1).awaitTermination()
    service.start_titles(src, out, ck, available_now=True).awaitTermination()
    got = sorted(tuple(r) for r in read_titles(spark, out).collect())
    whole = spark.read.text(src, wholetext=True).selectExpr("value", "_metadata.file_path as file")
    assert got == sorted(tuple(r) for r in title_stream(whole, service.index).collect())
    assert [(r[1], r[2], r[3]) for r in got] == [(1, "ann lee", 1), (1, "ann lee", 2), (1, "ann lee", 4), (1, "ann lee", 5),
                                                 (2, "bob ng", 1), (2, "bob ng", 3), (2, "bob ng", 9),
                                                 (1, "ann lee", 1), (1, "ann lee", 2), (1, "ann lee", 4), (1, "ann lee", 5)]


def test_clique_reads_the_rare_names_bucket_only(spark, tmp_dir):
    """A batch's clique command reads the index of its rarest name, not that of the name on every row."""
    from quire.operators.containment import rarest_names
    from quire.streaming.commands import in_buckets
    rows = [(i, f"T{i}.", ["Hot"] + (["Rare"] if i == 7 else []), 2000, "u") for i in range(500)]
    service = CommandService(spark, spark.createDataFrame(
        rows, "pub_id bigint, title string, author array<string>, year bigint, url string"))
    need = spark.createDataFrame([(0, ["hot", "rare"])], "cmd_id bigint, names array<string>")
    asked = rarest_names(need, service.totals)
    assert in_buckets(service.index, asked).count() == 1
    _write_files(os.path.join(tmp_dir, "in"), [["clique: hot, rare[1]", "clique: hot, rare[2]", "clique: hot,nobody[0]"]])
    heads = {r.cmd_line: r.text for r in service.answer_files(os.path.join(tmp_dir, "in")).collect() if r.rank == 0}
    assert heads == {1: "YES", 2: "NO", 3: "YES"}
