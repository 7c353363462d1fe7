import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from quire.session import clear_scratch, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    clear_scratch(s)
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="quire-test-")


# Fixture of FIXTURES.md part 2: (pub_id, title, author, year, url).
PUBLICATIONS = [
    (1, "Query Processing on Graphs.", ["Ann Lee", "Bob Ng"], 2003, "db/journals/pvldb/a.html"),
    (2, "Graphs  and Streams.", ["Ann Lee", "ann lee", "Cy Roe"], 2001, "db/conf/sigmod/b.html"),
    (3, "Why Graphs?", ["Bob Ng", "Cy Roe", "Dee Poe"], 2010, "db/conf/icde/c.html"),
    (4, "Old Data.", ["Ann Lee"], 1999, "db/conf/sigmod/d.html"),
    (5, "Other Venue.", ["Ann Lee", "Dee Poe"], 2005, "db/conf/other/e.html"),
    (6, None, ["Ann Lee"], 2005, "db/journals/pvldb/f.html"),
    (7, "No Authors.", None, 2006, "db/journals/pvldb/g.html"),
    (8, "No Year.", ["Bob Ng"], None, "db/journals/pvldb/h.html"),
    (9, "Ends blank .", ["Bob Ng", "Bob Ng"], 2003, "db/conf/icde/i.html"),
]
PUB_SCHEMA = "pub_id bigint, title string, author array<string>, year bigint, url string"


@pytest.fixture()
def pubs(spark):
    return spark.createDataFrame(PUBLICATIONS, PUB_SCHEMA)
