"""N-gram Jaccard join (operator 2): a prefix-tree join of globally ordered sets.

A document's set is that of its distinct ``N``-word shingles (hashed; A-Z folded).
Sets are ordered by one global order, rare shingles first: shingles that the
whole corpus shows to be frequent come last, by their count.  Two sets of a
Jaccard similarity of at least ``PERCENT`` % share a shingle among the first
``n - ceil(PERCENT * n / 100) + 1`` of each, so only these *prefixes* are joined.

Equal sets are one node from the start.  Candidates are found in rounds:

1. Within a shingle's group every node is paired with the group's least node (a
   star, linear in the group).  Linked nodes become components.
2. While the groups that still hold several components have many pairs across
   them, each group pairs one node of every component with one of a chosen
   component (linear again); links found merge components.
3. What is left is compared across components, so no link is lost: nodes meet
   the larger components that share enough of their shingles, part by part.

A pair stays a candidate only if the shared part of its prefixes plus all that
lies behind the shorter prefix could reach the required overlap.

Candidates are verified exactly: the partners of a node are stored as a prefix
tree of their ordered sets, and one traversal with the node's set shares the
partial overlap of common beginnings and prunes a subtree once the overlap so
far plus the remaining lengths cannot reach the threshold.

Scale: only prefixes (about 15 % of the shingles, 8-byte hashes) are shuffled;
the frequent list has at most ``HEAVY`` entries, from mergeable per-task counts;
frequent shingles' groups are salted, with a second star over the salts; sets are
fetched for candidates only, by a broadcast of row numbers when their counted
number allows, else by a join.  Links and components stay distributed.

Defined results: null or empty text, or text of blanks, has the empty set and is
linked with nothing; 1 to N-1 words are one shingle; equal sets (also of repeated
rows) are linked; an empty table gives an empty result; a null id is carried
along and names no component unless all ids of it are null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import placed, stored, texts
from quire.llm.components import components
from quire.llm.kernels import FOLDED, U64, blocks, frugal, gram_hashes, mix64, sorted_counts, word_hashes
from quire.session import checked_broadcast

N = 4
PERCENT = 85
HEAVY, HEAVY_TASK, HEAVY_LEAST = 1 << 16, 1 << 13, 32
SALTS = 32
COUNTED = 4  # common shingles that the last round asks of a pair at most
BUNDLE = 512  # sets of a side in a task of the last round
TURNS, TRIES, FEW = 1, 8, 64  # turns of merging at most, choices a turn; pairs a row that are few enough
BROADCAST_ROWS = 1_000_000  # row numbers of 8 bytes
_BUFFER = 1 << 20  # shingles counted at a time


def row_sets(block, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    w, h = word_hashes(block, FOLDED)
    grams, row = gram_hashes(h, w.row, n)
    count = np.bincount(w.row, minlength=block.rows)
    first = np.cumsum(count) - count
    ends = np.cumsum(np.bincount(row, minlength=block.rows))
    out, at = [], 0
    for r in range(block.rows):
        s = grams[at:ends[r]]
        at = int(ends[r])
        if not len(s) and count[r]:  # fewer words than n: the whole sequence, of its own length
            own = h[first[r]:first[r] + count[r]]
            g, _ = gram_hashes(own, np.zeros(len(own), dtype=np.int64), len(own))
            s = mix64(g + U64(len(own)))
        s = np.sort(s)
        out.append(s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) > 1 else s)
    return out


def set_name(s: np.ndarray) -> int:
    """64-bit name of a set."""
    if not len(s):
        return 0
    total = np.add.reduce(mix64(s ^ U64(0x5851F42D4C957F2D)))
    return int(mix64(np.array([total + U64(len(s))], dtype=U64)).view(np.int64)[0])


def _survey(n: int):
    """Rows (place, node, n) of every text, and (token, count) of the task's frequent shingles."""
    def rows(batches):
        heavy = np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
        held, volume = [], 0

        def settle(heavy, held):
            t, c = sorted_counts(np.concatenate(held))
            t, c = t[c > 1], c[c > 1]
            t, c = np.concatenate([heavy[0], t]), np.concatenate([heavy[1], c])
            order = np.argsort(t, kind="stable")
            t, c = t[order], c[order]
            if not len(t):
                return t, c
            head = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            t, c = t[head], np.add.reduceat(c, head)
            if len(t) > HEAVY_TASK:
                keep = np.argpartition(-c, HEAVY_TASK)[:HEAVY_TASK]
                t, c = t[keep], c[keep]
            return t, c

        names = ["place", "node", "n", "token", "count"]
        for batch in batches:
            place = batch.column(0).to_numpy()
            for b in blocks(batch.column(1)):
                sets = row_sets(b, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place[b.first:b.first + b.rows]), pa.array([set_name(s) for s in sets], type=pa.int64()),
                     pa.array([len(s) for s in sets], type=pa.int64()), pa.nulls(b.rows, pa.int64()),
                     pa.nulls(b.rows, pa.int64())], names=names)
                held += sets
                volume += sum(map(len, sets))
                if volume >= _BUFFER:
                    heavy, held, volume = settle(heavy, held), [], 0
        if held:
            heavy = settle(heavy, held)
        k = len(heavy[0])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
             pa.array(heavy[0].view(np.int64)), pa.array(heavy[1])], names=names)
    return rows


class Order:
    """The global order: 64-bit keys whose natural order puts frequent shingles last."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        by_count = np.lexsort((tokens, counts))
        rank = np.empty(len(tokens), dtype=U64)
        rank[by_count] = np.arange(len(tokens), dtype=U64)
        order = np.argsort(tokens)
        self.tokens, self.rank = tokens[order], rank[order]

    def keys(self, s: np.ndarray) -> np.ndarray:
        """The set in the global order; the top bit marks frequent shingles."""
        key = s >> U64(1)
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, s), len(self.tokens) - 1)
            hit = self.tokens[at] == s
            key[hit] = U64(1 << 63) | self.rank[at[hit]] << U64(46) | s[hit] >> U64(18)
        return np.sort(key)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def required(a, b, percent: int):
    """Least overlap of sets of sizes a and b (columns or numbers): ceil(p (a + b) / (100 + p))."""
    return -(-percent * (a + b) // (100 + percent))


def reach(n, at, percent: int):
    """Greatest size of a partner whose first ``COUNTED`` common shingles may lie as far back as place ``at``.

    Sets of sizes n and m need ``required`` common shingles, and behind the k-th
    of them are ``required - k``: it lies at place ``n - required + k - 1`` (from 0)
    of the one set at most, and so in the other. Solved for m, with k = COUNTED.
    """
    return (100 * n - (100 + percent) * np.maximum(at - COUNTED + 1, 0)) // percent


def _prefixes(n: int, percent: int, order: Order):
    def rows(batches):
        done: set[int] = set()  # nodes of this task; at most its rows
        for batch in batches:
            for b in blocks(batch.column(0)):
                keys, nodes, sizes, lengths, reaches = [], [], [], [], []
                for s in row_sets(b, n):
                    name = set_name(s)
                    if not len(s) or name in done:
                        continue
                    done.add(name)
                    k = order.keys(s)[:prefix_length(len(s), percent)]
                    keys.append(k)
                    nodes.append(name)
                    sizes.append(len(s))
                    lengths.append(len(k))
                    reaches.append(reach(len(s), np.arange(len(k)), percent))
                if not keys:
                    continue
                token = np.concatenate(keys)
                node = np.repeat(np.array(nodes, dtype=np.int64), lengths)
                salt = np.where(token >> U64(63) == 1, node.view(np.uint64) % U64(SALTS), U64(0))
                # what differs from row to row stands together, so that shuffled rows compress
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token.view(np.int64)), pa.array(np.concatenate(reaches).astype(np.int32)),
                     pa.array(salt.astype(np.int32)), pa.array(node),
                     pa.array(np.repeat(np.array(sizes, dtype=np.int32), lengths))],
                    names=["token", "reach", "salt", "node", "n"])
    return rows


def similar_sizes(na, nb, percent: int):
    """Column: whether sets of these sizes can link."""
    return (na * 100 >= nb * percent) & (nb * 100 >= na * percent)


def enough(shared, na, nb, percent: int):
    """Column: whether ``shared`` common prefix shingles leave the overlap possible.

    Of common shingles, those within the prefix that ends first are all counted;
    at most what lies behind that prefix is not.
    """
    need = F.ceil((na + nb) * percent / (100 + percent) - 1e-9)
    behind = F.greatest(F.ceil(na * percent / 100 - 1e-9), F.ceil(nb * percent / 100 - 1e-9)) - 1
    return shared + behind >= need


def enough_between(shared, na, lo, hi, percent: int):
    """Column: whether ``enough`` holds for any partner size from ``lo`` to ``hi``.

    What must be shared grows with sizes up to ``na``, so the least size stands for
    those. Beyond, it falls by ``percent ** 2 / (100 * (100 + percent))`` a step but
    for rounding up, which makes up for less than one: it is least within so many
    steps of the greatest size as that takes to reach one.
    """
    steps = -(-100 * (100 + percent) // percent ** 2)
    holds = enough(shared, na, lo, percent)
    for i in range(steps):
        holds = holds | enough(shared, na, F.greatest(lo, hi - i), percent)
    return holds


def candidate_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct ``(a, b)`` of rows ``(a, na, b, nb)``, one row a shared prefix shingle."""
    na, nb = F.col("na"), F.col("nb")
    return pairs.where(similar_sizes(na, nb, percent)).groupBy("a", "na", "b", "nb") \
        .agg(F.count(F.lit(1)).alias("shared")).where(enough(F.col("shared"), na, nb, percent)) \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def pairings(open_: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """``(a, na, component, lo, hi)``: a node's shingle that a component with possible partners of it holds too.

    Nodes are matched with whole components (only with larger ones, ties by
    name): one row a node, shingle and component, not one a pair. A shingle counts
    only where it may be among a pair's first ``COUNTED`` common ones: in the first
    half of the prefixes or so for like sizes, further back the less the sizes are
    alike. So the ends of the prefixes, whose shingles have the largest groups,
    make no rows.
    """
    if "reach" not in open_.columns:  # places unknown: as far as the sizes allow
        open_ = open_.withColumn("reach", F.floor(F.col("n") * 100 / percent + 1e-9))
    sizes = label.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    rows = open_.join(checked_broadcast(sizes, BROADCAST_ROWS), "component", "left") \
        .withColumn("size", F.coalesce("size", F.lit(1)))
    groups = rows.groupBy("token", "component", "size").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("reach").alias("reach"))
    y, c = rows.alias("y"), groups.alias("c")
    smaller = (F.col("y.size") < F.col("c.size")) \
        | ((F.col("y.size") == F.col("c.size")) & (F.col("y.component") < F.col("c.component")))
    fits = (F.col("y.reach") >= F.col("c.lo")) & (F.col("c.reach") >= F.col("y.n"))
    return y.join(c, (F.col("y.token") == F.col("c.token")) & smaller & fits).select(
        F.col("y.node").alias("a"), F.col("y.n").alias("na"), F.col("c.component").alias("component"), "c.lo", "c.hi")


def meetings(open_: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """``(a, component)``: nodes and other components that could hold a partner of theirs.

    Counts how many of a node's shingles pair it with the component. A component
    whose members could not reach the overlap with that many drops out; with
    ``COUNTED`` of them it stays, as those further back were not counted.
    """
    met = pairings(open_, label, percent).groupBy("a", "na", "component") \
        .agg(F.count(F.lit(1)).alias("shared"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    na = F.col("na")
    lo = F.greatest(F.col("lo"), F.ceil(na * percent / 100 - 1e-9))
    hi = F.least(F.col("hi"), F.floor(na * 100 / percent + 1e-9))
    met = met.where((F.col("shared") >= COUNTED) | enough_between(F.col("shared"), na, lo, hi, percent))
    return stored(met.select("a", "component"))


def with_hubs(rows: DataFrame, group: list[str]) -> DataFrame:
    """``rows`` with the least node (and its size) and the number of nodes of their group."""
    w = Window.partitionBy(*group)
    return rows.withColumn("hub", F.min(F.struct("node", "n")).over(w)).withColumn("size", F.count(F.lit(1)).over(w))


def open_rows(shared: DataFrame, label: DataFrame) -> DataFrame:
    """``(token, node, n, reach, component)`` of the shingles that several components share."""
    labelled = shared.select("token", "node", "n", "reach").join(checked_broadcast(label, BROADCAST_ROWS), "node", "left") \
        .select("token", "node", "n", "reach", F.coalesce("component", "node").alias("component"))
    several = labelled.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .where("lo <> hi").select("token")
    return labelled.join(several, "token", "left_semi")


def crossings(open_: DataFrame) -> dict:
    """How many rows are open, and how many pairs across components they have."""
    sizes = open_.groupBy("token", "component").agg(F.count(F.lit(1)).cast("double").alias("m"))
    tokens = sizes.groupBy("token").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("own"))
    total = tokens.agg(F.sum("m").alias("rows"), F.sum((F.col("m") * F.col("m") - F.col("own")) / 2).alias("pairs"))
    return {k: v or 0.0 for k, v in total.first().asDict().items()}


def proposals(open_: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b): in a group, a node of each component with one of a chosen component.

    ``TRIES`` such choices are made by hashes that change with the turn, in every
    ``TRIES``-th group: linear in the groups' components.  What they miss, later
    turns or the last step find.
    """
    some = open_.where(F.pmod(F.xxhash64("token", F.lit(turn)), F.lit(TRIES)) == 0)
    seeds = [turn * TRIES + i for i in range(TRIES)]
    nodes = F.array(*[F.min(F.struct(F.xxhash64("node", F.lit(s)).alias("by"), "node", "n")) for s in seeds])
    ones = stored(some.groupBy("token", "component").agg(nodes.alias("picks")))
    leads = F.array(*[F.min(F.struct(F.xxhash64("component", F.lit(s)).alias("by"), F.col("picks")[i].alias("one")))
                      for i, s in enumerate(seeds)])
    lead = ones.groupBy("token").agg(leads.alias("leads"))
    pairs = ones.join(lead, "token").select(F.explode(F.zip_with(
        "picks", "leads", lambda x, y: F.struct(x.alias("x"), y["one"].alias("y")))).alias("p")).select("p.*")
    return pairs.where((F.col("x.node") != F.col("y.node")) & similar_sizes(F.col("x.n"), F.col("y.n"), percent)) \
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs ``(a, b)`` whose sets link, each pair by a prefix-tree traversal."""
    left = sets.select(F.col("node").alias("a"), F.col("keys").alias("a_keys"))
    right = sets.select(F.col("node").alias("b"), F.col("keys").alias("b_keys"))

    def rows(batches):
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cut = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1], [True])))
            keep = np.zeros(len(a), dtype=bool)
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                probe = np.frombuffer(batch.column(2)[x].as_py(), dtype=">u8").astype(U64)
                partners = [v.as_py() for v in batch.column(3).slice(x, y - x)]
                for i in tree_links(probe, partners, percent):
                    keep[x + i] = True
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return pairs.join(right, "b").join(left, "a").select("a", "b", "a_keys", "b_keys") \
        .mapInArrow(frugal(rows), "a bigint, b bigint").distinct()


def _parts(rows: DataFrame, name: str) -> DataFrame:
    """``(component, name)``: into how many parts of BUNDLE rows a component's rows go."""
    return rows.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BUNDLE).cast("int").alias(name))


def across(met: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between the nodes of ``met`` and the members of the components met.

    Both sides are dealt into parts of about BUNDLE sets and every two parts of a
    component meet in one task, where the members stand in a prefix tree that each
    node's set traverses. Only links leave the task.
    """
    size = _parts(members, "m_parts").join(_parts(met, "p_parts"), "component")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = sets.select("node", "keys")
    left = met.join(size, "component").join(keys.withColumnRenamed("node", "a"), "a") \
        .select(F.col("component").alias("component"), every("m_parts").alias("m"),
                F.pmod(F.xxhash64("a"), F.col("p_parts")).cast("int").alias("p"), F.col("a").alias("probe"),
                F.col("keys").alias("probe_keys"))
    right = members.join(size, "component").join(keys.withColumnRenamed("node", "b"), "b") \
        .select(F.col("component").alias("component"), F.pmod(F.xxhash64("b"), F.col("m_parts")).cast("int").alias("m"),
                every("p_parts").alias("p"), F.col("b").alias("member"), F.col("keys").alias("member_keys"))

    def meet(_key, probes: pa.Table, partners: pa.Table) -> pa.Table:
        bodies = partners["member_keys"].to_pylist()
        names = partners["member"].to_pylist()
        a, b = [], []
        for probe, own in zip(probes["probe"].to_pylist(), probes["probe_keys"].to_pylist(), strict=True) if bodies else ():
            found = tree_links(np.frombuffer(own, dtype=">u8").astype(U64), bodies, percent)
            a += [probe] * len(found)
            b += [names[i] for i in found]
        return pa.table({"a": pa.array(a, type=pa.int64()), "b": pa.array(b, type=pa.int64())})

    by = ["component", "m", "p"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(meet, "a bigint, b bigint")


def tree_links(probe: np.ndarray, partners: list[bytes], percent: int) -> list[int]:
    """Indices of the partners that link with ``probe``.

    Partners are big-endian ordered sets.  Sorted, neighbours' common beginnings
    are the paths of the prefix tree: ``overlap[d]`` of the current path is kept
    and only the part behind the branching point is looked up.  ``dead`` is the
    least depth at which the current path was found hopeless for every length in
    the tree; partners that branch off below it are skipped with their subtree.
    """
    size = np.array([len(p) // 8 for p in partners])
    shortest, longest = int(size.min()), int(size.max())
    floor = required(len(probe), shortest, percent)
    found, path, overlap, passed, dead = [], np.zeros(0, dtype=U64), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64), None
    for i in sorted(range(len(partners)), key=partners.__getitem__):
        s = np.frombuffer(partners[i], dtype=">u8").astype(U64)
        m = min(len(s), len(path))
        differ = np.flatnonzero(s[:m] != path[:m])
        branch = int(differ[0]) if len(differ) else m
        if dead is not None and branch >= dead:
            continue
        rest = s[branch:]
        at = np.searchsorted(probe, rest)
        member = np.zeros(len(rest), dtype=np.int64)
        inside = at < len(probe)
        member[inside] = probe[at[inside]] == rest[inside]
        overlap = np.concatenate((overlap[:branch + 1], overlap[branch] + np.cumsum(member)))
        passed = np.concatenate((passed[:branch + 1], at + member))
        path = s
        # what the deepest path through each depth could still reach
        reach = overlap + np.minimum(longest - np.arange(len(s) + 1), len(probe) - passed)
        hopeless = np.flatnonzero(reach < floor)
        dead = int(hopeless[0]) if len(hopeless) else None
        if overlap[-1] >= required(len(probe), len(s), percent):
            found.append(i)
    return found


def link(docs: DataFrame, n: int = N, percent: int = PERCENT, id_col: str = "doc_id",
         text_col: str = "text", place_col: str | None = None) -> DataFrame:
    """``(doc_id, place, n_shingles, node, component, component_id)`` of every row of ``docs``.

    ``node`` names the row's set and ``component`` is the least node linked with it.
    ``place`` is the row's number: ``place_col``, as ``placed`` gives it, or one made here.
    """
    if place_col is None:
        docs, place_col = placed(docs, "_jaccard_place"), "_jaccard_place"
    slim = texts(docs, id_col, text_col, place=place_col)
    surveyed = stored(slim.select("place", "text").mapInArrow(
        frugal(_survey(n)), "place bigint, node bigint, n bigint, token bigint, count bigint"))
    heavy = surveyed.where("token is not null").groupBy("token").agg(F.sum("count").alias("count")) \
        .where(F.col("count") >= HEAVY_LEAST).orderBy(F.desc("count"), "token").limit(HEAVY).collect()
    order = Order(np.array([r["token"] for r in heavy], dtype=np.int64).view(U64),
                  np.array([r["count"] for r in heavy], dtype=np.int64))
    nodes = surveyed.where("place is not null").select("place", "node", "n")
    chosen = nodes.where("n > 0").groupBy("node").agg(F.min("place").alias("place"))

    def sets_of(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = stored(wanted.join(chosen, "node"))

        def rows(batches):
            for batch in batches:
                for b in blocks(batch.column(1)):
                    keys = [order.keys(s).astype(">u8").tobytes() for s in row_sets(b, n)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(b.first, b.rows), pa.array(keys, type=pa.binary())],
                        names=["node", "keys"])

        picked = slim.select("place", "text").join(checked_broadcast(wanted, BROADCAST_ROWS), "place")
        return picked.select("node", "text").mapInArrow(frugal(rows), "node bigint, keys binary")

    prefixes = slim.select("text").mapInArrow(
        frugal(_prefixes(n, percent, order)), "token bigint, reach int, salt int, node bigint, n int")
    # the tasks' copies of a node meet in its shingles' groups
    once = prefixes.repartition("token", "salt").dropDuplicates(["token", "salt", "node"])
    seen = with_hubs(once, ["token", "salt"])
    shared = stored(seen.where((F.col("size") > 1) | (F.col("token") < 0)).select("token", "salt", "node", "n", "reach", "hub"))
    hubs = shared.where("token < 0").groupBy("token", "salt").agg(F.min("hub").alias("hub"))
    tops = hubs.groupBy("token").agg(F.min("hub").alias("top"))
    pairs = shared.select(F.col("hub.node").alias("a"), F.col("hub.n").alias("na"), F.col("node").alias("b"),
                          F.col("n").alias("nb")).unionByName(
        hubs.join(tops, "token").select(F.col("top.node").alias("a"), F.col("top.n").alias("na"),
                                        F.col("hub.node").alias("b"), F.col("hub.n").alias("nb"))).where("a <> b")
    first = stored(candidate_pairs(pairs, percent))
    links = stored(verify(first, stored(sets_of(first)), percent))
    label = stored(components(links))

    tested = first
    for turn in range(TURNS):
        open_ = stored(open_rows(shared, label))
        cost = crossings(open_)
        if cost["pairs"] <= FEW * cost["rows"]:
            break
        # many pairs across components: first try one pair a group and component, and merge
        tried = stored(proposals(open_, turn, percent).join(tested, ["a", "b"], "left_anti"))
        tested = tested.unionByName(tried)
        new = stored(verify(tried, stored(sets_of(tried)), percent))
        if new.isEmpty():
            break
        links = stored(links.unionByName(new))
        label = stored(components(links))
    else:
        open_ = stored(open_rows(shared, label))
    met = meetings(open_, label, percent)
    if not met.isEmpty():
        members = open_.select("component", F.col("node").alias("b")).distinct() \
            .join(met.select("component").distinct(), "component", "left_semi")
        held = stored(sets_of(met.select("a", F.col("a").alias("b")).unionByName(members.select(F.col("b").alias("a"), "b"))))
        links = stored(links.unionByName(across(met, members, held, percent)))
        label = stored(components(links))

    rows = nodes.join(checked_broadcast(label, BROADCAST_ROWS), "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = slim.select("doc_id", "place").join(rows, "place")
    least = named.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    return named.join(least, "component", "left").select(
        "doc_id", "place", F.col("n").alias("n_shingles"), "node", "component",
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (nulls last)."""
    numbered = placed(docs, "_jaccard_place")
    found = link(numbered, n, percent, place_col="_jaccard_place")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")
    linked = found.where("n_shingles > 0").select("place", "doc_id", "node", "component")
    kept = linked.groupBy("component").agg(F.min(first).alias("first")).select(F.col("first.place").alias("place"))
    gone = stored(linked.select("place").join(kept, "place", "left_anti"))
    gone = checked_broadcast(gone.withColumnRenamed("place", "_jaccard_place"), BROADCAST_ROWS)
    return numbered.join(gone, "_jaccard_place", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def oracle(n: int = N, percent: int = PERCENT) -> str:
    """DuckDB SQL by counting the shingles that every two documents share; for ids that are not repeated."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + {n - 1}], ' ') FOR i IN range(1, greatest(len(w) - {n - 1}, 1) + 1)]) AS s
  FROM w WHERE len(w) > 0
), z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT p.a, p.b FROM p JOIN z x ON x.doc_id = p.a JOIN z y ON y.doc_id = p.b
  WHERE 100 * inter >= {percent} * (x.n + y.n - inter)
), r AS (
  SELECT a AS doc_id, a AS root FROM l UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id
), c AS (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, coalesce(c.root, d.doc_id) AS component_id
FROM documents d LEFT JOIN z ON z.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
"""
