"""N-gram Jaccard join by T-occurrence search over inverted lists.

Documents are sets of word shingles; two link when their sets share enough of their union. Equal sets
are folded first. The join has three steps.

*Lists.* Shingles are ordered, rare ones before frequent ones, and only a prefix of each set is listed:
similar sets always share a shingle of their prefixes. Any order is right; a sample names the very
frequent shingles, and sets whose prefix still holds one of more than ``HOT`` sets are ordered again.
Of lists with the same members one is kept. Sets that meet in a list are compared by size and by the
counts of their shingles in classes whose number grows with the set; these bound their overlap from
above. What may still be similar is joined into groups, so every link lies inside a group. A list of
more than ``LIST`` sets joins all of them unseen: groups may be too large, never too small.

*Division.* Groups above ``PIECE`` sets first drop what is linked to one central member. All groups are
cut into pieces whose members are compared by the same counts. This divides the groups anew.

*Search.* Only now are the sets of the remaining groups brought together, with an inverted list per
shingle. For each set the short lists are merged by a heap and the long ones, as many as DivideSkip
allows, only probed by binary search for what the short ones leave: T occurrences less the number of
long lists. Members that are linked already are left out. A task returns links that connect, never all
pairs.
"""

from __future__ import annotations

import heapq
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.components import connected
from riskframe.llm.simhash import Forest, hashes_of
from riskframe.session import arrow_batches, materialise, shuffle_width

#: Sets whose prefixes hold a shingle, above which it counts as frequent.
HOT = 512
#: Sets of one list that are compared with each other; more are joined to one group.
LIST = 1024
#: Sets of one group that one task compares; of more, those unlike a central one are compared in pieces.
PIECE = 128
#: Documents that are sampled, and shingles that are named at most, to put frequent shingles last.
SAMPLE, NAMED = 4_096, 50_000
#: Names of sets (24 bytes each) that are broadcast to fetch their texts; more are joined by a shuffle.
FETCHED = 500_000
#: Bytes of rows that go to Python at once, and of those that a task gathers beyond its open group.
BATCH, HELD = 1 << 20, 1 << 23
CLASSES = 64
#: DivideSkip: long lists are T / (MU * log2(longest list) + 1).
MU = 0.01

SKETCH = "k {key}, h1 long, h2 long, digest binary, n long, prefix array<long>, classes array<smallint>, fine array<smallint>"
LINKS = "u long, v long"
_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def shingles_of(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted signed hashes."""
    return np.unique(hashes_of(text, width).view(np.int64))


def prefix_size(n, percent: int):
    """Shingles of a set of ``n`` of which a similar set holds one at least."""
    return n - -(-percent * n // 100) + 1


def prefix_of(shingles: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set, frequent ones (sorted) last."""
    at = np.minimum(np.searchsorted(frequent, shingles), max(0, len(frequent) - 1))
    last = frequent[at] == shingles if len(frequent) else np.zeros(len(shingles), bool)
    ordered = np.r_[shingles[~last], shingles[last]]
    return ordered[: prefix_size(len(shingles), percent)] if len(shingles) else ordered


def fine_classes(n):
    """Number of classes, a power of two, that tells sets of ``n`` shingles apart: 8 to 16 in each."""
    return max(CLASSES, 1 << (max(1, int(n)) // 16).bit_length())


def counts_of(shingles: np.ndarray, classes: int) -> np.ndarray:
    """Shingles in each class; at the ceiling the bound on the overlap only becomes weaker."""
    return np.minimum(np.bincount(shingles & (classes - 1), minlength=classes), 32767).astype(np.int16)


def _sketches(batches, width: int, percent: int, frequent: np.ndarray):
    import xxhash

    shorts, longs = pa.list_(pa.int16()), pa.list_(pa.int64())
    for b in batches:
        sets = [shingles_of(t, width) for t in b.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                *b.columns[:3],
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([prefix_of(s, frequent, percent) for s in sets], longs),
                pa.array([counts_of(s, CLASSES) for s in sets], shorts),
                pa.array([counts_of(s, fine_classes(len(s))) for s in sets], shorts),
            ],
            ["k", "h1", "h2", "digest", "n", "prefix", "classes", "fine"],
        )


def _sets(batches, width: int):
    for b in batches:
        sets = pa.array([shingles_of(t, width) for t in b.column(1).to_pylist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([b.column(0), sets], ["id", "shingles"])


def _whole_keys(batches, keys: list[str], rows: int):
    """Tables of whole groups from batches sorted by ``keys``; the last, open group is carried on.

    A table ends with the first whole group after ``rows`` rows or ``HELD`` bytes.
    """
    held = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < rows and sum(b.nbytes for b in held) < HELD:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        ends = [t[c].to_numpy() for c in keys]
        other = np.flatnonzero(np.logical_or.reduce([e != e[-1] for e in ends]))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield t.slice(0, cut)
        held = t.slice(cut).to_batches()
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks()


def _links(u, v) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=_LINKS)


# -- groups --------------------------------------------------------------------------------------


def _may_link(n_a, n_b, counts_a, counts_b, percent: int):
    """Whether the overlap that the counts in equal classes allow is enough."""
    least = -(-percent * (n_a + n_b) // (100 + percent))
    apart = np.abs(counts_a.astype(np.int32) - counts_b).sum(1)
    return n_a + n_b - apart >= 2 * least


class Levels:
    """Counts in classes of rows of different widths, each pair compared in the classes of its smaller set."""

    def __init__(self, counts: pa.ListArray):
        ends, values = counts.offsets.to_numpy(), counts.values.to_numpy()
        self.width, self.at, self.tables = np.diff(ends), {}, {}
        for width in np.unique(self.width).tolist():
            same, wider = np.flatnonzero(self.width == width), np.flatnonzero(self.width == 2 * width)
            own = values[ends[same][:, None] + np.arange(width)].astype(np.int32)
            folded = values[ends[wider][:, None] + np.arange(2 * width)].reshape(-1, 2, width).sum(1, dtype=np.int32)
            self.tables[width] = np.concatenate([own, folded])
            self.at[width] = np.full(len(self.width), -1)
            self.at[width][np.r_[same, wider]] = np.arange(len(same) + len(wider))

    def may_link(self, a: np.ndarray, b: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
        """For rows a with rows b of sets as large or a little larger."""
        out = np.zeros(len(a), bool)
        for width in np.unique(self.width[a]).tolist():
            here = np.flatnonzero(self.width[a] == width)
            step = max(1, (1 << 21) // width)
            for part in np.split(here, range(step, len(here), step)):
                x, y, at, table = a[part], b[part], self.at[width], self.tables[width]
                out[part] = _may_link(n[x], n[y], table[at[x]], table[at[y]], percent)
        return out


def _met(batches, percent: int):
    """Rows (token, id, n, fine) sorted by token and n -> links between sets that may be similar."""
    for t in _whole_keys(batches, ["token"], 8_000):
        token, ids, n = (t[c].to_numpy() for c in ("token", "id", "n"))
        levels = Levels(pa.concat_arrays([*t["fine"].chunks, t["fine"].chunk(0).slice(0, 0)]))
        nodes, at = np.unique(ids, return_inverse=True)
        forest, rows, offset = Forest(len(nodes)), np.arange(len(ids)), 0
        while len(rows):
            offset += 1
            rows = rows[rows + offset < len(ids)]
            other = rows + offset
            rows = rows[(token[rows] == token[other]) & (100 * n[rows] >= percent * n[other])]
            near = rows[levels.may_link(rows, rows + offset, n, percent)]
            forest.link(at[near], at[near + offset])
        u, v = forest.edges()
        yield _links(nodes[u], nodes[v])


def refined(n: np.ndarray, classes: list, asked: np.ndarray, percent: int):
    """Spanning links (index, index) of sets that may be similar, of pairs with one asked for at least."""
    order = np.argsort(n, kind="stable")
    n, asked, classes = n[order], asked[order], [classes[i] for i in order]
    forest, low, high = Forest(len(n)), np.searchsorted(100 * n, percent * n), np.searchsorted(percent * n, 100 * n, "right")
    folded: dict[int, dict[int, np.ndarray]] = {}
    for i in np.flatnonzero(asked).tolist():
        width = fine_classes(n[low[i]])
        at = folded.setdefault(width, {})
        window = np.arange(low[i], high[i])
        for j in window.tolist():
            if j not in at:
                at[j] = classes[j].reshape(-1, width).sum(0, dtype=np.int32)
        rows = np.stack([at[j] for j in window.tolist()])
        near = window[_may_link(n[window], n[i], rows, at[i][None], percent)]
        forest.link(near, np.full(len(near), i))
    u, v = forest.edges()
    return order[u], order[v]


def _refined(batches, keys: list[str], percent: int):
    """Rows (keys, id, n, fine, asked) sorted by keys -> links between sets that may be similar."""
    for t, lo, hi in _groups(batches, keys):
        ids, n, asked = (t[c].slice(lo, hi - lo).to_numpy() for c in ("id", "n", "asked"))
        classes = [np.asarray(c.values) for c in t["fine"].slice(lo, hi - lo)]
        u, v = refined(n, classes, asked, percent)
        yield _links(ids[u], ids[v])


def _near_centre(batches, percent: int):
    """(root, id, h1, h2) of the rows whose set may be similar to that of their centre."""
    for b in batches:
        wanted = []
        for n, fine, m, other in zip(*(b.column(c).to_pylist() for c in ("n", "fine", "centre_n", "centre_fine"))):
            width = min(len(fine), len(other))
            x, y = (np.array(v).reshape(-1, width).sum(0)[None] for v in (fine, other))
            wanted.append(bool(_may_link(n, m, x, y, percent)[0]))
        rows = pa.RecordBatch.from_arrays([b.column(c) for c in ("root", "id", "h1", "h2")], ["root", "id", "h1", "h2"])
        yield rows.filter(pa.array(wanted, pa.bool_()))


# -- search --------------------------------------------------------------------------------------


def merged(lists: list, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Heap merge of sorted lists: the members of at least ``least`` of them, and of how many."""
    runs = ((member, sum(1 for _ in run)) for member, run in groupby(heapq.merge(*lists)))
    found = [r for r in runs if r[1] >= least]
    return np.array([r[0] for r in found], np.int64), np.array([r[1] for r in found], np.int64)


def search(sizes: np.ndarray, shingles: np.ndarray, percent: int, asked: np.ndarray | None = None):
    """Spanning links (index, index) of the similar sets among ``shingles``, given one after another.

    With ``asked``, only pairs of which one at least is asked for.
    """
    m = len(sizes)
    forest = Forest(m)
    starts = np.r_[0, np.cumsum(sizes)]
    order = np.argsort(sizes, kind="stable")  # documents are renamed by size
    n = sizes[order]
    asked = np.ones(m, bool) if asked is None else asked[order]
    token = np.unique(shingles, return_inverse=True)[1] if len(shingles) else shingles
    name = np.empty(m, np.int64)
    name[order] = np.arange(m)
    post = np.sort(token * m + np.repeat(name, sizes))  # all inverted lists, one after another
    low = np.searchsorted(100 * n, percent * n)  # first document that is large enough
    for i in range(1, m):
        need, lo = -(-percent * n[i] // 100), low[i]
        if lo >= i or not n[i] or not (asked[i] or asked[lo:i].any()):
            continue
        own = token[starts[order[i]] : starts[order[i]] + n[i]]
        begin, end = np.searchsorted(post, own * m + lo), np.searchsorted(post, own * m + i)
        own, begin, end = own[end > begin], begin[end > begin], end[end > begin]
        if len(own) < need:
            continue
        length = end - begin
        which = np.repeat(np.arange(len(own)), length)
        member = post[np.arange(len(which)) - np.repeat(np.cumsum(length) - length, length) + begin[which]] % m
        root = forest.find(np.arange(m))
        open_ = (root[member] != root[i]) & (asked[i] | asked[member])
        which, member = which[open_], member[open_]
        length = np.bincount(which, minlength=len(own))
        by_length = np.argsort(length, kind="stable")[(length == 0).sum() :]
        if len(by_length) < need:
            continue
        long = min(need - 1, int(need / (MU * np.log2(max(2, length.max())) + 1)))
        short, probed = by_length[: len(by_length) - long], by_length[len(by_length) - long :]
        cuts = np.r_[0, np.cumsum(length)].tolist()
        members = member.tolist()
        found, count = merged([members[cuts[s] : cuts[s + 1]] for s in short.tolist()], need - long)
        for j, c in zip(found.tolist(), count.tolist()):
            if np.ptp(forest.find(np.array([j, i]))):
                keys = own[probed] * m + j
                at = np.minimum(np.searchsorted(post, keys), len(post) - 1)
                shared = c + int((post[at] == keys).sum())
                if 100 * shared >= percent * (n[i] + n[j] - shared):
                    forest.link(np.array([i]), np.array([j]))
    u, v = forest.edges()
    return order[u], order[v]


def _groups(batches, keys: list[str]):
    """(table, first row, end) of each group of more than one row."""
    for t in _whole_keys(batches, keys, 2_000):
        ends = [t[c].to_numpy() for c in keys]
        new = np.flatnonzero(np.logical_or.reduce([e[1:] != e[:-1] for e in ends])) + 1
        for lo, hi in zip(np.r_[0, new].tolist(), np.r_[new, t.num_rows].tolist()):
            if hi - lo > 1:
                yield t, lo, hi


def _searched(batches, keys: list[str], percent: int):
    """Rows (keys, id, n, shingles, asked) sorted by keys -> links of each group."""
    for t, lo, hi in _groups(batches, keys):
        ids, n, asked = (t[c].slice(lo, hi - lo).to_numpy() for c in ("id", "n", "asked"))
        sets = t["shingles"].slice(lo, hi - lo).combine_chunks()
        u, v = search(n, sets.flatten().to_numpy(), percent, asked)
        yield _links(ids[u], ids[v])


# -- the join in Spark -----------------------------------------------------------------------------


class JaccardJoin:
    """Links documents whose sets of ``width``-word shingles share ``percent`` of their union."""

    def __init__(self, width: int = 4, percent: int = 85):
        self.width, self.percent = width, percent

    def components(self, documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """(key, n_shingles, component_id) per row: the smallest key that links reach.

        A missing or empty text has no shingles and is linked with nothing: its component is its own
        key. Equal sets link at once. Repeated rows come back as often as they occur; a missing key
        stays missing and names no component unless no row of it has a key. Empty tables give empty
        results; further columns are ignored. Shingles are compared by 64-bit hashes.
        """
        with arrow_batches(documents.sparkSession, BATCH):
            return self._components(documents, key, text)

    def _components(self, documents: DataFrame, key: str, text: str) -> DataFrame:
        # a text is known again by two hashes, so that no copy of the texts is written
        texts = documents.select(F.col(key).alias("k"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"), F.col(text).alias("t"))
        width, percent, frequent = self.width, self.percent, self.frequent(texts)
        schema = SKETCH.format(key=dict(texts.dtypes)["k"])
        sketched = texts.mapInArrow(lambda bs: _sketches(bs, width, percent, frequent), schema)
        sketches = materialise(sketched.withColumn("row", F.monotonically_increasing_id()), "sketches")
        whole = sketches.where("n > 0")
        first = whole.groupBy("digest").agg(F.min("row").alias("id"), F.min("k").alias("first"))
        first = materialise(first, "first-of-equal-sets")
        folded = whole.select(F.col("row").alias("id"), "h1", "h2", "n", "classes", "fine", "prefix").join(first.select("id"), "id", "left_semi")
        folded = materialise(folded, "folded")
        roots = connected(self.links(folded, texts, frequent), "stars")
        rooted = first.join(roots.toDF("id", "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
        labels = rooted.select("digest", "root").join(names, "root").select("digest", "component_id")
        found = whole.select("k", "n", "digest").join(labels, "digest").select("k", "n", "component_id")
        empty = sketches.where("n = 0").select("k", "n", F.col("k").alias("component_id"))
        return found.unionByName(empty).select(F.col("k").alias(key), F.col("n").alias("n_shingles"), "component_id")

    def frequent(self, texts: DataFrame) -> np.ndarray:
        """The most frequent shingles of a sample, sorted; ``NAMED`` at most. A guess that only speeds up."""
        known = texts.where("t is not null")
        edge = known.select("h1").distinct().orderBy("h1").limit(SAMPLE).agg(F.max("h1")).first()[0]
        if edge is None:
            return np.zeros(0, np.int64)
        drawn = known.where(F.col("h1") <= edge).groupBy("h1").agg(F.first("t").alias("t"))
        width = self.width
        each = drawn.mapInArrow(lambda bs: _sets(bs, width), "id long, shingles array<long>")
        counted = each.select(F.explode("shingles").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("sets"))
        named = counted.where("sets >= 4").orderBy(F.desc("sets"), "token").limit(NAMED).select("token").collect()
        return np.sort(np.array([r.token for r in named], np.int64))

    def sets(self, ids: DataFrame, texts: DataFrame) -> DataFrame:
        """(id, shingles) for the written rows (id, h1, h2); up to ``FETCHED`` of them go to the texts."""
        width, ids = self.width, ids.select("id", "h1", "h2")
        found = texts.select("h1", "h2", "t").join(F.broadcast(ids) if ids.count() <= FETCHED else ids, ["h1", "h2"])
        return found.groupBy("id").agg(F.first("t").alias("t")).mapInArrow(lambda bs: _sets(bs, width), "id long, shingles array<long>")

    def links(self, folded: DataFrame, texts: DataFrame, frequent: np.ndarray) -> DataFrame:
        """(u, v) between ids of ``folded``: links that connect all similar sets."""
        members = self.groups(folded, texts, frequent).join(folded.select("id", "h1", "h2", "n", "classes", "fine"), "id")
        members = materialise(members, "members")
        star, members = self._star(members, texts)
        near = materialise(self._crossed(members, "fine", _refined), "may-link-finely")
        found = materialise(self._groups_of(near).join(members.drop("root", "fine"), "id"), "divided")
        sets = materialise(self.sets(found, texts).join(found.select("id", "root", "n", "asked"), "id"), "sets")
        return materialise(self._crossed(sets, "shingles", _searched).unionByName(star), "links")

    def prefixes(self, folded: DataFrame, texts: DataFrame, frequent: np.ndarray) -> DataFrame:
        """(token, id): the prefix of each set, rare shingles before frequent ones."""
        listed = folded.select("id", F.explode("prefix").alias("token"))
        hot = materialise(listed.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where(F.col("sets") > HOT).select("token"), "frequent")
        if hot.isEmpty():
            return listed
        again = materialise(listed.join(hot, "token", "left_semi").select("id").distinct(), "to-order-again")
        named = folded.sparkSession.createDataFrame(pa.table({"token": frequent}))  # NAMED at most
        last = materialise(named.unionByName(hot).distinct().withColumn("last", F.lit(True)), "last")
        open_ = materialise(folded.select("id", "h1", "h2").join(again, "id", "left_semi"), "open")
        each = self.sets(open_, texts).select("id", F.explode("shingles").alias("token")).join(last, "token", "left")
        order = F.sort_array(F.collect_list(F.struct(F.coalesce("last", F.lit(False)).alias("last"), F.col("token").alias("token"))))
        n = F.size("o")
        p = (n - F.floor((self.percent * n + 99) / 100) + 1).cast("int")  # prefix_size
        ordered = each.groupBy("id").agg(order.alias("o")).select("id", F.explode(F.slice(F.col("o.token"), F.lit(1), p)).alias("token"))
        return listed.join(again, "id", "left_anti").select("id", "token").unionByName(ordered)

    def groups(self, folded: DataFrame, texts: DataFrame, frequent: np.ndarray) -> DataFrame:
        """(id, root) of all sets in groups of more than one."""
        percent = self.percent
        listed = self.prefixes(folded, texts, frequent)
        members = [F.bit_xor(F.xxhash64(F.lit(i), "id")).alias(f"x{i}") for i in (1, 2)]
        lists = listed.groupBy("token").agg(F.count(F.lit(1)).alias("sets"), F.min("id").alias("least"), *members)
        different = lists.where("sets > 1").groupBy("sets", "least", "x1", "x2").agg(F.min("token").alias("token"))
        lists = materialise(different.select("token", "sets", "least"), "lists")
        shared = materialise(listed.join(lists, "token"), "shared")
        unseen = shared.where((F.col("sets") > LIST) & (F.col("id") != F.col("least"))).select(F.col("id").alias("u"), F.col("least").alias("v"))
        compared = (
            shared.where(F.col("sets") <= LIST).select("token", "id").join(folded.select("id", "n", "fine"), "id")
            .repartition(shuffle_width(folded.sparkSession), "token").sortWithinPartitions("token", "n")
            .select("token", "id", "n", "fine").mapInArrow(lambda bs: _met(bs, percent), LINKS)
        )
        return self._groups_of(materialise(unseen.unionByName(compared).distinct(), "may-link"))

    def _groups_of(self, near: DataFrame) -> DataFrame:
        """(id, root) of all ids in ``near`` (u, v)."""
        found = materialise(connected(near, "stars").toDF("id", "root"), "group-roots")
        return found.unionByName(found.select(F.col("root").alias("id"), "root").distinct())

    def _crossed(self, rows: DataFrame, data: str, run) -> DataFrame:
        """Links that ``run`` finds: in each root, every piece of those asked for meets every piece of all."""
        percent, width = self.percent, shuffle_width(rows.sparkSession)
        sizes = rows.groupBy("root").agg(F.count(F.lit(1)).alias("members"), F.sum(F.col("asked").cast("int")).alias("asking"))
        sizes = materialise(sizes.where("asking > 0"), "piece-counts")
        pieces = lambda count: F.ceil(F.col(count) / PIECE).cast("int")
        own = lambda count: F.pmod(F.xxhash64("id"), pieces(count).cast("bigint")).cast("int")
        placed = rows.join(sizes, "root")
        every = F.sequence(F.lit(0), pieces("asking") - 1)
        whole = placed.withColumn("b", own("members")).withColumn("a", F.explode(every)).withColumn("asked", F.col("asked") & (own("asking") == F.col("a")))
        # an asking row meets the other pieces too; in its own piece of all it is there already
        there = F.filter(F.sequence(F.lit(0), pieces("members") - 1), lambda b: b != own("members"))
        guests = placed.where("asked").withColumn("a", own("asking")).withColumn("b", F.explode(there))
        keys = ["root", "a", "b"]
        columns = [*keys, "id", "n", "asked", data]
        dealt = whole.select(columns).unionByName(guests.select(columns)).repartition(width, *keys).sortWithinPartitions(*keys)
        return dealt.mapInArrow(lambda bs: run(bs, keys, percent), LINKS)

    def _star(self, members: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Links of each large group to its central member, and all members (root, id, n, fine, h1, h2, asked).

        Central is the member whose class counts are nearest to the group's mean. What is linked to it
        need not be asked for: pairs of such members are connected already.
        """
        spark, percent = members.sparkSession, self.percent
        sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > PIECE)
        sizes = materialise(sizes, "large-groups")
        columns = ["root", "id", "n", "fine", "h1", "h2"]
        if sizes.isEmpty():
            return spark.createDataFrame(_LINKS.empty_table()), members.select(*columns, F.lit(True).alias("asked"))
        large = materialise(members.join(sizes.select("root"), "root", "left_semi"), "large")
        mean = large.groupBy("root").agg(*(F.avg(F.col("classes")[i]).alias(f"c{i}") for i in range(CLASSES)))
        mean = materialise(mean.select("root", F.array(*(f"c{i}" for i in range(CLASSES))).alias("mean")), "group-means")
        apart = F.aggregate(F.zip_with("classes", "mean", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x)
        scored = large.join(mean, "root").select("root", F.struct(apart.alias("far"), F.col("id").alias("id")).alias("c"))
        central = scored.groupBy("root").agg(F.min("c").alias("c")).select("root", F.col("c.id").alias("centre"))
        central = large.join(central.select(F.col("centre").alias("id")), "id").select("root", F.col("id").alias("centre"), F.col("n").alias("centre_n"), F.col("fine").alias("centre_fine"))
        central = materialise(central, "centres")
        both = large.join(central, "root").select("root", "id", "h1", "h2", "n", "fine", "centre_n", "centre_fine")
        near = materialise(both.mapInArrow(lambda bs: _near_centre(bs, percent), "root long, id long, h1 long, h2 long"), "near-centres")
        sets = materialise(self.sets(near, texts).join(near.select("id", "root"), "id"), "sets-near-centres")
        middle = sets.join(central.select(F.col("centre").alias("id")), "id").select("root", F.col("id").alias("centre"), F.col("shingles").alias("central"))
        met = sets.join(materialise(middle, "central-sets"), "root").where("id <> centre")
        shared = F.size(F.array_intersect("shingles", "central"))
        linked = 100 * shared >= percent * (F.size("shingles") + F.size("central") - shared)
        star = materialise(met.where(linked).select(F.col("id").alias("u"), F.col("centre").alias("v")), "star-links")
        done = star.select(F.col("u").alias("id")).unionByName(star.select(F.col("v").alias("id")).distinct()).withColumn("done", F.lit(True))
        flagged = members.select(*columns).join(done, "id", "left").withColumn("asked", F.col("done").isNull()).drop("done")
        return star, materialise(flagged, "flagged")


def equivalent_sql(join: JaccardJoin) -> str:
    """The same by counting the common shingles of all pairs, then spreading the smallest id along links."""
    w = join.width
    grams = f"CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {w} THEN [array_to_string(words, ' ')] ELSE " \
        f"list_transform(range(1, len(words) - {w - 2}), lambda i: array_to_string(words[i:i + {w - 1}], ' ')) END"
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct({grams})) AS grams FROM w),
f AS (SELECT min(doc_id) AS id, grams, len(grams) AS n FROM s WHERE len(grams) > 0 GROUP BY grams),
g AS (SELECT id, n, unnest(grams) AS gram FROM f),
l AS (
  SELECT a.id AS u, b.id AS v FROM g a JOIN g b ON a.gram = b.gram AND a.id < b.id
    AND 100 * least(a.n, b.n) >= {join.percent} * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= {join.percent} * (a.n + b.n - count(*))),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r(id, low) AS (SELECT id, id FROM f UNION SELECT e.v, r.low FROM r JOIN e ON r.id = e.u AND r.low < e.v),
c AS (SELECT id, min(low) AS low FROM r GROUP BY id)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, coalesce(c.low, s.doc_id) AS component_id
FROM s LEFT JOIN f ON s.grams = f.grams LEFT JOIN c ON f.id = c.id"""
