"""Operator 11: the trie of conversation prefixes, from sorted LCPs and range minima.

A turn is the md5 of its role and text, a conversation the bytes of its turns'
hashes: sorted bytewise, conversations that share their first d turns stand
together, and one that ends there comes first.  A node is such an interval.

1. ``conversations`` - turns in order, one row per conversation (a
   conversation is held whole, as a document's text is; texts are not moved).
   ``rebuilt`` gives each conversation the first turns of its base.
2. Rows are range-partitioned and sorted by (turns, conversation).  The pair is
   unique, so a conversation or first turn that a third of all rows hold spreads
   over partitions.  Written once.
3. Of every partition the first and last row meet their neighbours: the length
   of their common prefix is a partition's left and right bound (two numbers a
   partition, all that tasks are told of each other).
4. A task builds the LCPs of its rows and a sparse table of their range minima
   (doubling runs).  Every prefix that a row brings in (depths beyond its LCP)
   and the prefix where it branches off are candidates; each one
   binary-searches its left and right extent in the table, independently of
   all others, for all candidates at once.  Counts, words and leaves of an
   interval are differences of running sums, its smallest conversation a range
   minimum.  There is no stack and no order among nodes.
5. A node whose interval ends inside the partition is done.  One that reaches
   over a bound (at most as many as the bounds are deep) gives a part, keyed
   by the md5 of its prefix; the parts of a node are folded in order of
   partitions as a stream, ids running through one SHA-256.  Its children ask for
   its name by that key.

Defined results: conversations with a null ``conv_id`` take no part; turns
are ordered by number, null first, repeated numbers by hash (of lower-case hex
md5, as text); repeated equal rows are turns of their own; null and empty role
or text are the same; a very long conversation is one row; ``base - conv_id %
20`` as SQL has it (towards zero); an empty table has no conversation and no
node, not even a root; a table of turnless conversations has a root that is
its own leaf; extra columns are ignored, since a row of the result is a node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siniestro.session import materialize

GROUP = 20
HEADS = 4
TURNS = 400_000
"""Turns of a partition, about."""

WORD = r"[^\x20\x09-\x0D]+"
_SIZE = 16  # bytes of a turn's hash
_NODE = ("conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, "
         "key string, parent long, parent_key string, part int")


def turn_hash(role: str = "role", text: str = "text") -> Column:
    """Hex md5 of role and text; the length of the role keeps the two apart."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def conversations(turns: DataFrame) -> DataFrame:
    """(conv, turns array<struct<h, words>>): one row per conversation, turns in order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    some = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.struct(F.col("turn").cast("long").alias("turn"), turn_hash().alias("h"),
                 F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).alias("t"))
    whole = some.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return whole.select("conv", F.transform("t", lambda x: F.struct(x["h"].alias("h"), x["words"].alias("words"))).alias("turns"))


def rebuilt(whole: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """Conversations that begin with the first h turns of their group's base, h = crc32(id) % ``heads``.

    At most ``group`` conversations meet one base.
    """
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(heads)).cast("int")
    base = whole.select(F.col("conv").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    named = whole.withColumn("base", F.col("conv") - F.col("conv") % group).withColumn("h", h)
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    first = F.slice(F.coalesce("head", F.array().cast("array<struct<h:string,words:bigint>>")), F.lit(1), F.col("h"))
    return named.join(base, "base", "left").select("conv", F.concat(first, own).alias("turns"))


def _sorted(whole: DataFrame) -> tuple[DataFrame, int]:
    """(part, conv, seq, words), written, and the number of partitions; a partition is a range of (seq, conv)."""
    flat = whole.select("conv", F.unhex(F.array_join(F.transform("turns", lambda x: x["h"]), "")).alias("seq"),
                        F.transform("turns", lambda x: x["words"]).alias("words"))
    flat = materialize(flat, "trie-rebuilt")
    turns = flat.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    parts = max(int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-turns // TURNS))
    ranges = flat.repartitionByRange(parts, "seq", "conv").withColumn("part", F.spark_partition_id())
    return materialize(ranges, "trie-ranges"), parts


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // _SIZE
    same = np.frombuffer(a, np.uint64, 2 * n) == np.frombuffer(b, np.uint64, 2 * n)
    wrong = np.flatnonzero(~same)
    return int(wrong[0]) // 2 if len(wrong) else n


def _edges(table: DataFrame) -> dict[int, tuple[int, int]]:
    """partition: (prefix shared with the row before it, with the row behind it), -1 at the ends of the table."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            for part, first, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "common": pa.array(
                    [-1 if before is None else _common(before, first)], pa.int32())})
                before = last

    ends = table.groupBy("part").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    # two rows of each partition, one after the other in one task; the driver gets two numbers of each
    met = ends.repartition(1).sortWithinPartitions("part").mapInArrow(meet, "part int, common int").collect()
    met = sorted((r["part"], r["common"]) for r in met)
    right = [*(c for _, c in met[1:]), -1][:len(met)]
    return {p: (c, r) for (p, c), r in zip(met, right, strict=True)}


class Minima:
    """Sparse table: minima of runs of 1, 2, 4, ... values."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows = [values]
        while 2 ** len(self.rows) <= len(values):
            last, half = self.rows[-1], 2 ** (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of values lo..hi, ends included."""
        k = np.frexp((hi - lo + 1).astype(float))[1] - 1
        out = np.empty(len(lo), self.rows[0].dtype)
        for level in np.unique(k):
            at = k == level
            row = self.rows[level]
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << int(level)) + 1])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last position so that all values behind ``at`` up to it are at least ``depth``."""
        at = at.copy()
        for level in range(len(self.rows) - 1, -1, -1):
            row, step = self.rows[level], 1 << level
            can = np.flatnonzero(at + step < len(self.rows[0]))
            at[can] += np.where(row[at[can] + 1] >= depth[can], step, 0)
        return at

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first position so that all values behind it up to ``at`` are at least ``depth``."""
        at = at.copy()
        for level in range(len(self.rows) - 1, -1, -1):
            row, step = self.rows[level], 1 << level
            can = np.flatnonzero(at - step >= 0)
            at[can] -= np.where(row[at[can] - step + 1] >= depth[can], step, 0)
        return at


def _lcps(seqs: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Turns that each row shares with the row before it; -1 for the first."""
    n = len(seqs)
    flat = np.frombuffer(b"".join(seqs), np.uint64).reshape(-1, 2)
    start = np.concatenate(([0], np.cumsum(sizes)))
    room = np.minimum(sizes[1:], sizes[:-1])
    of = np.repeat(np.arange(n - 1), room)
    step = np.arange(len(of)) - np.repeat(np.cumsum(room) - room, room)
    wrong = (flat[start[of + 1] + step] != flat[start[of] + step]).any(axis=1)
    out = np.full(n, -1, np.int64)
    out[1:] = room
    np.minimum.at(out, of[wrong] + 1, step[wrong])
    return out


def _nodes(part: int, convs: np.ndarray, seqs: list[bytes], words: np.ndarray, bounds: tuple[int, int]) -> dict:
    """Columns of a partition's nodes; rows sorted by (seq, conv), ``words`` of all turns, row by row."""
    before, behind = bounds
    n = len(seqs)
    sizes = np.array([len(s) // _SIZE for s in seqs], np.int64)
    lcp = _lcps(seqs, sizes)
    table, smallest = Minima(lcp), Minima(convs)
    # words up to each depth, all rows one behind the other: row i, depth d at first[i] + d
    first = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    upto = np.zeros(int((sizes + 1).sum()), np.int64)
    deep = np.ones(len(upto), bool)
    deep[first] = False
    upto[deep] = words
    upto = np.cumsum(upto)
    upto -= np.repeat(upto[first], sizes + 1)
    total = upto[first + sizes]
    # candidates: each row's branching prefix and those it brings in
    low = np.maximum(lcp, 0)
    low[0] = 0
    row = np.repeat(np.arange(n), sizes - low + 1)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(sizes - low + 1) - (sizes - low + 1), sizes - low + 1) + low[row]
    lo, hi = table.left(row, depth), table.right(row, depth)
    own = lo == row  # the row that brings the prefix in
    node_of = np.full(len(upto), -1, np.int64)  # by place of (row, depth)
    lo_at, lo_row, lo_hi, lo_depth = first[row[own]] + depth[own], row[own], hi[own], depth[own]
    node_of[lo_at] = np.arange(len(lo_at))
    m = len(lo_at)
    # the node above: the prefix one shorter, where the same row or the left extent of its branch brought it in
    place = first[lo[~own]] + depth[~own]  # nodes at which rows branch off
    above = np.full(m, -1, np.int64)
    deeper = lo_depth > 0
    branch = np.full(n, -1, np.int64)
    branch[row[~own]] = node_of[place]
    at_branch = lo_depth - 1 == np.where(lo_row > 0, lcp[lo_row], -1)
    above[deeper & ~at_branch] = node_of[lo_at[deeper & ~at_branch] - 1]
    above[deeper & at_branch] = branch[lo_row[deeper & at_branch]]
    continued = (lo_row == 0) & (lo_depth <= before)
    open_ = continued | ((lo_hi == n - 1) & (lo_depth <= behind))
    children = np.zeros(m, np.int64)
    np.add.at(children, above[deeper & ~continued], 1)
    # running sums over rows
    behind_lcp = np.append(lcp[1:], behind)
    leaves = np.concatenate(([0], np.cumsum(behind_lcp < sizes)))
    words_of = np.concatenate(([0], np.cumsum(total)))
    brought = total - upto[first + np.maximum(lcp, 0)]
    new = np.concatenate(([0], np.cumsum(brought)))
    count = lo_hi - lo_row + 1
    shared = upto[first[lo_row] + np.maximum(lo_depth - 1, 0)]  # words above the node's last turn
    own_new = np.where(continued, total[0] - upto[first[0] + max(before, 0)], total[lo_row] - shared)
    saved = words_of[lo_hi + 1] - words_of[lo_row] - count * shared - own_new - (new[lo_hi + 1] - new[lo_row + 1])
    name = smallest.least(lo_row, lo_hi)
    ending = np.flatnonzero(sizes[lo_row] == lo_depth)
    empty = hashlib.sha256().hexdigest()
    ends = [empty] * m
    for i in np.flatnonzero(open_):
        ends[i] = ""
    same = (sizes[1:] == sizes[:-1]) & (lcp[1:] == sizes[1:])  # copies of the row before
    last = np.append(np.flatnonzero(~same), n - 1)
    for i in ending.tolist():
        to = int(last[np.searchsorted(last, lo_row[i])])
        ids = ",".join(map(str, convs[lo_row[i]:to + 1].tolist()))
        ends[i] = ids if open_[i] else hashlib.sha256(ids.encode()).hexdigest()

    def key(i: int) -> str:
        return hashlib.md5(seqs[lo_row[i]][:int(lo_depth[i]) * _SIZE]).hexdigest()

    keys = [key(i) if o else None for i, o in enumerate(open_.tolist())]
    up_open = (above >= 0) & open_[np.maximum(above, 0)]
    return {
        "conv_id": name, "depth": lo_depth, "n_convs": count, "n_children": children,
        "n_leaves": leaves[lo_hi + 1] - leaves[lo_row], "saved_tokens": saved, "ends": ends, "key": keys,
        "parent": pa.array(name[np.maximum(above, 0)], mask=(above < 0) | up_open),
        "parent_key": [keys[a] if o else None for a, o in zip(above.tolist(), up_open.tolist(), strict=True)],
        "part": pa.array(np.full(m, part), pa.int32())}


def _found(table: DataFrame, parts: int, bounds: dict[int, tuple[int, int]]) -> DataFrame:
    """Nodes and parts of nodes, by the sorted partitions."""
    kinds = [("conv_id", pa.int64()), ("depth", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
             ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()), ("key", pa.string()),
             ("parent", pa.int64()), ("parent_key", pa.string()), ("part", pa.int32())]

    def solved(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        part = rows.column("part")[0].as_py()
        words = rows.column("words").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        found = _nodes(part, rows.column("conv").to_numpy(), rows.column("seq").to_pylist(), words, bounds[part])
        out = pa.table([found[c] if isinstance(found[c], pa.Array) else pa.array(found[c], k) for c, k in kinds],
                       names=[c for c, _ in kinds])
        yield from out.to_batches(max_chunksize=4096)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []  # a partition's batches
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                if held and numbers[lo] != now:
                    yield from solved(pa.Table.from_batches(held))
                    held = []
                now = numbers[lo]
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from solved(pa.Table.from_batches(held))

    whole = table.select("part", "conv", "seq", "words").repartition(parts, "part") \
        .sortWithinPartitions("part", "seq", "conv")
    return whole.mapInArrow(work, _NODE)


def _folded(parts: DataFrame) -> DataFrame:
    """One row per key: parts of a node in order of partitions, as a stream."""
    names = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, some = None, None, False

        def done():
            return pa.RecordBatch.from_pylist([now | {"ends_sha256": sha.hexdigest()}], schema=pa.schema(
                [("key", pa.string()), ("parent_key", pa.string()), *((c, pa.int64()) for c in names),
                 ("ends_sha256", pa.string())]))

        for batch in batches:
            for r in batch.to_pylist():
                if now is None or now["key"] != r["key"]:
                    if now is not None:
                        yield done()
                    now, sha, some = {c: r[c] for c in ("key", "parent_key", *names)}, hashlib.sha256(), False
                else:
                    now["conv_id"] = min(now["conv_id"], r["conv_id"])
                    for c in names[2:]:
                        now[c] += r[c]
                if r["ends"]:
                    sha.update((("," if some else "") + r["ends"]).encode())
                    some = True
        if now is not None:
            yield done()

    spread = parts.repartition("key").sortWithinPartitions("key", "part")
    return spread.select("key", "parent_key", *names, "ends").mapInArrow(
        work, "key string, parent_key string, " + ", ".join(f"{c} long" for c in names) + ", ends_sha256 string")


OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(whole: DataFrame) -> DataFrame:
    """One row per distinct prefix of ``whole`` (conv, turns array<struct<h, words>>), see the contract's columns.

    ``h`` is the hex of 16 bytes that stand for a turn.
    """
    table, parts = _sorted(whole)
    found = materialize(_found(table, parts, _edges(table)), "trie-nodes")
    merged = materialize(_folded(found.filter("key is not null")), "trie-merged")
    names = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    plain = [F.col(c) for c in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    done = found.filter("key is null")
    inside = done.filter("parent_key is null").select(
        *plain, F.col("ends").alias("ends_sha256"), F.col("parent").alias("parent_conv_id"))
    asking = done.filter("parent_key is not null").select(*plain, F.col("ends").alias("ends_sha256"), "parent_key") \
        .unionByName(merged.drop("key"))
    named = asking.join(names, "parent_key", "left").select(*plain, "ends_sha256", F.col("above").alias("parent_conv_id"))
    return inside.unionByName(named).select(*OUT)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return prefix_trie(rebuilt(conversations(turns)))


SQL = r"""
with t as (
  select conv_id as conv, turn, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as h,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words
  from conversations where conv_id is not null),
o as (select *, row_number() over (partition by conv order by turn nulls first, h) as k from t),
c as (
  select conv, conv - conv % 20 as base, xor(list_reduce(list_concat([4294967295], flatten(list_transform(
           string_split(cast(conv as varchar), ''),
           lambda x: [cast(ascii(x) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))),
         lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end), 4294967295) % 4 as head
  from (select distinct conv from t)),
r as (
  select c.conv, 1 as side, o.k, o.h, o.words from c join o on o.conv = c.base and o.k <= c.head
  union all select c.conv, 2, o.k, o.h, o.words from c join o on o.conv = c.conv and o.k > c.head),
s as (select *, row_number() over (partition by conv order by side, k) as d from r),
p as (
  select conv, d, words, string_agg(h, '') over (partition by conv order by d) as p from s
  union all select conv, 0, 0, '' from c),
ends as (select conv, max(d) as n from p group by conv),
node as (
  select p.p, p.d, min(p.conv) as conv_id, count(*) as n_convs, any_value(p.words) as words,
         sha256(coalesce(string_agg(cast(p.conv as varchar), ',' order by p.conv) filter (where e.n = p.d), '')) as ends_sha256
  from p join ends e using (conv) group by p.p, p.d),
child as (select left(p, cast(32 * (d - 1) as bigint)) as p, count(*) as n from node where d > 0 group by 1),
below as (
  select a.p, sum((n.n_convs - 1) * n.words) as saved, count(*) filter (where k.n is null) as leaves
  from node n join p a on a.conv = n.conv_id and a.d <= n.d left join child k on k.p = n.p group by a.p)
select n.conv_id, n.d as depth, u.conv_id as parent_conv_id, n.n_convs, coalesce(k.n, 0) as n_children,
       b.leaves as n_leaves, cast(b.saved as bigint) as saved_tokens, n.ends_sha256
from node n join below b using (p) left join child k using (p)
left join node u on n.d > 0 and u.p = left(n.p, cast(32 * (n.d - 1) as bigint))
"""

QUERIES = {"op11_prefix_trie": op11_prefix_trie}
ORACLE = {"op11_prefix_trie": SQL}
