"""Exact set-similarity join on word n-grams by vertical partitioning.

The global n-gram order (the order of the n-grams' 64-bit ids) is cut into
vertical fragments, and with it every text's set.

* **Candidates.**  Two sets with Jaccard ``num/den`` or more differ in at most
  ``H = (den - num)(a + b) // (den + num)`` n-grams, so cut into more than ``H``
  fragments they agree in one fragment at least.  Sets meet in a bucket when
  they have one same non-empty fragment.  The number of fragments follows from
  the size class (sizes within a factor of two; sizes near a class border also
  enter the border's own class).  A set that occupies ``m`` fragments shares
  ``m - H`` of them with any partner, so one that meets others in fewer is taken
  out before anything is compared.  Nor is a pair compared whose n-grams that
  other candidates have could not make up the overlap.  Of the ``m - H`` shared
  fragments one at least is outside the ``m - H - 1`` that most sets have, so a set
  leaves these buckets: what is common to many texts brings few of them together.
  A set whose n-grams occupy only ``H``
  fragments or fewer could miss a set like itself; such sets (nearly always
  none) also meet by the n-grams of their prefixes.  No bucket is capped.
* **Counting.**  For a candidate pair the overlap is counted in each of
  ``PARTS`` vertical parts separately and summed per pair; the exact integer
  test ``den * both >= num * union`` decides.  What a pivot and a member do not
  have in common is kept from that one comparison.
* **Groups.**  Equal sets are one node from the start, so copies are never
  expanded.  Every bucket's pivot (the member with most in common with others)
  is compared with all its members; those compared with the same pivot ``p`` are
  a family, and two sets that meet are in a family.  In it a set is known by its
  difference from ``p``, ``e``.  Two members that differ in ``d`` n-grams have
  ``(e + e' - d) / 2`` n-grams of their differences in common, and linked ones in
  different components one at least: were ``e + e' <= d``, both would be linked
  with ``p``.  So they are found by the rarest n-grams of the differences, and
  compared if enough n-grams are left after the first common one.  What all
  texts of a family have in common brings none of them together.  No link between
  components is lost, though pairs inside a component need not be compared.
* **Components** by alternating large-star and small-star steps.

Edge cases: a text with fewer words than ``n`` is one n-gram of all its words;
null, empty and blank texts have the empty set, are linked with nothing, and
keep their own id; null ids count as larger than all others, and a component
of null ids alone has a null id.  Repeated rows are copies like any others; an
empty table gives no row; a very long text is one set of all its n-grams; a
caller's column named like an output is replaced by it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import K1, K2, K3, U64, blocks, discard, materialise, mix, record, table, texts, unpack, words

N = 4
NUM, DEN = 85, 100
#: Vertical parts in which overlaps are counted.
PARTS = 8
#: How often sets that meet others too rarely are taken out before comparing.
PEELS = 2


def difference(a: int, b: int, num: int = NUM, den: int = DEN) -> int:
    """Most n-grams that are in one of two linked sets of these sizes only."""
    return (den - num) * (a + b) // (den + num)


def shingles(values: list[bytes], n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram ids of each row, ascending, and their number per row."""
    ids, per, _ = words(values)
    ends = np.cumsum(per)
    begins = ends - per
    count = np.where(per >= n, per - n + 1, (per > 0).astype(np.int64))
    row = np.repeat(np.arange(len(per)), count)
    at = begins[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    size = np.minimum(per, n)[row]
    g = size.astype(U64)
    for i in range(n):
        has = i < size
        g[has] = mix(g[has] * K2 + ids[at[has] + i] + K3)
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    g, row = g[new], row[new]
    return g, np.bincount(row, minlength=len(per))


def _sums(x: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sum of each run of ``x`` (runs are never empty), modulo 2^64."""
    return np.add.reduceat(x, begins) if len(begins) else np.zeros(0, U64)


def signatures(g: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit name of each row's set; empty sets have (0, 0)."""
    s1, s2 = np.zeros(len(per), U64), np.zeros(len(per), U64)
    full = np.flatnonzero(per)
    begins = (np.cumsum(per) - per)[full]
    s1[full] = mix(_sums(mix(g + K1), begins) + per[full].astype(U64))
    s2[full] = mix(_sums(mix(g * K3 + K2), begins))
    return s1, s2


def schemes(size: int, num: int = NUM, den: int = DEN) -> list[tuple[int, int]]:
    """(scheme, H) of the size classes that a set of this size enters: its own
    class [2^c, 2^(c+1)), and a border class where a partner can lie beyond."""
    c = size.bit_length() - 1
    low = 1 << c
    out = [(2 * c, difference(2 * low - 1, 2 * low - 1, num, den))]
    for border, s in ((low, 2 * c - 1), (2 * low, 2 * c + 1)):
        below, above = size if size < border else border - 1, size if size >= border else border
        if below * den >= above * num:  # some set on the other side may be linked
            most = (border - 1) * den // num
            out.append((s, difference(border - 1, most, num, den)))
    return out


def buckets(g: np.ndarray, per: np.ndarray, num: int = NUM, den: int = DEN
            ) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """A tuple per scheme: its rows, how many keys each has, how many of them a
    linked partner must share at least, and all keys.  A key's low byte is its scheme."""
    begins = np.cumsum(per) - per
    wanted: dict[tuple[int, int], list[int]] = {}
    for size in np.unique(per[per > 0]).tolist():
        for s in schemes(size, num, den):
            wanted.setdefault(s, []).append(size)
    high = g >> U64(32)
    content = mix(g * K1 + K3)
    out = []
    for (scheme, most), sizes in wanted.items():
        chosen = np.flatnonzero(np.isin(per, sizes))
        length = per[chosen]
        place = np.repeat(np.arange(len(chosen)), length)
        at = begins[chosen][place] + np.arange(len(place)) - np.repeat(np.cumsum(length) - length, length)
        fragments = 9 * (most + 1) // 8 + 6
        f = (high[at] * U64(fragments)) >> U64(32)  # ascending within a row
        new = np.ones(len(at), bool)
        new[1:] = (f[1:] != f[:-1]) | (place[1:] != place[:-1])
        first = np.flatnonzero(new)
        keys = mix(mix(_sums(content[at], first)) + f[first] * K3)
        owner = place[first]
        full = np.bincount(owner, minlength=len(chosen))
        need = np.maximum(full - most, 1)
        for r in np.flatnonzero(full <= most).tolist():  # prefixes in the global order
            size = int(length[r])
            prefix = g[begins[chosen[r]]:][: size - (-(-size * num // den)) + 1]
            keys = np.concatenate((keys, mix(mix(prefix ^ K1) + K1)))
            owner = np.concatenate((owner, np.full(len(prefix), r)))
        order = np.argsort(owner, kind="stable")
        keys = keys[order] & ~U64(255) | U64((scheme + 1) & 255)
        out.append((chosen, np.bincount(owner, minlength=len(chosen)), need, keys))
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _lists(x: np.ndarray, per: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(per))).astype(np.int32)), _signed(x))


def _keyed(n: int, num: int, den: int):
    """(s1, need, list): a set's name and a scheme's bucket keys, once a task for copies."""
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            values = texts(batch.column("text"))
            for a, b in blocks(values):
                g, per = shingles(values[a:b], n)
                s1, _ = signatures(g, per)
                new = np.zeros(len(per), bool)
                for i, s in enumerate(s1.tolist()):
                    if per[i] and s not in seen:
                        seen.add(s)
                        new[i] = True
                g, per, s1 = g[np.repeat(new, per)], per[new], s1[new]
                for rows, count, need, keys in buckets(g, per, num, den):
                    yield pa.RecordBatch.from_arrays(
                        [_signed(s1[rows]), pa.array(need.astype(np.int32)), _lists(keys, count)],
                        names=["s1", "need", "list"])
    return run


def _named(n: int, once: bool):
    """The record, set name and size of each row; once a task for copies if asked."""
    def run(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            values = texts(batch.column("text"))
            for a, b in blocks(values):
                g, per = shingles(values[a:b], n)
                s1, s2 = signatures(g, per)
                out = pa.RecordBatch.from_arrays(
                    [batch.column("rec").slice(a, b - a), _signed(s1), _signed(s2), pa.array(per.astype(np.int64))],
                    names=["rec", "s1", "s2", "size"])
                if once:
                    keep = []
                    for i, s in enumerate(zip(s1.tolist(), s2.tolist())):
                        if per[i] and s not in seen:
                            seen.add(s)
                            keep.append(i)
                    out = out.take(pa.array(keep, pa.int64()))
                yield out
    return run


def _cut_sets(n: int):
    """A set cut into ``PARTS`` vertical parts of the n-gram order, a row each."""
    def run(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            values = texts(batch.column("text"))
            for a, b in blocks(values):
                g, per = shingles(values[a:b], n)
                s1, s2 = signatures(g, per)
                begins = np.cumsum(per) - per
                for i, s in enumerate(zip(s1.tolist(), s2.tolist())):
                    if s in seen:
                        continue
                    seen.add(s)
                    own = g[begins[i]:begins[i] + per[i]]
                    part = (own >> U64(61)).astype(np.int64)
                    count = np.bincount(part, minlength=PARTS)
                    yield pa.RecordBatch.from_arrays(
                        [_signed(np.repeat(s1[i:i + 1], PARTS)), _signed(np.repeat(s2[i:i + 1], PARTS)),
                         pa.array(np.full(PARTS, per[i], np.int64)), pa.array(np.arange(PARTS, dtype=np.int32)),
                         _lists(own, count)],
                        names=["s1", "s2", "size", "part", "own"])
    return run


def named_sets(rows: DataFrame, n: int = N, once: bool = False) -> DataFrame:
    """(rec, s1, s2, size) of rows with ``rec`` and ``text``."""
    rec = rows.schema["rec"].dataType.simpleString()
    return rows.mapInArrow(_named(n, once), f"rec {rec}, s1 bigint, s2 bigint, size bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): smallest node reachable, for the nodes of ``edges`` (u, v).
    Large-star and small-star steps until nothing changes."""
    edges = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), "edges")
    mark = None
    while True:
        before = edges
        both = edges.union(edges.select(F.col("v"), F.col("u"))).toDF("x", "y")
        low = both.groupBy("x").agg(F.min("y").alias("m")).withColumn("m", F.least("x", "m"))
        large = (both.where("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = (small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
                 .where("u <> v").distinct())
        edges = materialise(edges, "edges")
        discard([before])
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
                edges.select(F.col("v"), F.col("v")).distinct())
        mark = tuple(now)


def link_components(docs: DataFrame, text: str = "text", n: int = N, num: int = NUM, den: int = DEN) -> DataFrame:
    """(node, comp) for the sets that are linked with another set; a ``node`` is
    the struct of the set's two name halves, a ``comp`` the smallest linked node."""
    node = F.struct("s1", "s2").alias("node")
    used = []

    def kept(df, name):
        used.append(materialise(df, name))
        return used[-1]

    keyed = (docs.select(F.col(text).alias("text"))
             .mapInArrow(_keyed(n, num, den), "s1 bigint, need int, list array<bigint>")
             .select(F.explode("list").alias("k"), "s1", "need"))

    def met(rows, *more):
        """Rows of buckets with two sets or more, and how many: one exchange and one sort."""
        bucket = Window.partitionBy("k")
        return (rows.select("k", "s1", "need", *more, F.min("s1").over(bucket).alias("_a"), F.max("s1").over(bucket).alias("_b"),
                            F.count("*").over(bucket).alias("often"))
                .where("_a <> _b").select("k", "s1", "need", *more, "often"))

    def replaced(before, rows):
        after = kept(rows, "near")
        used.remove(before)
        discard([before])
        return after

    near = kept(met(keyed), "near")
    scheme = F.col("k").bitwiseAND(F.lit(255)).alias("scheme")
    for _ in range(PEELS):
        # Linked sets share ``need`` buckets of a scheme at least: a set that
        # meets others in fewer has no partner there.  Copies of a row from
        # several tasks count once.
        enough = (near.groupBy("s1", scheme, "need", "k").agg(F.lit(1))
                  .groupBy("s1", "scheme", "need").agg(F.count("*").alias("n")).where("n >= need").select("s1", "scheme"))
        near = replaced(near, met(near.withColumn("scheme", scheme).join(enough, ["s1", "scheme"], "left_semi")))
    # Of ``need`` shared buckets one is outside any ``need - 1`` of either set, in
    # one order of all buckets: each set leaves those most others have.
    own = Window.partitionBy("s1", scheme, "need")
    rank = F.dense_rank().over(own.orderBy(F.desc("often"), F.desc("k")))
    weight = F.avg("often").over(own) * F.max("_r").over(own)  # rows of a copy are averaged away
    near = replaced(near, met(near.select("*", rank.alias("_r")).withColumn("weight", weight).where("_r >= need"), "weight"))
    bodies = (named_sets(docs.select(F.struct(F.col(text).alias("t")).alias("rec"), F.col(text).alias("text")), n, once=True)
              .select("s1", "s2", F.col("rec.t").alias("text"))
              .join(near.select("s1").distinct(), "s1", "left_semi").dropDuplicates(["s1", "s2"]))
    parts = kept(bodies.mapInArrow(
        _cut_sets(n), "s1 bigint, s2 bigint, size bigint, part int, own array<bigint>")
        .select(node, "size", "part", "own"), "parts")

    def alone(first, last):
        """How many n-grams of vertical parts ``first`` to ``last`` each candidate has alone."""
        return (parts.where(F.col("part").between(first, last)).select("node", F.explode("own").alias("h")).groupBy("h")
                .agg(F.count("*").alias("n"), F.min("node.s1").alias("s1"), F.min("node.s2").alias("s2"))
                .where("n = 1").groupBy(node).agg(F.count("*").alias("alone")))

    # N-grams of one candidate only are in no overlap: ``core`` counts the rest.
    # A part's n-grams are in no other, so half of the parts is shuffled at a time.
    half = PARTS // 2
    apart = (kept(alone(0, half - 1), "alone").union(kept(alone(half, PARTS - 1), "alone"))
             .groupBy("node").agg(F.sum("alone").alias("alone")))
    cores = (parts.where("part = 0").join(apart, "node", "left")
             .select("node", F.col("node.s1").alias("s1"), "size",
                     (F.col("size") - F.coalesce("alone", F.lit(0))).alias("core")))

    def linkable(core, x, y):
        """Whether an overlap of ``core`` is enough for sizes ``x`` and ``y``."""
        return den * core >= num * (x + y - core)

    members = near.join(cores, "s1").groupBy("k", "node", "size", "core").agg(F.max("weight").alias("weight"))
    smallest = members.groupBy("k").agg(F.min("size").alias("least"), F.count("*").alias("m")).where("m > 1")
    members = kept(
        members.join(smallest, "k")
        .where(linkable(F.col("core"), F.col("size"), F.greatest("least", "core")))
        .select("k", "node", "size", "weight"), "members")
    left = parts.select(F.col("node").alias("x"), F.col("size").alias("xs"), "part", F.col("own").alias("xo"))
    right = parts.select(F.col("node").alias("y"), F.col("size").alias("ys"), "part", F.col("own").alias("yo"))

    def met_parts(pairs):
        """Each pair in each vertical part."""
        return pairs.join(left, "x").join(right, ["y", "part"])

    def counted(pairs):
        """Partial overlaps per vertical part, summed per pair."""
        return (met_parts(pairs)
                .select("x", "y", "xs", "ys", F.size(F.array_intersect("xo", "yo")).alias("both"))
                .groupBy("x", "y", "xs", "ys").agg(F.sum("both").alias("both")))

    def linked(pairs):
        return pairs.where(linkable(F.col("both"), F.col("xs"), F.col("ys"))).select(F.col("x").alias("u"), F.col("y").alias("v"))

    pivots = members.groupBy("k").agg(F.max(F.struct("weight", "node")).alias("p")).select("k", F.col("p.node").alias("y"))
    pivoted = kept(members.join(pivots, "k").where("node <> y").select(F.col("node").alias("x"), "y").distinct(), "pivoted")
    # The n-grams that only one of the two has stay with each part, for the seeds.
    compared = kept(met_parts(pivoted).select(
        "x", "y", "xs", "ys", (F.size("xo") + F.size("yo")).alias("held"),
        F.concat(F.array_except("xo", "yo"), F.array_except("yo", "xo")).alias("apart")), "compared")
    family = kept(compared.groupBy("x", "y", "xs", "ys")
                  .agg(F.expr("sum((held - size(apart)) div 2)").alias("both")), "family")
    links = linked(family)
    labels = kept(components(links), "labels")
    seeds = kept(_seeds(family, compared, labels, num, den), "seeds")
    found = kept(linked(counted(kept(_alike(seeds, family, num, den), "pairs"))), "links")
    if not found.isEmpty():
        labels = kept(components(links.union(found)), "labels")
    used.remove(labels)
    discard(used)
    return labels


def _seeds(family: DataFrame, compared: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """(y, h, m, rest): of each family ``y`` and member ``m`` the n-grams of their
    difference that a partner in another component must have one of, and how many
    they can have in common if this is the first."""
    named = (family.join(labels.toDF("x", "xc"), "x", "left").join(labels.toDF("y", "yc"), "y", "left")
             .select("x", "y", "xs", "ys", F.coalesce("xc", "x").alias("comp"),
                     (F.coalesce("xc", "x") == F.coalesce("yc", "y")).alias("inside"),
                     (F.col("xs") + F.col("ys") - 2 * F.col("both")).alias("e")))
    unsettled = named.groupBy("y").agg(F.max("xs").alias("most"), F.bool_and("inside").alias("settled")).where("not settled")
    # What x must have in common with any partner: all but what linked sets differ
    # in; and if the partner is not linked with the pivot, half of what is beyond.
    partner = F.least("most", F.expr(f"xs * {den} div {num}"))
    outside = f"(e + 2 - ({den - num} * greatest(xs - ys, 0L) + {den + num - 1}) div {den + num}) div 2"
    named = (named.join(unsettled, "y").withColumn("partner", partner)
             .withColumn("need", F.greatest(F.lit(1), F.expr(f"e - {den - num} * (xs + partner) div {den + num}"),
                                            F.when(F.col("inside"), F.expr(outside))))
             .select("x", "y", "xs", "comp", "e", "need"))
    shared = (named.join(compared.select("x", "y", "apart"), ["x", "y"])
              .select(F.struct("x", "comp", "e", "need", "xs").alias("m"), "y", F.explode("apart").alias("h"))
              .withColumn("n", F.count("*").over(Window.partitionBy("y", "h"))).where("n > 1"))
    own = Window.partitionBy("y", "m")
    return (shared.select("y", "h", "m", F.row_number().over(own.orderBy("n", "h")).alias("at"), F.count("*").over(own).alias("c"))
            .where("at <= c - m.need + 1").select("y", "h", "m", (F.col("c") - F.col("at") + 1).alias("rest")))


def _alike(seeds: DataFrame, family: DataFrame, num: int, den: int) -> DataFrame:
    """(x, y): the pairs of a family in different components that have enough left
    in common at a shared seed, but those with a pivot, which are compared already."""
    a, b = seeds.alias("a"), seeds.alias("b")
    enough = F.expr(f"{den + num} * (a.m.e + b.m.e - 2 * least(a.rest, b.rest)) <= {den - num} * (a.m.xs + b.m.xs)")
    pairs = (a.join(b, ["y", "h"]).where((F.col("a.m.x") < F.col("b.m.x")) & (F.col("a.m.comp") != F.col("b.m.comp")) & enough)
             .select(F.col("a.m.x").alias("x"), F.col("b.m.x").alias("y")).distinct())
    met = family.select("x", "y")
    return pairs.join(met.union(met.select("y", "x")).distinct(), ["x", "y"], "left_anti")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n: int = N,
                    num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs`` with ``n_shingles`` and ``component_id``."""
    labels = link_components(docs, text, n, num, den)
    rows = docs.select(F.struct(record(docs), F.col(doc_id).alias("id")).alias("rec"), F.col(text).alias("text"))
    named = (named_sets(rows, n).select("rec.rec", "rec.id", "size", F.struct("s1", "s2").alias("node"))
             .join(labels, "node", "left")
             .withColumn("comp", F.when(F.col("size") > 0, F.coalesce("comp", "node"))))
    first = named.where("comp is not null").groupBy("comp").agg(F.min("id").alias("first"))
    out = named.join(first, "comp", "left")
    return out.select(*unpack(docs.columns, {
        "n_shingles": F.col("size"), "component_id": F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("first"))}))


def op10_vertical_partitions(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")
