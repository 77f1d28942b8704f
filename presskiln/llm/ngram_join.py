"""Jaccard join of documents on word n-grams by vertical partitioning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presskiln.llm.common import ENCODED_BYTES, SPACED, Words, frame_bytes, framed, in_pieces, mix, releasing, ship, sizes_of, texts_of, written
from presskiln.llm.components import components
from presskiln.operators.skew import join_splittable

GRAM = 5
# Link where 100 * shared >= PERCENT * all.
PERCENT = 75
# N-grams at the end of the global order, by frequency: at most so many are told to the tasks.
# The rest is in order of the hash. Any order gives the same result; this one keeps n-grams that
# many documents share out of the prefixes.
FREQUENT = 1 << 20
# Vertical fragments: two ranges of the n-grams in hash order, two of the frequent ones. What the
# first one shares rules most pairs out; only the others are counted in the rest.
FIRST, REST = [0], [1, 2, 3]
# Classes of a group that all others of it are compared with, before the pairs that are left.
HUBS = 32
GROUPS = "grp long, cls long, n long, inner boolean, a long, a_n long, b long, b_n long"
# What stands for a null doc_id in keys.
NO_ID = -(1 << 63)
# Classes of which a table is broadcast at most, at under 200 bytes each.
BROADCAST_ROWS = 200_000
POSTING_BYTES, BLOCK_BYTES = 16 << 20, 16 << 20


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted hashes of the distinct runs of GRAM words of each text; of all its words where they
    are fewer; none for a text without words."""
    words = Words(texts, SPACED)
    grams = words.grams(GRAM)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= GRAM:
            out.append(np.unique(grams[a : b - GRAM + 1]))
        elif b > a:
            value = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for h in words.hashes[a:b]:
                    value = value * np.uint64(0x9E3779B97F4A7C15) + h
            out.append(mix(np.array([value])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed integer."""
    with np.errstate(over="ignore"):
        total = mix(np.array([shingles.sum(dtype=np.uint64) + np.uint64(len(shingles))]))
    return int(total.astype(np.int64)[0])


class Order:
    """The global order: position of a shingle as an unsigned integer, frequent ones last."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        by_count = np.lexsort((hashes, counts))
        by_hash = np.argsort(hashes)
        rank = np.empty(len(hashes), np.uint64)
        rank[by_count] = np.arange(len(hashes), dtype=np.uint64)
        self.hashes, self.rank = hashes[by_hash], rank[by_hash]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.hashes >> np.uint64(44)] = True

    def places(self, shingles: np.ndarray) -> np.ndarray:
        out = shingles >> np.uint64(1)
        maybe = np.flatnonzero(self.seen[shingles >> np.uint64(44)])
        if len(maybe):
            at = np.searchsorted(self.hashes, shingles[maybe])
            at[at == len(self.hashes)] = 0
            hit = self.hashes[at] == shingles[maybe]
            out[maybe[hit]] = self.rank[at[hit]] | np.uint64(1 << 63)
        return out

    def fragment(self, places: np.ndarray) -> np.ndarray:
        """The vertical fragment of each place."""
        frequent = places >> np.uint64(63) != 0
        late = (places & np.uint64((1 << 63) - 1)) >= np.uint64(max(1, len(self.hashes) // 2))
        return np.where(frequent, 2 + late, (places >> np.uint64(61) != 0).astype(np.int64))


def prefix_size(n: int) -> int:
    """A set of n elements shares one of so many first ones, in any common order, with every set
    that it is linked to."""
    return n - -(-PERCENT * n // 100) + 1


def inner_size(n: int) -> int:
    """So many first elements are enough where the other set is no smaller: behind the first
    shared element there must be room for all that a link of two such sets needs."""
    return n - -(-2 * PERCENT * n // (100 + PERCENT)) + 1


def _text_key() -> list[Column]:
    return [F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.xxhash64("text").alias("_text")]


def _sketch(batches):
    """Class and size of every row, then shingles that several classes of the task share."""
    classes: set[int] = set()
    held: list[np.ndarray] = []
    size, hashes, counts = 0, np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def folded():
        value, weight = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
        at = np.searchsorted(hashes, value)
        known = at < len(hashes)
        known[known] = hashes[at[known]] == value[known]
        counts[at[known]] += weight[known].astype(np.int32)
        at, value, weight = at[~known], value[~known], weight[~known]
        return np.insert(hashes, at, value), np.insert(counts, at, weight)

    for batch in batches:
        sizes, names = [], []
        for begin, end in in_pieces(sizes_of(batch["text"]), ENCODED_BYTES):
            for shingles in shingle_sets(texts_of(batch["text"].slice(begin, end - begin))):
                name = class_of(shingles)
                sizes.append(len(shingles))
                names.append(name)
                if len(shingles) and name not in classes:
                    classes.add(name)
                    held.append(shingles)
                    size += len(shingles)
            if size > 1 << 20:  # what one task has seen once is kept until it has seen much more
                hashes, counts = folded()
                if len(hashes) > 1 << 21:
                    hashes, counts = hashes[counts > 1], counts[counts > 1]
                held, size = [], 0
        n = len(names)
        yield pa.RecordBatch.from_arrays(
            [batch["_id"], batch["_text"], pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
            ["_id", "_text", "n", "cls", "shingle", "count"],
        )
    hashes, counts = folded()
    hashes, counts = hashes[counts > 1].astype(np.int64), counts[counts > 1].astype(np.int64)
    for k in range(0, len(hashes), 100_000):
        part = pa.array(hashes[k : k + 100_000])
        none = pa.nulls(len(part), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, part, pa.array(counts[k : k + 100_000])], ["_id", "_text", "n", "cls", "shingle", "count"])


def global_order(counted: DataFrame) -> Order:
    """The order from (shingle, count) of all tasks: the FREQUENT most counted come last.

    The least count is a power of two, the least that leaves no more than FREQUENT: a table of
    bounded size, which only decides where an n-gram stands, never whether it counts.
    """
    summed = counted.groupBy("shingle").agg(F.sum("count").alias("count")).where("count >= 4")
    summed = written(summed, "shingle-counts")
    levels = summed.groupBy(F.floor(F.log2("count")).alias("level")).count().collect()
    total, least = 0, 62
    for row in sorted(levels, key=lambda r: -r["level"]):
        total += row["count"]
        if total > FREQUENT:
            break
        least = row["level"]
    table = summed.where(F.col("count") >= 1 << least).toArrow()
    return Order(table["shingle"].to_numpy().astype(np.uint64), table["count"].to_numpy())


def _dealt_out(bucket: np.ndarray, buckets: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    """(bucket, blob): the entries of the columns, packed for the bucket of each."""
    turn = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[turn], np.arange(buckets + 1))
    filled = np.flatnonzero(np.diff(cut))
    cells = [frame_bytes([c[turn[cut[k] : cut[k + 1]]] for c in columns]) for k in filled.tolist()]
    return pa.RecordBatch.from_arrays([pa.array(filled, pa.int64()), pa.array(cells, pa.binary())], ["bucket", "blob"])


def _postings(docs: DataFrame, order, buckets: int) -> DataFrame:
    """(bucket, blob): the prefixes of all classes of a task, dealt out by n-gram.

    Within a bucket 32 bits tell n-grams apart: two that fall together only make candidates, which
    are compared in full. Sizes of postings that are not ``inner`` are negative.
    """

    def run(batches):
        classes: set[int] = set()
        held: list[tuple[int, int, np.ndarray]] = []
        size = 0

        def flushed():
            sizes = np.array([len(p) for _, _, p in held], np.int64)
            owner = np.repeat(np.arange(len(held)), sizes)
            place = np.concatenate([p for _, _, p in held])
            at = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            inner = at < np.array([inner_size(n) for _, n, _ in held])[owner]
            mixed = mix(place)
            bucket, key = (mixed % np.uint64(buckets)).astype(np.int64), (mixed >> np.uint64(32)).astype(np.uint32)
            cls, n = np.array([c for c, _, _ in held], np.int64)[owner], np.array([k for _, k, _ in held], np.int32)[owner]
            return _dealt_out(bucket, buckets, [key, cls, np.where(inner, n, -n)])

        for batch in batches:
            for begin, end in in_pieces(sizes_of(batch["text"]), ENCODED_BYTES):
                for shingles in shingle_sets(texts_of(batch["text"].slice(begin, end - begin))):
                    name = class_of(shingles)
                    if len(shingles) and name not in classes:
                        classes.add(name)
                        k = prefix_size(len(shingles))
                        held.append((name, len(shingles), np.sort(np.partition(order.value.places(shingles), k - 1)[:k])))
                        size += k
                if size > 1 << 19:
                    yield flushed()
                    held, size = [], 0
        if held:
            yield flushed()

    return docs.select("text").mapInArrow(releasing(run), "bucket long, blob binary")


def _groups(table: pa.Table) -> pa.Table:
    """Classes that share an n-gram of their prefixes: one group for each distinct set of them.

    A group needs an ``inner`` class. Up to HUBS of these, the same in all groups as far as can
    be, are paired with the others of their group, as far as sizes and places allow a link. Rows
    of the members behind them (grp, cls, n, inner) come first, then pairs (a, a_n, b, b_n).
    """
    parts = [framed(b, ("<u4", "<i8", "<i4")) for b in table["blob"].to_pylist()]
    place, cls, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    inner, n = n > 0, np.abs(n)
    turn = np.lexsort((cls, ~inner, place))
    place, cls, n, inner = place[turn], cls[turn], n[turn], inner[turn]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (cls[1:] != cls[:-1])
    place, cls, n, inner = place[new], cls[new], n[new], inner[new]
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    sizes = np.diff(np.append(first, len(place)))
    with np.errstate(over="ignore"):
        group = mix(np.add.reduceat(mix(cls.astype(np.uint64) ^ inner.astype(np.uint64)), first) + sizes.astype(np.uint64))
    _, one = np.unique(group, return_index=True)
    one = one[(sizes[one] > 1) & inner[first[one]]]
    first, sizes = first[one], sizes[one]
    begins = np.cumsum(sizes) - sizes
    at = np.repeat(first - begins, sizes) + np.arange(int(sizes.sum()))
    start = np.repeat(first, sizes)
    met = []
    for k in range(HUBS):
        hub = start + k
        later = at > hub
        i, j = hub[later], at[later]
        small, large = np.minimum(n[i], n[j]).astype(np.int64), np.maximum(n[i], n[j]).astype(np.int64)
        fits = inner[i] & (inner[j] | (n[i] < n[j])) & (100 * small >= PERCENT * large)
        met.append((i[fits], j[fits]))
    i, j = (np.concatenate(c) for c in zip(*met, strict=True))
    swap = cls[i] > cls[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    once = np.unique(np.stack([cls[i], cls[j]], 1), axis=0, return_index=True)[1] if len(i) else np.zeros(0, np.int64)
    i, j = i[once], j[once]
    late = at >= start + HUBS  # no pair of an earlier one is left
    grp, at = np.repeat(group[one], sizes)[late].astype(np.int64), at[late]
    members = pa.table({"grp": grp, "cls": cls[at], "n": n[at].astype(np.int64), "inner": inner[at]})
    pairs = pa.table({"a": cls[i], "a_n": n[i].astype(np.int64), "b": cls[j], "b_n": n[j].astype(np.int64)})
    return pa.concat_tables([members, pairs], promote_options="default")


def _alike(one: str, two: str) -> Column:
    """Sizes that a link allows."""
    return 100 * F.least(one, two) >= PERCENT * F.greatest(one, two)


def _dealt(pairs: DataFrame) -> DataFrame:
    """The pairs (a, a_n, b, b_n) with the block that compares them.

    All pairs of one second class b go where the least of its first classes leads, and with them
    those of its neighbours, so that most sets are sent to one block only. A place with more than
    a block's share of all bytes is split by b.
    """
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    homes = pairs.groupBy("b").agg(F.min("a").alias("home"), F.sum(8 * (F.col("a_n") + F.col("b_n"))).alias("bytes"))
    homes = written(homes, "homes")
    volume = homes.agg(F.sum("bytes")).first()[0] or 1
    blocks = max(parts, -(-volume // BLOCK_BYTES))
    loads = homes.groupBy("home").agg(F.ceil(F.sum("bytes") / (volume / blocks)).alias("splits"))
    split = F.pmod(F.xxhash64("b"), "splits")
    block = F.pmod(F.xxhash64("home", split), F.lit(blocks)).alias("block")
    placed = join_splittable(homes, loads, "home", "inner").select("b", block)
    return written(join_splittable(pairs, placed, "b", "inner").select("block", "a", "a_n", "b", "b_n", F.lit(0).cast("long").alias("found")), "dealt")


def _counted(
    dealt: DataFrame, docs: DataFrame, texts: DataFrame, order, fragments: list[int], then=lambda t: t, fields: str = "block long, counts binary"
) -> DataFrame:
    """(block, counts): what the pairs of a block share in one of the fragments, packed.

    The sets of the classes that occur are made again from one text each and cut vertically. What
    comes ``then`` is done in the same call: a Python step behind it would have each task hold
    two workers at once.
    """
    wanted = dealt.select(F.col("a").alias("cls"), "block").union(dealt.select("b", "block")).groupBy("cls").agg(F.collect_set("block").alias("blocks"))
    wanted = written(wanted.join(texts, "cls").select("cls", "blocks", "_id", "_text"), "wanted")
    if wanted.count() <= BROADCAST_ROWS:  # else both sides are shuffled
        wanted = F.broadcast(wanted)
    chosen = docs.join(wanted, ["_id", "_text"]).select("cls", "blocks", "text")

    def cut(batches):
        for batch in batches:
            names, blocks_of = batch["cls"].to_pylist(), batch["blocks"].to_pylist()
            for begin, end in in_pieces(sizes_of(batch["text"]), ENCODED_BYTES // 2):
                rows: list[tuple[int, int, int, bytes]] = []
                for k, shingles in enumerate(shingle_sets(texts_of(batch["text"].slice(begin, end - begin))), begin):
                    if class_of(shingles) != names[k]:
                        continue  # another text under one id and hash
                    places = np.sort(order.value.places(shingles))
                    fragment = order.value.fragment(places)
                    for f in fragments:
                        own = places[fragment == f].tobytes()
                        if own:
                            rows += [(block, f, names[k], own) for block in blocks_of[k]]
                        if len(rows) >= 2000:
                            yield _segments(rows)
                            rows = []
                if rows:
                    yield _segments(rows)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        sets = {c: np.frombuffer(k, "<u8") for c, k in zip(left["cls"].to_pylist(), left["keys"].to_pylist(), strict=True)}
        none = np.zeros(0, "<u8")
        cells = []
        for asked in right["pairs"].chunks:
            pairs = asked.flatten()
            a, a_n, b, b_n, found = (pairs.field(c).to_numpy() for c in ("a", "a_n", "b", "b_n", "found"))
            shared, a_size, b_size = (np.zeros(len(a), np.int64) for _ in range(3))
            turn = np.argsort(a, kind="stable")
            for group in np.split(turn, np.flatnonzero(np.diff(a[turn])) + 1):
                own = sets.get(int(a[group[0]]), none)
                segments = [sets.get(x, none) for x in b[group].tolist()]
                a_size[group], b_size[group] = len(own), [len(s) for s in segments]
                values = np.concatenate(segments)
                if len(own) and len(values):
                    at = np.minimum(np.searchsorted(own, values), len(own) - 1)
                    upto = np.concatenate(([0], np.cumsum(own[at] == values)))
                    ends = np.cumsum(b_size[group])
                    shared[group] = upto[ends] - upto[ends - b_size[group]]
            cells.append(frame_bytes([a, a_n, b, b_n, found, shared, a_size, b_size]))
        block = pa.array([right["block"][0].as_py()] * len(cells) if cells else [], pa.int64())
        return then(pa.table({"block": block, "counts": pa.array(cells, pa.binary())}))

    segments = chosen.mapInArrow(releasing(cut), "block long, fragment long, cls long, keys binary")
    each = F.explode(F.array(*[F.lit(f).cast("long") for f in fragments])).alias("fragment")
    asked = dealt.groupBy("block").agg(F.collect_list(F.struct("a", "a_n", "b", "b_n", "found")).alias("pairs"))
    asked = asked.select("block", "pairs", each)
    return segments.groupBy("block", "fragment").cogroup(asked.groupBy("block", "fragment")).applyInArrow(count, fields)


def _unpacked(cells: list[bytes]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*(framed(x, ("<i8",) * 8) for x in cells), strict=True)]


def _possible(table: pa.Table) -> pa.Table:
    """Pairs that may still be links: what they share in the first fragment, and all that the
    smaller rest of the two sets could add, is enough."""
    names, found_in = ("block", "a", "a_n", "b", "b_n", "found"), []
    for block, cell in zip(table["block"].to_pylist(), table["counts"].to_pylist(), strict=True):
        a, a_n, b, b_n, found, shared, a_size, b_size = _unpacked([cell])
        most = found + shared + np.minimum(a_n - a_size, b_n - b_size)
        on = np.flatnonzero(100 * most >= PERCENT * (a_n + b_n - most))
        found_in.append((np.full(len(on), block), a[on], a_n[on], b[on], b_n[on], (found + shared)[on]))
    columns = zip(*found_in, strict=True) if found_in else [[np.zeros(0, np.int64)]] * len(names)
    return pa.table({n: pa.array(np.concatenate(list(c)), pa.int64()) for n, c in zip(names, columns, strict=True)})


def _summed(table: pa.Table) -> pa.Table:
    """Links of one block: counts of the fragments summed for each pair."""
    a, a_n, b, b_n, found, shared, _, _ = _unpacked(table["counts"].to_pylist())
    turn = np.lexsort((b, a))
    a, a_n, b, b_n, found, shared = (c[turn] for c in (a, a_n, b, b_n, found, shared))
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    total = found[first] + np.add.reduceat(shared, first)
    on = first[100 * total >= PERCENT * (a_n[first] + b_n[first] - total)]
    return pa.table({"a": pa.array(a[on], pa.int64()), "b": pa.array(b[on], pa.int64())})


def _verified(pairs: DataFrame, docs: DataFrame, texts: DataFrame, order, name: str) -> DataFrame:
    """Links (a, b) among the distinct pairs (a, a_n, b, b_n) of classes.

    Each block and fragment counts what its pairs share, and the counts are summed for each pair.
    The first fragment goes ahead: pairs that cannot be links any more leave the others out.
    """
    fields = "block long, a long, a_n long, b long, b_n long, found long"
    possible = written(_counted(_dealt(pairs), docs, texts, order, FIRST, _possible, fields), "possible")
    counted = _counted(possible, docs, texts, order, REST)
    return written(counted.groupBy("block").applyInArrow(_summed, "a long, b long"), name)


def _mixed(members: DataFrame) -> DataFrame:
    """The members of groups that hold classes of several components."""
    several = members.groupBy("grp").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low <> _high").select("grp")
    return join_splittable(members, several, "grp", "inner")


def _foreign(table: pa.Table) -> pa.Table:
    """(cls, most): how many n-grams of each class of a bucket a class of another component has."""
    parts = [framed(b, ("<u8", "<i8", "<i8")) for b in table["blob"].to_pylist()]
    shingle, cls, root = (np.concatenate(c) for c in zip(*parts, strict=True))
    turn = np.lexsort((cls, shingle))
    shingle, cls, root = shingle[turn], cls[turn], root[turn]
    new = np.ones(len(cls), bool)  # the document of a class may come twice
    new[1:] = (shingle[1:] != shingle[:-1]) | (cls[1:] != cls[:-1])
    shingle, cls, root = shingle[new], cls[new], root[new]
    first = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1])))
    several = np.minimum.reduceat(root, first) != np.maximum.reduceat(root, first)
    foreign = np.repeat(several, np.diff(np.append(first, len(cls))))
    names, at = np.unique(cls, return_inverse=True)
    return pa.table({"cls": names, "most": np.bincount(at[foreign], minlength=len(names)).astype(np.int64)})


def _bounded(members: DataFrame, docs: DataFrame, texts: DataFrame) -> DataFrame:
    """The members (grp, cls, n, inner, root) that may have a link to another component, with the
    ``most`` n-grams that it could share.

    A class shares no more with those of other components than what any of them has at all. Where
    that is too little for the smallest set of a group, none of its pairs there is a link.
    """
    wanted = written(members.select("cls", "n", "root").distinct().join(texts, "cls"), "apart")
    count, volume = wanted.agg(F.count("*"), F.sum("n")).first()
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 24 * (volume or 0) // POSTING_BYTES)
    if count <= BROADCAST_ROWS:  # else both sides are shuffled
        wanted = F.broadcast(wanted)
    chosen = docs.join(wanted, ["_id", "_text"]).select("cls", "root", "text")

    def cut(batches):
        held: list[tuple[int, int, np.ndarray]] = []
        size = 0

        def flushed():
            shingles = np.concatenate([s for _, _, s in held])
            owner = np.repeat(np.arange(len(held)), [len(s) for _, _, s in held])
            cls, root = (np.array([h[k] for h in held], np.int64)[owner] for k in (0, 1))
            return _dealt_out((mix(shingles) % np.uint64(buckets)).astype(np.int64), buckets, [shingles, cls, root])

        for batch in batches:
            names, roots = batch["cls"].to_pylist(), batch["root"].to_pylist()
            for begin, end in in_pieces(sizes_of(batch["text"]), ENCODED_BYTES):
                for k, shingles in enumerate(shingle_sets(texts_of(batch["text"].slice(begin, end - begin))), begin):
                    if class_of(shingles) == names[k]:  # else another text under one id and hash
                        held.append((names[k], roots[k], shingles))
                        size += len(shingles)
                if size > 1 << 19:
                    yield flushed()
                    held, size = [], 0
        if held:
            yield flushed()

    found = chosen.mapInArrow(releasing(cut), "bucket long, blob binary").groupBy("bucket").applyInArrow(_foreign, "cls long, most long")
    found = written(found.groupBy("cls").agg(F.sum("most").alias("most")), "bounds")
    low = members.groupBy("grp").agg(F.min("n").alias("low"))
    near = join_splittable(members, low, "grp", "inner").join(found, "cls", "left").withColumn("most", F.coalesce("most", "n"))
    return near.where((100 + PERCENT) * F.col("most") >= PERCENT * (F.col("n") + F.col("low"))).drop("low")


def _segments(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["block", "fragment", "cls", "keys"])


def _components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (_id, _text, n, cls) of documents, and for each class with n-grams its component_id and
    the key (_id, _text) of the one document that stands for its component."""
    spark = ship(docs.sparkSession)
    keyed = docs.select("text", *_text_key())
    fields = "_id long, _text long, n long, cls long, shingle long, count long"
    sketch = written(keyed.select("_id", "_text", "text").mapInArrow(releasing(_sketch), fields), "sketch")
    rows = sketch.where("shingle is null").select("_id", "_text", "n", "cls")
    order = spark.sparkContext.broadcast(global_order(sketch.where("shingle is not null").select("shingle", "count")))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct((F.col("_id") == NO_ID).alias("none"), "_id", "_text")  # null ids come last
    classes = rows.where("n > 0").groupBy("cls").agg(F.min(key).alias("key"), F.first("n").alias("n"))
    classes = written(classes.select("cls", "key", "n"), "classes")
    texts = classes.select("cls", "key._id", "key._text")
    volume = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(2 * parts, 4 * volume // POSTING_BYTES)  # a quarter of the n-grams, 16 bytes each
    postings = _postings(docs, order, buckets)
    groups = written(postings.groupBy("bucket").applyInArrow(_groups, GROUPS), "groups")

    pairs = written(groups.where("grp is null").select("a", "a_n", "b", "b_n").distinct(), "pairs")
    links = _verified(pairs, keyed, texts, order, "links")
    found = components(links)

    members = groups.where("grp is not null").select("grp", "cls", "n", "inner").distinct()
    members = members.join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    left = written(_mixed(members), "mixed")
    more = None if left.isEmpty() else _rest(left, pairs, keyed, texts, order)
    if more is not None and not more.isEmpty():
        found = components(links.unionByName(more))

    least = classes.select("cls", "key").join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    top = least.groupBy("root").agg(F.min("key").alias("key"))
    named = join_splittable(least.select("cls", "root"), top, "root", "inner")
    return rows, named.select("cls", _id_of("key._id").alias("component_id"), F.col("key._id").alias("_keep"), F.col("key._text").alias("_keep_text"))


def _rest(left: DataFrame, pairs: DataFrame, docs: DataFrame, texts: DataFrame, order) -> DataFrame | None:
    """Links between components among the members (grp, cls, n, inner, root) of groups, without the
    ``pairs`` that were counted; None where no pair may be a link."""
    left = written(_mixed(_bounded(left, docs, texts)), "mixed")
    one, two = (left.select("grp", *[F.col(c).alias(f"{c}_{k}") for c in ("cls", "n", "inner", "root", "most")]) for k in (1, 2))
    room = "(inner_1 or n_1 > n_2) and (inner_2 or n_2 > n_1)"
    enough = (100 + PERCENT) * F.least("most_1", "most_2") >= PERCENT * (F.col("n_1") + F.col("n_2"))
    rest = one.join(two, "grp").where("root_1 < root_2").where(room).where(_alike("n_1", "n_2")).where(enough)
    low = F.col("cls_1") < F.col("cls_2")
    rest = rest.select(
        F.least("cls_1", "cls_2").alias("a"), F.when(low, F.col("n_1")).otherwise(F.col("n_2")).alias("a_n"),
        F.greatest("cls_1", "cls_2").alias("b"), F.when(low, F.col("n_2")).otherwise(F.col("n_1")).alias("b_n"),
    ).distinct()
    rest = written(rest.join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    return None if rest.isEmpty() else _verified(rest, docs, texts, order, "links")


def _id_of(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(NO_ID))


def link_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of (doc_id, text).

    Texts with one set of n-grams are one class and cost one. A prefix filter on the global order
    finds groups of classes that may be linked. First every class of a group is compared with
    HUBS of it; then, exactly, all pairs of a group that are still in different components: pairs
    inside a component change nothing. Of these, classes that share too little with all classes of
    other components are left out before pairs are made. So groups of any number of near copies stay
    linear, and no component is missed. Sets are compared by 64-bit hashes of their n-grams.

    Null and empty texts and texts without words have no n-grams and stay alone. Repeated rows are
    copies of each other; null doc_ids are never the least of a component, and a component of null
    ids alone has a null id. An empty table gives no rows.
    """
    rows, named = _components(docs.select("doc_id", "text"))
    linked = join_splittable(rows.where("n > 0"), named, "cls", "inner").select(_id_of("_id").alias("doc_id"), "n", "component_id")
    alone = rows.where("n = 0").select(_id_of("_id").alias("doc_id"), "n").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, of each component of ``link_documents`` only one: that of the least
    doc_id, and of its rows with that id the one of least text hash. Rows without words all stay.
    """
    keys = [c.alias(f"_key{k}") for k, c in enumerate(_text_key())]
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    _, named = _components(docs.select("doc_id", "text"))
    kept = named.select(F.col("_keep").alias("_key0"), F.col("_keep_text").alias("_key1")).distinct()
    rows = docs.where(worded).select("*", *keys).join(kept, ["_key0", "_key1"], "left_semi")
    one = rows.dropDuplicates(["_key0", "_key1"]).select(*docs.columns)
    return one.unionByName(docs.where(~worded))


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    return link_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
