"""MinHash near-duplicates with odd sketches.

Every text becomes a set of word shingles, ``SAMPLES`` MinHash values, bands
of ``ROWS`` values each, and an odd sketch: the samples folded into a bitmap
by parity, so that the XOR of two sketches counts how many samples differ.
Texts with equal sets are one class.  Classes that share a band are candidate
links; the odd sketches estimate their similarity, and what may reach the
threshold is confirmed on the full shingle sets.

A large group of near copies never emits all its pairs: in each band group the
members are first compared with one hub (the member that shares most bands with
most others), then with a random one, and only members that no link has joined
yet are compared further: in small band groups each pair in the first band that
it shares, in large ones exactly and block by block, so that a large group of near
misses never becomes rows of pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import chunk_rows, give_back, id_field, materialise, mix64, out_batch, pick, sized, texts, word_hashes

ROWS, BANDS = 4, 30
SAMPLES = 240  # for the sketch; the bands take the first ROWS * BANDS of them
SKETCH_LONGS = 8
#: Candidates whose sketch estimates less than the threshold minus this are dropped (over 4.5 standard deviations).
SLACK = 0.16
#: Members of a bucket from which on it is compared in blocks; rows and bytes of shingles of a block, shingles taken at once.
LARGE, BLOCK_ROWS, BLOCK_BYTES, BLOCK_COLUMNS = 32, 1024, 8 << 20, 4096
_U = np.uint64
_RNG = np.random.default_rng(20240607)
_FACTOR = _RNG.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)


def shingle_sets(offsets: np.ndarray, data: memoryview, lo: int, hi: int, width: int):
    """The sorted distinct shingle hashes of each row lo..hi (one for a text of fewer words, none without words)."""
    h, counts = word_hashes(offsets, data, lo, hi)
    ends = np.cumsum(counts)
    m = len(h) - width + 1
    roll = np.zeros(max(m, 0), dtype=np.uint64)
    for i in range(width if m > 0 else 0):
        roll += h[i: m + i] * _STEP[i]
    roll = mix64(roll)
    for n, end in zip(counts.tolist(), ends.tolist(), strict=True):
        if n >= width:
            yield np.unique(roll[end - n: end - width + 1])
        elif n:
            part = h[end - n: end]
            yield mix64(np.array([(part * _STEP[:n]).sum(dtype=np.uint64) + _U(n)], dtype=np.uint64))
        else:
            yield h[:0]


def min_hashes(s: np.ndarray) -> np.ndarray:
    low = None
    for a in range(0, len(s), 1024):
        part = (_FACTOR[:, None] * s[None, a: a + 1024]).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return mix64(low + np.arange(SAMPLES, dtype=np.uint64))


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    bits = np.bincount((samples >> _U(48)).astype(np.int64) % (64 * SKETCH_LONGS), minlength=64 * SKETCH_LONGS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def most_differing_bits(similarity: float) -> int:
    """Sketch bits that differ, at most, for texts whose estimated similarity is at least ``similarity``."""
    n = 64 * SKETCH_LONGS
    return int(np.ceil(n / 2 * (1 - np.exp(-4 * SAMPLES * (1 - similarity) / n))))


def set_key(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def signatures(base: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, cls, sketch, bands`` of ``(doc_id, text)``; ``cls`` names the set (null if empty)."""
    schema = StructType([id_field(base), StructField("n_shingles", LongType()), StructField("cls", BinaryType()),
                         StructField("sketch", ArrayType(LongType())), StructField("bands", ArrayType(LongType()))])

    def run(batches):
        for batch in batches:
            offsets, data = texts(batch, 1)
            n, cls, sketch, bands = [], [], [], []
            for lo, hi in chunk_rows(offsets):
                for s in shingle_sets(offsets, data, lo, hi, width):
                    n.append(len(s))
                    if not len(s):
                        cls.append(None)
                        sketch.append(None)
                        bands.append(None)
                        continue
                    v = min_hashes(s)
                    cls.append(set_key(s))
                    sketch.append(odd_sketch(v))
                    band = (v[: ROWS * BANDS].reshape(BANDS, ROWS) * _STEP[:ROWS]).sum(axis=1, dtype=np.uint64)
                    bands.append(mix64(band + np.arange(BANDS, dtype=np.uint64)).view(np.int64))
            kind = pa.list_(pa.int64())
            yield out_batch(schema, [batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                                     pa.array(sketch, kind), pa.array(bands, kind)])
        give_back()

    return base.mapInArrow(run, schema)


def _differing(a: Column, b: Column) -> Column:
    out = F.lit(0)
    for i in range(SKETCH_LONGS):
        out = out + F.bit_count(a[i].bitwiseXOR(b[i]))
    return out


def class_texts(base: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``cls, text``: one text of each class in ``wanted`` (``cls, doc``; a class without any id has a null doc)."""
    schema = StructType([StructField("cls", BinaryType()), StructField("text", pick_type())])
    rows = base.join(sized(wanted), base["doc_id"] == wanted["doc"]).select("cls", "text")

    def named(batches):
        for batch in batches:
            offsets, data = texts(batch, 0)
            keys = [set_key(s) if len(s) else None for lo, hi in chunk_rows(offsets)
                    for s in shingle_sets(offsets, data, lo, hi, width)]
            yield out_batch(schema, [pa.array(keys, pa.binary()), batch.column(0)])
        give_back()

    nameless = base.where("doc_id is null").select("text").mapInArrow(named, schema) \
        .join(sized(wanted.where("doc is null").select("cls")), "cls", "left_semi")

    def check(batches):  # a repeated id may carry another text
        for batch in batches:
            offsets, data = texts(batch, 1)
            same = [bool(len(s)) and set_key(s) == c for (lo, hi) in chunk_rows(offsets) for s, c in zip(
                shingle_sets(offsets, data, lo, hi, width), batch.column(0)[lo:hi].to_pylist(), strict=True)]
            yield out_batch(schema, batch.filter(pa.array(same, pa.bool_())).columns)
        give_back()

    return rows.mapInArrow(check, schema).unionAll(nameless).dropDuplicates(["cls"])


def pick_type():
    from pyspark.sql.types import StringType
    return StringType()


def confirmed(pairs: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """The ``(a, b)`` of ``pairs`` with 100 * intersection >= percent * union of the full shingle sets."""
    schema = StructType([StructField("a", BinaryType()), StructField("b", BinaryType())])
    full = pairs.join(members.toDF("b", "text_b"), "b").join(members.toDF("a", "text_a"), "a") \
        .select("a", "b", "text_a", "text_b")

    def run(batches):
        seen: dict[bytes, np.ndarray] = {}
        for batch in batches:
            sides = []
            for key, col in ((0, 2), (1, 3)):
                offsets, data = texts(batch, col)
                sets = []
                for i, k in enumerate(batch.column(key).to_pylist()):
                    if k not in seen:
                        if len(seen) > 256:
                            seen.clear()
                        seen[k] = next(iter(shingle_sets(offsets, data, i, i + 1, width)))
                    sets.append(seen[k])
                sides.append(sets)
            ok = []
            for x, y in zip(*sides, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield out_batch(schema, batch.select([0, 1]).filter(pa.array(ok, pa.bool_())).columns)
        seen.clear()
        give_back()

    return full.mapInArrow(run, schema)


def star(e: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step: neighbours move to the least node that they know of."""
    both = e.unionAll(e.select("b", "a")) if large else e.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    out = both.join(low, F.col("a") == F.col("u"))
    if large:
        out = out.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(out.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` of the graph of ``edges`` (a, b): alternating large and small stars until nothing changes."""
    last = None
    while True:
        edges = materialise(star(star(edges, True), False), "stars")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        last = now


def spanning_links(links: np.ndarray) -> list[tuple[int, int]]:
    """Of a symmetric matrix of links, as many as keep together what it joins (fewer than rows)."""
    out, new = [], np.ones(len(links), dtype=bool)
    for start in range(len(links)):
        stack = [start] if new[start] else []
        new[start] = False
        while stack:
            k = stack.pop()
            found = np.flatnonzero(links[k] & new)
            new[found] = False
            out += [(k, int(x)) for x in found]
            stack += found.tolist()
    return out


def block_links(rows: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """``(a, b)``: links that join what is linked among the ``(bucket, cls, root)`` of large buckets.

    A bucket is dealt into blocks bounded in rows and bytes, each pair of blocks
    is a cell, and a cell compares its full shingle sets exactly by matrix
    products over the shingles that occur twice: near misses cost arithmetic,
    never a row, and of the links found only a spanning forest is returned.
    """
    kept = StructType([StructField("cls", BinaryType()), StructField("set", BinaryType())])

    def sets(batches):
        for batch in batches:
            offsets, data = texts(batch, 1)
            for lo, hi in chunk_rows(offsets):
                found = [x.tobytes() for x in shingle_sets(offsets, data, lo, hi, width)]
                yield out_batch(kept, [batch.column(0).slice(lo, hi - lo), pa.array(found, pa.binary())])
        give_back()

    wanted = members.join(rows.select("cls").distinct(), "cls", "left_semi").select("cls", "text")
    own = materialise(wanted.mapInArrow(sets, kept).withColumn("bytes", F.octet_length("set")), "sets")
    sized_rows = rows.select("bucket", "cls", "root").join(own.select("cls", "bytes"), "cls")
    blocks = sized_rows.groupBy("bucket").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("bytes") / BLOCK_BYTES)).alias("blocks"))
    dealt = sized_rows.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = dealt.join(own.select("cls", "set"), "cls").select(
        "bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "cls", "root", "set")
    schema = StructType([StructField("a", BinaryType()), StructField("b", BinaryType())])

    def compare(table: pa.Table) -> pa.Table:
        give_back()
        cls, root = table.column("cls").to_pylist(), table.column("root").to_pylist()
        block, own_sets = table.column("block").to_numpy(), [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
        size = np.array([len(x) for x in own_sets])
        _, number, n = np.unique(np.concatenate(own_sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(size)), size)
        twice = n[number] > 1
        row, column = row[twice], (np.cumsum(n > 1) - 1)[number[twice]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((len(size), len(size)), dtype=np.float32)
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, BLOCK_COLUMNS):
            a, b = np.searchsorted(column, [at, at + BLOCK_COLUMNS])
            m = np.zeros((len(size), min(BLOCK_COLUMNS, int(column[-1]) + 1 - at)), dtype=np.float32)
            m[row[a:b], column[a:b] - at] = 1
            common += m @ m.T
        common = common.astype(np.float64)
        near = 100 * common >= percent * (size[:, None] + size - common)
        roots = np.unique(np.array(root, dtype=object).astype("S"), return_inverse=True)[1]
        near &= roots[:, None] != roots
        if block.min() != block.max():  # a pair within one block belongs to that block's own cell
            near &= block[:, None] != block
        found = spanning_links(near)
        return pa.Table.from_batches([out_batch(schema, [pa.array([min(cls[i], cls[j]) for i, j in found], pa.binary()),
                                                         pa.array([max(cls[i], cls[j]) for i, j in found], pa.binary())])])

    return cells.groupBy("bucket", "lo", "hi").applyInArrow(compare, schema).distinct()


def _first_common_band(a: Column, b: Column) -> Column:
    return F.array_position(F.zip_with(a, b, lambda x, y: x == y), True) - 1


def class_components(base: DataFrame, classes: DataFrame, width: int, percent: int, hub_rounds: int = 2) -> DataFrame:
    """``cls, root`` for the classes that are linked with another; ``classes`` has ``cls, doc, sketch, bands``."""
    nodes = classes.select("cls", F.posexplode("bands").alias("band", "value")) \
        .select(F.xxhash64("band", "value").alias("bucket"), "band", "cls")
    shared = nodes.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = materialise(nodes.join(shared, "bucket"), "buckets")
    weight = buckets.groupBy("cls").agg(F.sum("n").alias("weight"))
    wanted = materialise(classes.select("cls", "doc", "sketch", "bands").join(weight, "cls"), "wanted")
    members = materialise(class_texts(base, wanted.select("cls", "doc"), width), "members")
    left = buckets.select("bucket", "band", "cls").join(wanted.select("cls", "sketch", "bands", "weight"), "cls") \
        .withColumn("root", F.col("cls"))
    left = all_members = materialise(left, "members-by-band")
    limit = most_differing_bits(percent / 100 - SLACK)
    linked = checked = None
    for turn in range(hub_rounds + 1):
        if turn < hub_rounds:
            first = -F.col("weight") if turn == 0 else F.xxhash64("bucket", "cls")
            other = left.groupBy("bucket").agg(F.min(F.struct(first.alias("f"), "cls", "sketch", "root")).alias("hub")) \
                .select(F.col("bucket").alias("rb"), F.col("hub.cls").alias("rc"), F.col("hub.sketch").alias("rs"),
                        F.col("hub.root").alias("rr"))
            apart = F.col("root") != F.col("rr")
        else:
            large = materialise(left.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > LARGE).select("bucket"), "large")
            blocked = materialise(block_links(left.join(sized(large), "bucket"), members, width, percent), "block-links")
            linked = linked.unionAll(blocked)
            left = left.join(sized(large), "bucket", "left_anti")
            other = left.select(F.col("bucket").alias("rb"), F.col("cls").alias("rc"), F.col("sketch").alias("rs"),
                                F.col("root").alias("rr"), F.col("bands").alias("rx"))
            apart = (F.col("root") != F.col("rr")) & (F.col("cls") < F.col("rc"))
        near = apart & (_differing(F.col("sketch"), F.col("rs")) <= limit)
        if turn == hub_rounds:
            near = near & (_first_common_band(F.col("bands"), F.col("rx")) == F.col("band"))
        pairs = left.join(other, (F.col("bucket") == F.col("rb")) & near) \
            .select(F.least("cls", "rc").alias("a"), F.greatest("cls", "rc").alias("b")).distinct()
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        found = materialise(confirmed(pairs, members, width, percent), "links")
        linked = found if linked is None else linked.unionAll(found)
        checked = pairs if checked is None else checked.unionAll(pairs)
        if turn == hub_rounds:
            break
        # not always the components yet, but a step keeps them and joins what the hubs have linked so far
        linked = materialise(star(star(linked, True), False), "joined")
        near_roots = materialise(linked.groupBy("a").agg(F.min("b").alias("r")), "near-roots")
        now = all_members.drop("root").join(sized(near_roots.toDF("cls", "r")), "cls", "left") \
            .withColumn("root", F.coalesce("r", "cls")).drop("r")
        many = now.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y")
        left = materialise(now.join(many.select("bucket"), "bucket"), "open")
    return connected(linked).toDF("cls", "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents are linked if 100 * |A and B| >= percent * |A or B| of their
    sets of distinct ``width``-word shingles (A-Z lower-cased; a text of fewer
    words is one shingle); a component is what links reach, its id the
    smallest doc_id in it, and ``kept`` is doc_id = component_id.  Null, empty
    and wordless texts have no shingles and stay alone.  Rows that repeat an id
    keep one row each; with equal texts they share component and fate.  A row
    without an id is kept if it stays alone, or as the one row of a component
    in which no row has an id (its component_id is null then).  Links
    are found by bands (a pair at the threshold is missed with probability
    under 2e-7) and always confirmed on the full sets.
    """
    base = pick(docs, id_col, text_col)
    sigs = signatures(base, width).withColumn("row", F.monotonically_increasing_id())
    sigs = materialise(sigs, "signatures")
    classes = materialise(
        sigs.where("cls is not null").groupBy("cls").agg(
            F.min(F.struct(F.isnull("doc_id").alias("nameless"), "doc_id", "row", "sketch", "bands")).alias("x"),
            F.count("*").alias("n"))
        .select("cls", F.col("x.doc_id").alias("doc"), F.col("x.row").alias("row"), F.col("x.sketch").alias("sketch"),
                F.col("x.bands").alias("bands"), "n"), "classes")
    roots = class_components(base, classes.drop("n", "row"), width, percent)
    rooted = classes.select("cls", "doc", "row", "n").join(sized(roots), "cls", "left") \
        .where("n > 1 or root is not null").withColumn("root", F.coalesce("root", "cls"))
    rooted = materialise(rooted.select("cls", "doc", "row", "root"), "rooted")
    # without any id in a component, the first row of its classes is the one that is kept
    first = rooted.groupBy("root").agg(F.min("doc").alias("component_id"), F.min("row").alias("first_row"))
    known = materialise(rooted.join(first, "root").select("cls", "component_id", "first_row"), "components")
    alone = F.col("first_row").isNull()
    nameless = alone | (F.col("component_id").isNull() & (F.col("row") == F.col("first_row")))
    return sigs.select("doc_id", "n_shingles", "cls", "row").join(sized(known), "cls", "left").select(
        "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("doc_id").isNull(), nameless).otherwise(alone | (F.col("component_id") == F.col("doc_id"))).alias("kept"))
