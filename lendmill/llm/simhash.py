"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints within ``distance`` bits agree on at least one of ``distance + 1`` bit segments.
Each (segment, value) is an upper node of the index: a masked bit pattern shared by its whole
group. Inside a node the fingerprints are sorted by Gray rank, so that neighbours share many
bits; nodes of eight neighbours, eight such nodes and so on keep the bits all their members
share (mask and pattern). The self-join walks pairs of nodes from the top, adds up the
differences in shared bits, and drops whole groups once these exceed the distance.

Only distinct fingerprints are joined; each task returns a spanning forest of its links, so the
number of edges never grows with the square of a group. A node with more than ``group_rows``
members is cut into ranges of Gray rank; range pairs whose shared bits already differ too much
are pruned by a join on mask and pattern before any member is sent to them.

Defined results: null text is the empty text; texts without a word have fingerprint zero, which
links like any other; repeated rows share a fingerprint; a null doc_id never names a component
unless no member has an id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm.components import components
from lendmill.llm.names import all_columns, unused
from lendmill.session import materialise

BITS = 64
FAN = 8  # members of an index node


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of the word shingles, repeats included; zero without a word."""
    words = text.split()  # for bytes: the blank and 0x09 to 0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - np.diff(ends, prepend=0)).tolist()
    ends = (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    width = min(shingle, len(words))
    n = len(words) - width + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for any length
        h = np.array([digest(joined[a:b], seed) for a, b in
                      zip(starts[at:at + (1 << 16)][:n - at], ends[at + width - 1:])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", keep=("doc_id",),
                      shingle: int = 4) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed 64-bit number."""
    keep = list(keep)
    lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint((t.as_py() or "").encode().translate(lower), shingle)
                              for t in batch.column("_text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keep], pa.array(found.view(np.int64))],
                names=[*keep, "fp"])

    source = docs.select(*keep, F.col(text).alias("_text"))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return source.mapInArrow(run, ", ".join([*schema, "fp bigint"]))


def hex_digits(fp="fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


def _nodes(group: np.ndarray, first: np.ndarray, pattern: np.ndarray, mask: np.ndarray):
    """Join up to FAN neighbours of one group into a node; returns the level above."""
    start = np.zeros(len(group), np.int64)
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    start[new] = np.flatnonzero(new)
    within = np.arange(len(group)) - np.maximum.accumulate(start)
    heads = np.flatnonzero(within % FAN == 0)
    # a bit is shared where no member lacks it and all patterns agree
    low = np.bitwise_and.reduceat(pattern & mask, heads)
    high = np.bitwise_or.reduceat(pattern & mask, heads)
    shared = np.bitwise_and.reduceat(mask, heads) & ~(low ^ high)
    return group[heads], heads, low & shared, shared


def links(group: np.ndarray, codes: np.ndarray, distance: int, side=None):
    """Indices (i, j) of a spanning forest of all links inside each group.

    ``codes`` are sorted by group and Gray rank. With ``side`` only links between different
    sides are looked for (pairs of ranges of one large group).
    """
    n = len(codes)
    full = np.full(n, ~np.uint64(0))
    levels = [(group, np.arange(n), codes, full)]
    while len(levels[-1][0]) > 1 and (levels[-1][0][1:] == levels[-1][0][:-1]).any():
        levels.append(_nodes(*levels[-1]))
    label = np.arange(n)
    top = np.arange(len(levels[-1][0]))
    queue = [(len(levels) - 1, top, top)]
    while queue:
        depth, a, b = queue.pop()
        _, _, pattern, mask = levels[depth]
        both = mask[a] & mask[b]
        near = np.bitwise_count((pattern[a] ^ pattern[b]) & both) <= distance
        a, b = a[near], b[near]
        if depth == 0:
            real = a != b
            a, b = a[real], b[real]
            if side is not None:
                cross = side[a] != side[b]
                a, b = a[cross], b[cross]
            label = _joined(label, a, b)
            continue
        heads = levels[depth][1]
        stop = np.append(heads[1:], len(levels[depth - 1][0]))
        # pairs of children; a node meets itself as a triangle
        na, nb = stop[a] - heads[a], stop[b] - heads[b]
        if depth == 1:  # leaves that are one component already
            uniform = np.minimum.reduceat(label, heads) == np.maximum.reduceat(label, heads)
            done = uniform[a] & uniform[b] & (label[heads[a]] == label[heads[b]])
            a, b, na, nb = a[~done], b[~done], na[~done], nb[~done]
        pieces = max(1, int((na * nb).sum()) >> 20)
        order = np.argsort(a != b, kind="stable")  # neighbours first: they join most groups
        for part in reversed(np.array_split(order, pieces)):
            pa_, pb_, size = a[part], b[part], (na * nb)[part]
            at = np.repeat(np.arange(len(part)), size)
            k = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
            ca = heads[pa_][at] + k // nb[part][at]
            cb = heads[pb_][at] + k % nb[part][at]
            keep = ca <= cb
            queue.append((depth - 1, ca[keep], cb[keep]))
    j = np.flatnonzero(label != np.arange(n))
    return label[j], j


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge classes along links; every class is named by its least member."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return label
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def segments(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of distance + 1 bit segments that cover all 64 bits."""
    cuts = [BITS * i // (distance + 1) for i in range(distance + 2)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def gray_column(fp: str):
    rank = F.col(fp)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank


def _forest_of(members: DataFrame, distance: int) -> DataFrame:
    """Forests of all groups (segment, value, a, b); several groups share a vectorised step."""
    key = ["segment", "value", "a", "b"]

    def solve(table: pa.Table):
        part = {k: table.column(k).to_numpy() for k in [*key, "side"]}
        codes = table.column("fp").to_numpy().view(np.uint64)
        new = np.ones(len(codes), bool)
        new[1:] = np.logical_or.reduce([part[k][1:] != part[k][:-1] for k in key])
        side = part["side"] if (part["a"] != part["b"]).any() else None
        i, j = links(np.cumsum(new), codes, distance, side)
        codes = codes.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(codes[i]), pa.array(codes[j])],
                                          names=["u", "v"])

    def run(batches):
        held = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            if sum(map(len, held)) < 1 << 16:
                continue
            table = pa.Table.from_batches(held)
            last = [table.column(k)[len(table) - 1] for k in key]
            flags = np.logical_and.reduce([table.column(k).to_numpy() == v.as_py()
                                           for k, v in zip(key, last)])
            cut = int(np.argmax(flags))  # the last group may go on in the next batch
            if cut:
                yield solve(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield solve(pa.Table.from_batches(held))

    return members.select(*key, "side", "fp").repartition(*key) \
        .sortWithinPartitions(*key, gray_column("fp")).mapInArrow(run, "u bigint, v bigint")


def _ranged(members: DataFrame, rows: int, group_rows: int) -> DataFrame:
    """Members of large nodes with ``block``: consecutive Gray ranks, at most ``group_rows``."""
    def run(batches):
        node, size, block = None, 0, 0
        for batch in batches:
            seg, val, fp, gray = (batch.column(k).to_pylist() for k in batch.schema.names)
            out = []
            for key, g in zip(zip(seg, val), gray):
                if key != node or size >= group_rows:
                    node, size, block = key, 0, g  # a rank starts one block of a node at most
                size += 1
                out.append(block)
            yield pa.RecordBatch.from_arrays(
                [batch.column("segment"), batch.column("value"), pa.array(out, pa.int64()),
                 batch.column("fp")], names=["segment", "value", "block", "fp"])

    return members.select("segment", "value", "fp", gray_column("fp").alias("gray")) \
        .repartitionByRange(max(1, -(-rows // group_rows)), "segment", "value", "gray") \
        .sortWithinPartitions("segment", "value", "gray") \
        .mapInArrow(run, "segment int, value bigint, block bigint, fp bigint")


def forest(codes: DataFrame, distance: int = 4, group_rows: int = 20_000) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints ``fp`` linked within ``distance``."""
    upper = F.explode(F.array(*[
        F.struct(F.lit(i).alias("segment"), F.shiftrightunsigned("fp", lo).bitwiseAND(
            F.lit((1 << width) - 1)).cast("bigint").alias("value"))
        for i, (lo, width) in enumerate(segments(distance))]))
    members = codes.select("fp", upper.alias("node")).select("node.segment", "node.value", "fp")
    node = ["segment", "value"]
    large = materialise(members.groupBy(*node).agg(F.count("*").alias("n"))
                        .where(F.col("n") > group_rows), "simhash-large")
    zero = F.lit(0).cast("bigint")
    rows = large.agg(F.sum("n")).first()[0]
    if rows is None:
        return _forest_of(members.withColumns({"a": zero, "b": zero, "side": F.lit(0)}), distance)
    small = members.join(large, node, "left_anti") \
        .select(*node, zero.alias("a"), zero.alias("b"), F.lit(0).alias("side"), "fp")
    ranged = materialise(_ranged(members.join(large, node, "left_semi"), rows, group_rows),
                         "simhash-ranged")
    blocks = ranged.groupBy(*node, "block").agg(
        F.bit_and("fp").alias("low"), F.bit_or("fp").alias("high")) \
        .select(*node, "block", F.col("low").alias("pattern"),
                F.bitwise_not(F.expr("low ^ high")).alias("mask"))
    left = blocks.select(*node, F.col("block").alias("a"), F.col("pattern").alias("pa"),
                         F.col("mask").alias("ma"))
    right = blocks.select(*node, F.col("block").alias("b"), F.col("pattern").alias("pb"),
                          F.col("mask").alias("mb"))
    pairs = left.join(right, node).where(
        f"a <= b and bit_count((pa ^ pb) & ma & mb) <= {distance}").select(*node, "a", "b")
    first = ranged.join(pairs.withColumn("block", F.col("a")), [*node, "block"]) \
        .select(*node, "a", "b", F.lit(0).alias("side"), "fp")
    second = ranged.join(pairs.where("a <> b").withColumn("block", F.col("b")), [*node, "block"]) \
        .select(*node, "a", "b", F.lit(1).alias("side"), "fp")
    # a step looks at sides or at whole groups, so the two kinds never share a call
    return _forest_of(small.union(first.where("a = b")), distance).union(_forest_of(
        first.where("a <> b").union(second), distance))


def near_duplicates(docs: DataFrame, distance: int = 4, shingle: int = 4, text: str = "text",
                    doc_id: str = "doc_id", keep=(), group_rows: int = 20_000) -> DataFrame:
    """Every row's (doc_id, keep..., fp, root, component_id): the least fingerprint of the
    component and the least linked id."""
    prints = materialise(with_fingerprints(docs.withColumn("_id", F.col(doc_id)), text,
                                           ["_id", *keep], shingle), "simhash-prints")
    codes = materialise(prints.groupBy("fp").agg(F.min("_id").alias("least")), "simhash-codes")
    roots = components(forest(codes.select("fp"), distance, group_rows), "simhash-edges")
    linked = codes.join(roots, codes["fp"] == roots["node"]).select("fp", "root", "least")
    named = linked.join(linked.groupBy("root").agg(F.min("least").alias("component_id")), "root") \
        .select("fp", "root", "component_id")
    named = codes.join(named, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id"))
        .alias("component_id"))
    return prints.join(named, "fp").select(F.col("_id").alias(doc_id), *keep, "fp", "root",
                                           "component_id")


def one_of_each(docs: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """All columns of one row per component: the least doc_id, ties by a hash of the row."""
    row = unused(docs, "_row")
    keyed = docs.withColumn(row, F.xxhash64(*all_columns(docs)))
    found = near_duplicates(keyed, distance, shingle, keep=[row])
    first = found.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", row)).alias("first"))
    kept, chosen = unused(docs, "_kept"), unused(docs, "_chosen")
    first = first.select(F.col("first.doc_id").alias(kept), F.col(f"first.{row}").alias(chosen))
    both = keyed.join(first, F.col("doc_id").eqNullSafe(F.col(kept))
                      & (F.col(row) == F.col(chosen)))
    return both.dropDuplicates(["doc_id", row]).select(*all_columns(docs))
