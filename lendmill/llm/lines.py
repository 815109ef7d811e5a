"""Line dedup: a segment-partition edit join over all distinct lines of a corpus.

Two lines link when their edit distance (code points) is at most ``distance``. Each line is cut
into distance + 1 segments; if two lines link, some segment of the shorter one stands unchanged
in the longer one, near its old place. So a line indexes its own segments under its length and
probes, for every length it can link to, the substrings that may equal a segment there (positions
narrowed by what the other segments allow). Equal keys give candidates, and every candidate is
verified with a banded bit-parallel edit distance. Linked lines form classes; the first line of a
class (by doc_id, then position) stays, all others are removed.

Keys travel as packed arrays, so Spark shuffles a few rows per task and bucket. A first pass
counts the entries of each key from per-task totals; keys with more than ``busy`` entries count
as shared, the others are looked up bucket by bucket. Only lines under a shared key travel as
text, one row per line and shared key, and meet under that key: candidates are compared where
they meet, and a task returns a spanning forest of its links, never pairs. A key with more than
``block_rows`` lines is dealt again by (key, segment of what is left of a line without the shared
one); what is still together then meets as pairs of blocks, the only step whose work grows
faster than its rows (lines that agree in two segments, in blocks of ``block_rows``).

Defined results: lines are trimmed; blank lines are kept and not counted; lines shorter than
``min_length`` code points are linked only to equal lines; a null text has no lines; rows are
ordered by doc_id (null last), repeated ids by their place in the input; lines of any length are
compared whole; an empty table gives an empty table; extra columns stay, also under names that
the operator uses itself.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm.components import components
from lendmill.llm.names import unused
from lendmill.llm.prefilter import bitmap, present
from lendmill.llm.text import Rolling, mix
from lendmill.session import materialise

STEP = 1 << 21
BLANKS = " \t\n\r\x0b\x0c"


def pieces(text: str | None) -> list[str]:
    return [x.strip(BLANKS) for x in (text or "").split("\n")]


def identity(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode())


class Points:
    """Code points of several lines in one array, with hashes of any ranges."""

    def __init__(self, lines: list[str], rolling: Rolling | None = None):
        self.size = np.fromiter(map(len, lines), np.int64, len(lines))
        self.start = np.cumsum(self.size) - self.size
        self.code = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
        rolling = rolling or Rolling()
        rolling.reserve(len(self.code) + 1)
        value = mix(self.code.astype(np.uint64) + np.uint64(0x51ED270B))
        self.prefix = np.zeros(len(self.code) + 1, np.uint64)
        np.cumsum(value * rolling.power[:len(self.code)], out=self.prefix[1:])
        self.rolling = rolling

    def keys(self, rows, at, length, salt) -> np.ndarray:
        a = self.start[rows] + at
        return mix(self.rolling.ranges(self.prefix, a, a + length) ^ mix(salt.astype(np.uint64)))


def cuts(size: np.ndarray, i: int, distance: int):
    """Start and length of segment i of an even partition; later segments take the remainder."""
    parts = distance + 1
    base, longer = size // parts, size % parts
    first = parts - longer
    return base * i + np.maximum(i - first, 0), base + (i >= first)


def signatures(points: Points, distance: int, rows: np.ndarray):
    """((rows, keys, at, length) of the indexed segments, the same of the probes)."""
    size = points.size[rows]
    index, probe = [], []
    for i in range(distance + 1):
        at, length = cuts(size, i, distance)
        index.append((rows, points.keys(rows, at, length, size * 64 + i), at, length))
        for shorter in range(distance + 1):
            target = size - shorter
            at, length = cuts(target, i, distance)
            low = max(-i, shorter - (distance - i))
            high = min(i, shorter + (distance - i))
            for shift in range(low, high + 1):
                if shorter == 0 and shift == 0:
                    continue  # the indexed segment itself
                ok = (target >= 0) & (at + shift >= 0) & (at + shift + length <= size)
                probe.append((rows[ok], points.keys(rows[ok], at[ok] + shift, length[ok],
                                                    target[ok] * 64 + i), at[ok] + shift,
                              length[ok]))
    join = lambda parts: tuple(np.concatenate([p[k] for p in parts]) for k in range(4))
    return join(index), join(probe)


def matches(ikey, irow, pkey, prow):
    """Pairs of rows that share a key, an indexed segment on one side at least."""
    order = np.argsort(ikey, kind="stable")
    ikey, irow = ikey[order], irow[order]

    def pair(key, row, low):
        size = np.searchsorted(ikey, key, "right") - low
        at = np.repeat(np.arange(len(key)), size)
        k = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
        return row[at], irow[low[at] + k]

    a1, b1 = pair(ikey, irow, np.arange(len(ikey)))  # each equal key behind it, and itself
    a2, b2 = pair(pkey, prow, np.searchsorted(ikey, pkey, "left"))
    a, b = np.concatenate([a1, a2]), np.concatenate([b1, b2])
    differ = a != b
    a, b = a[differ], b[differ]
    return np.minimum(a, b), np.maximum(a, b)


def within(left: Points, lrow: np.ndarray, right: Points, rrow: np.ndarray,
           distance: int) -> np.ndarray:
    """Whether each pair is within ``distance``: banded bit-parallel edit distance.

    A 64-bit window slides down the longer line with the column; only the 2 * distance + 1
    diagonals of the band are compared. All pairs advance one column per step.
    """
    n1, n2 = left.size[lrow], right.size[rrow]
    out = np.zeros(len(lrow), bool)
    swap = n1 < n2
    order = np.argsort(np.minimum(n1, n2), kind="stable")
    order = order[np.abs(n1 - n2)[order] <= distance]
    full = ~np.uint64(0)
    one, top = np.uint64(1), np.uint64(63)
    shift = 0 if left is right else len(left.code)
    both = np.concatenate([left.code, [0]] if left is right else [left.code, right.code, [0]])
    end = len(both) - 1  # stands for rows outside the line
    for at in range(0, len(order), 8192):
        part = order[at:at + 8192]
        s = swap[part]
        len1, len2 = np.maximum(n1[part], n2[part]), np.minimum(n1[part], n2[part])
        start_l = left.start[lrow[part]]
        start_r = right.start[rrow[part]] + shift
        p1, p2 = np.where(s, start_r, start_l), np.where(s, start_l, start_r)
        vp = np.full(len(part), full << np.uint64(63 - distance))
        vn = np.zeros(len(part), np.uint64)
        dist = np.full(len(part), distance)
        # lines not longer than the distance: all rows lie in the window's last phase
        short = len1 <= distance
        dist[short] = len1[short]
        live = np.arange(len(part))
        for i in range(int(len2.max(initial=0))):
            live = live[len2[live] > i]
            if not len(live):
                break
            c = both[p2[live] + i]
            eq = np.zeros(len(live), np.uint64)
            for k in range(-distance, distance + 1):
                row = i + k
                ok = (row >= 0) & (row < len1[live])
                same = ok & (both[np.where(ok, p1[live] + row, end)] == c)
                eq |= same.astype(np.uint64) << np.uint64(63 - distance + k)
            v, w = vp[live], vn[live]
            d0 = (((eq & v) + v) ^ v) | eq | w
            hp, hn = w | ~(d0 | v), d0 & v
            over = i - (len1[live] - distance)  # columns past the diagonal phase
            bit = np.where(over >= 0, 62 - over, 63).astype(np.uint64)
            step = np.where(over >= 0, ((hp >> bit) & one).astype(np.int64)
                            - ((hn >> bit) & one).astype(np.int64),
                            1 - ((d0 >> top) & one).astype(np.int64))
            dist[live] += step
            vp[live] = hn | ~((d0 >> one) | hp)
            vn[live] = (d0 >> one) & hp
            if i % 16 == 15:  # the last cell can fall by one a column in the last phase only
                live = live[dist[live] <= 2 * distance]
                dead = dist > 2 * distance
                len2 = np.where(dead, 0, len2)
        out[part] = dist <= distance
    return out


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of everyone's class after joining all links."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        keep = la != lb
        a, b, la, lb = a[keep], b[keep], la[keep], lb[keep]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label = label[label]
    return label


def occurrences(docs: DataFrame, min_length: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, row, at, line, chars, long) of every line that is not blank, and per row one
    record without a line, at -1."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids, rows = batch.column("doc_id"), batch.column("row")
            own, at, line, chars = [], [], [], []
            for i, value in enumerate(batch.column("text")):
                for k, x in enumerate([None, *pieces(value.as_py())], -1):
                    if x or k < 0:
                        own.append(i)
                        at.append(k)
                        line.append(identity(x) if x else None)
                        chars.append(len(x or ""))
            own, chars = pa.array(own, pa.int64()), np.array(chars, np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids.take(own), rows.take(own), pa.array(at, pa.int32()),
                 pa.array(line, pa.binary()), pa.array(chars), pa.array(chars >= min_length)],
                names=["doc_id", "row", "at", "line", "chars", "long"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, row bigint, at int, line binary, chars bigint, long boolean")


def _distinct(batches, min_length: int):
    """Lists of distinct lines, of about STEP code points each."""
    seen, size = {}, 0
    for batch in batches:
        for value in batch.column(0):
            for x in pieces(value.as_py()):
                if len(x) >= min_length and x not in seen:
                    seen[x] = None
                    size += len(x)
            if size >= STEP:
                yield list(seen)
                seen, size = {}, 0
    if seen:
        yield list(seen)


def _keys(lines: list[str], distance: int, rolling: Rolling):
    return signatures(Points(lines, rolling), distance, np.arange(len(lines)))


def _split(bucket: np.ndarray, *columns):
    """Rows (bucket, packed bytes of every column), one per bucket present."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) \
        if len(bucket) else np.zeros(0, np.int64)
    columns = [c[order] for c in columns]
    for lo, hi in zip(heads, np.append(heads[1:], len(bucket))):
        yield int(bucket[lo]), *[c[lo:hi].tobytes() for c in columns]


def _once(key: np.ndarray, row: np.ndarray):
    """The distinct (key, row) pairs: a line that stands in many batches enters once."""
    order = np.lexsort((row, key))
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return key[new], row[new]


def busy_keys(texts: DataFrame, distance: int, min_length: int, buckets: int,
              busy: int) -> DataFrame:
    """Keys (upper halves, as ``gram``) with more than ``busy`` entries in the whole corpus."""
    def count(batches):
        rolling = Rolling()
        for lines in _distinct(batches, min_length):
            index, probe = _keys(lines, distance, rolling)
            key, n = np.unique(np.concatenate([index[1], probe[1]]), return_counts=True)
            rows = list(_split(key % np.uint64(buckets), (key >> np.uint64(32)).astype("<u4"),
                               n.astype("<u4")))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()),
                 pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "keys", "counts"])

    def total(table):
        key = np.frombuffer(b"".join(table.column("keys").to_pylist()), "<u4")
        n = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u4")
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order].astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        many = np.add.reduceat(n, heads) > busy
        return pa.table({"gram": (key[heads][many].astype(np.uint64) << np.uint64(32))
                        .view(np.int64)})

    return texts.mapInArrow(count, "bucket int, keys binary, counts binary") \
        .groupBy("bucket").applyInArrow(total, "gram bigint")


LEVELS = 1        # how often a large key is dealt again by a further segment
SMALL = 24        # lines of a key that are compared all with all


def _names(lines: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(identity(x)[:8], "little") for x in lines], np.uint64)


def _under_keys(lines, index, probe, wanted) -> pa.RecordBatch:
    """(key, rest, body): each line under its wanted keys, once per place of the shared segment;
    the rest is the line without it. ``wanted`` takes keys."""
    row, key, at, length = (np.concatenate([index[k], probe[k]]) for k in range(4))
    hot = wanted(key)
    found = np.unique(np.stack([key[hot], row[hot].astype(np.uint64), at[hot].astype(np.uint64),
                                length[hot].astype(np.uint64)]), axis=1)
    body = [lines[int(r)] for r in found[1]]
    rest = [x[:int(p)] + x[int(p) + int(n):] for x, p, n in zip(body, found[2], found[3])]
    return pa.RecordBatch.from_arrays([pa.array(found[0].view(np.int64)), pa.array(
        rest, pa.string()), pa.array(body, pa.string())], names=["key", "rest", "body"])


def entries(texts: DataFrame, distance: int, min_length: int, buckets: int,
            bits: np.ndarray) -> DataFrame:
    """Packed entries by bucket, and one row (key, rest, body) per line and busy key."""
    names = ["bucket", "ikeys", "irows", "pkeys", "prows", "key", "rest", "body"]

    def run(batches):
        rolling = Rolling()
        for lines in _distinct(batches, min_length):
            index, probe = _keys(lines, distance, rolling)
            name = _names(lines)
            busy = lambda key: present(bits, key >> np.uint64(32) << np.uint64(32))
            packed = {}
            for which, (row, key, _, _) in (("i", index), ("p", probe)):
                cool = ~busy(key)
                for b, *blobs in _split((key % np.uint64(buckets))[cool],
                                        (key[cool] >> np.uint64(32)).astype("<u4"),
                                        name[row[cool]]):
                    packed.setdefault(b, {})[which] = blobs
            hot = _under_keys(lines, index, probe, busy)
            if hot.num_rows:
                none = pa.nulls(hot.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(hot.num_rows, pa.int32()), none, none, none, none, *hot.columns],
                    names=names)
            rows = [(b, *(x.get("i") or (b"", b"")), *(x.get("p") or (b"", b"")))
                    for b, x in packed.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()),
                 *[pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 5)],
                 pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.string()),
                 pa.nulls(len(rows), pa.string())], names=names)

    return texts.mapInArrow(run, "bucket int, ikeys binary, irows binary, pkeys binary, "
                                 "prows binary, key bigint, rest string, body string")


def shared(packed: DataFrame) -> DataFrame:
    """(gram, name): the lines under keys that several lines share, one of them with its own
    segment; ``gram`` is the key's upper half. Linear in the entries."""
    def run(table):
        read = lambda k, t: np.frombuffer(b"".join(table.column(k).to_pylist()), t)
        ikey, irow = _once(read("ikeys", "<u4"), read("irows", "<u8"))
        pkey, prow = _once(read("pkeys", "<u4"), read("prows", "<u8"))
        key, row = _once(np.concatenate([ikey, pkey]), np.concatenate([irow, prow]))
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) \
            else np.zeros(0, np.int64)
        size = np.diff(np.append(heads, len(key)))
        many = (size > 1) & np.isin(key[heads], ikey)
        keep = np.repeat(many, size)
        return pa.table({"gram": (key[keep].astype(np.uint64) << np.uint64(32)).view(np.int64),
                         "name": row[keep].view(np.int64)})

    return packed.groupBy("bucket").applyInArrow(run, "gram bigint, name bigint")


def under_keys(texts: DataFrame, distance: int, min_length: int, names: np.ndarray,
               grams: np.ndarray) -> DataFrame:
    """(key, rest, body) of the lines and keys that two bitmaps let through."""
    def run(batches):
        rolling = Rolling()
        for lines in _distinct(batches, min_length):
            keep = np.flatnonzero(present(names, _names(lines)))
            if len(keep):
                lines = [lines[int(i)] for i in keep]
                index, probe = _keys(lines, distance, rolling)
                yield _under_keys(lines, index, probe, lambda key: present(
                    grams, key >> np.uint64(32) << np.uint64(32)))

    return texts.mapInArrow(run, "key bigint, rest string, body string")


def _all_pairs(start: np.ndarray, size: np.ndarray):
    """Pairs of places inside each group of a few places."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in np.unique(size[size > 1]):
        first = start[size == n][:, None]
        x, y = np.triu_indices(int(n), 1)
        a.append((first + x).ravel())
        b.append((first + y).ravel())
    return np.concatenate(a), np.concatenate(b)


def forest(table: pa.Table, distance: int) -> pa.RecordBatch:
    """Links (u, v) that connect the lines within the distance, of whole keys in key order."""
    key = table.column("key").to_numpy()
    lines, place = np.unique(np.array(table.column("body").to_pylist(), object),
                             return_inverse=True)
    lines = list(lines)
    whole = Points(lines)
    label = np.arange(len(lines))
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(heads, len(key)))

    def link(a, b):
        """Pairs already in one class need no check."""
        nonlocal label
        for lo in range(0, len(a), 1 << 18):
            x, y = place[a[lo:lo + (1 << 18)]], place[b[lo:lo + (1 << 18)]]
            todo = label[x] != label[y]
            x, y = np.minimum(x[todo], y[todo]), np.maximum(x[todo], y[todo])
            if len(x):
                x, y = np.unique(np.stack([x, y]), axis=1)
            ok = within(whole, x, whole, y, distance)
            label = roots(len(lines), np.concatenate([label, x[ok]]),
                          np.concatenate([np.arange(len(lines)), y[ok]]))

    little = size <= SMALL
    link(*_all_pairs(heads[little], size[little]))
    for start, n in zip(heads[~little], size[~little]):
        rest = Points(table.column("rest").slice(int(start), int(n)).to_pylist())
        index, probe = signatures(rest, distance, np.arange(int(n)))
        a, b = matches(index[1], index[0], probe[1], probe[0])
        link(start + a, start + b)
    j = np.flatnonzero(label != np.arange(len(lines)))
    u, v = [identity(lines[int(i)]) for i in label[j]], [identity(lines[int(i)]) for i in j]
    return pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())],
                                      names=["u", "v"])


def key_links(rows: DataFrame, distance: int) -> DataFrame:
    """Forests of the links under each key; a task takes whole keys, some at a time."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            key = table.column("key").to_numpy()
            last = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0
            # the last key may go on in the next batch
            if last and size + last >= STEP // 64:
                yield forest(pa.concat_tables([*held, table.slice(0, last)]), distance)
                held, size = [table.slice(last)], len(key) - last
            else:
                held.append(table)
                size += len(key)
        if size:
            yield forest(pa.concat_tables(held), distance)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "u binary, v binary")


def further(rows: DataFrame, distance: int) -> DataFrame:
    """Rows dealt again: (key and a segment of the rest, what is left of the rest, body)."""
    def run(batches):
        rolling = Rolling()
        for batch in batches:
            rest, body = batch.column("rest").to_pylist(), batch.column("body").to_pylist()
            own = batch.column("key").to_numpy().view(np.uint64)
            index, probe = _keys(rest, distance, rolling)
            row, key, at, length = (np.concatenate([index[k], probe[k]]) for k in range(4))
            key = mix(key ^ mix(own[row]))
            left = [rest[r][:p] + rest[r][p + n:] for r, p, n in zip(
                row.tolist(), at.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(left, pa.string()),
                 pa.array([body[r] for r in row.tolist()], pa.string())],
                names=["key", "rest", "body"])

    return rows.mapInArrow(run, rows.schema).distinct()


def block_links(rows: DataFrame, distance: int, block_rows: int) -> DataFrame:
    """Forests of the links under keys whose lines agree in all segments dealt by: pairs of
    blocks, each row once for every block of its key."""
    blocks = rows.groupBy("key").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    dealt = rows.join(blocks, "key").withColumn(
        "own", F.pmod(F.xxhash64("body", "rest"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other).select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"),
        "rest", "body")
    return key_links(dealt, distance)


def links(docs: DataFrame, count: int, distance: int = 2, min_length: int = 24, busy: int = 256,
          bucket_rows: int = 1 << 20, block_rows: int = 2000, text: str = "text") -> DataFrame:
    """Edges (u, v) between line identities that connect all linked lines; ``count`` lines."""
    texts = docs.select(F.col(text).alias("text"))
    per_line = 4 * (distance + 1)
    buckets = max(1, -(-count * per_line // bucket_rows))
    # bounded by the bitmap's size, however many keys are busy
    bits = bitmap(busy_keys(texts, distance, min_length, buckets, busy))
    found = materialise(entries(texts, distance, min_length, buckets, bits), "lines-entries")
    meet = materialise(shared(found.where("bucket is not null")
                              .select("bucket", "ikeys", "irows", "pkeys", "prows")), "lines-shared")
    names, grams = bitmap(meet.select(F.col("name").alias("gram"))), bitmap(meet.select("gram"))
    rows = found.where("bucket is null").select("key", "rest", "body").union(
        under_keys(texts, distance, min_length, names, grams)).distinct()
    out = []
    for level in range(LEVELS + 1):
        rows = materialise(rows, "lines-keys")
        sizes = rows.groupBy("key").agg(F.count("*").alias("n"))
        large = materialise(sizes.where(F.col("n") > block_rows).select("key"), "lines-large")
        out.append(key_links(rows.join(large, "key", "left_anti"), distance))
        if large.isEmpty():
            break
        rows = rows.join(large, "key")
        if level < LEVELS:
            rows = further(rows, distance)
        else:
            out.append(block_links(rows, distance, block_rows))
    return reduce(DataFrame.union, out)


def judged(docs: DataFrame, distance: int = 2, min_length: int = 24, doc_id: str = "doc_id",
           text: str = "text", **options) -> tuple[DataFrame, DataFrame]:
    """Every line that is not blank: (row, at, chars, first_of_line, kept); and every input row:
    (row, doc_id)."""
    seen = materialise(occurrences(docs, min_length, doc_id, text), "lines-seen")
    rows, seen = seen.where("at < 0").select("row", "doc_id"), seen.where("at >= 0")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row", "at")
    own = materialise(seen.groupBy("line").agg(F.min(place).alias("first"),
                                               F.max("long").alias("long")), "lines-distinct")
    count = own.where("long").count()
    classes = components(links(docs, count, distance, min_length, text=text, **options), "lines")
    linked = own.join(classes.withColumnRenamed("node", "line"), "line").select(
        "line", "root", "first")
    least = linked.groupBy("root").agg(F.min("first").alias("class_first"))
    named = linked.join(least, "root").select("line", "class_first")
    own = own.join(named, "line", "left").select(
        "line", "first", F.coalesce("class_first", "first").alias("class_first"))
    return seen.join(own, "line").select(
        "row", "at", "chars", (place == F.col("first")).alias("first_of_line"),
        (place == F.col("class_first")).alias("kept")), rows


def summary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: doc_id, n_lines, n_equal (equal to an earlier line), n_near (removed as near
    another line only), kept_chars."""
    lines, rows = judged(docs, doc_id=doc_id, text=text, **options)
    lines = lines.groupBy("row").agg(
        F.count("*").alias("n_lines"), F.count_if(~F.col("first_of_line")).alias("n_equal"),
        F.count_if(F.col("first_of_line") & ~F.col("kept")).alias("n_near"),
        F.sum(F.when(F.col("kept"), F.col("chars")).otherwise(0)).alias("kept_chars"))
    zero = F.lit(0).cast("bigint")
    return rows.join(lines, "row", "left").select(
        "doc_id", *[F.coalesce(x, zero).alias(x)
                    for x in ("n_lines", "n_equal", "n_near", "kept_chars")])


def cleaned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All columns of every row, its text without the removed lines (blank lines stay)."""
    row, drop = unused(docs, "_row"), unused(docs, "_gone")
    stored = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "lines-input")
    keyed = stored.select(F.struct(F.col(doc_id).isNull().alias("unnamed"), F.col(doc_id).alias(
        "name"), F.col(row).alias("own")).alias("doc_id"), F.col(text).alias("text"))
    lines, rows = judged(keyed, **options)
    gone = lines.where(~F.col("kept")).groupBy("row").agg(F.collect_set("at").alias(drop))
    gone = rows.join(gone, "row").select(F.col("doc_id.own").alias(row), drop)
    parts = F.split(text, "\n")
    body = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(drop, i)), "\n")
    return stored.join(gone, row, "left").withColumn(
        text, F.when(F.col(drop).isNull(), F.col(text)).otherwise(body)).drop(row, drop)
