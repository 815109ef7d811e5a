"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Texts are lower-cased and read as tokens: runs of letters and digits, so case, punctuation and
line breaks do not matter. Test items are cut into passages of at most ``passage`` tokens that
overlap by half, so a leaked part that straddles two passages fills enough of one.

Seeds are the rare n-grams of a passage: those found in at most the square root of the number of
documents, and of any ``window`` neighbouring ones that occur at all the rarest (ties all). A
copy is thus seeded if it keeps one rare n-gram, or n + window - 1 tokens in a row however common
they are; an item that leaked into very many documents keeps its seeds, while phrases that every
text has yield to their rarer neighbours. A scan counts the documents of the benchmark's n-grams,
a second one cuts the regions around seed hits out of the documents, seeds join them to passages,
and every joined pair is aligned whose region holds enough of the passage's tokens to reach the
threshold at all. Score: best local alignment (match 2, mismatch and gap -1) as a share of the
passage's perfect score.

The scans test n-grams against bitmaps of fixed size before anything is shuffled; the join on
the n-gram itself is exact, and an n-gram of very many documents is dealt over several tasks.
Whole texts are read; a region is as long as its hits make it.

Defined results: null and empty texts and items hit nothing; items with fewer tokens than n use
all their tokens as one seed; repeated rows give one result per (doc_id, item_id); empty tables
give none; other columns of either table are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendmill.llm.names import unused
from lendmill.llm.prefilter import bitmap, present
from lendmill.llm.text import Rolling, mix, steps, utf8, words
from lendmill.session import materialise

DEAL_DOCS = 20_000    # regions of one n-gram that meet its passages in one task, about
MOST_DEALT = 100_000  # n-grams listed for dealing; the others are in fewer documents


def separators() -> np.ndarray:
    """Per byte value: true for ASCII that is neither a letter nor a digit."""
    code = np.arange(256)
    return ~((code >= 128) | ((code >= 97) & (code <= 122)) | ((code >= 48) & (code <= 57)))


def tokens(column: pa.Array, rolling: Rolling, between: np.ndarray):
    """Yields (first row, row of every token, token hash) for ranges of rows."""
    column = pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))
    data, offsets = utf8(column)
    for a, b in steps(offsets):
        part, at = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        starts, ends, row = words(part, at, between)
        yield a, b, row + a, rolling.ranges(rolling.prefix(part), starts, ends)


def grams(row: np.ndarray, token: np.ndarray, n: int):
    """Positions and hashes of the n-grams that stay inside one row."""
    if len(token) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    last = len(token) - n + 1
    total = np.full(last, np.uint64(n))
    for k in range(n):
        total = mix(total * np.uint64(31) + token[k:last + k])
    inside = np.flatnonzero(row[:last] == row[n - 1:])
    return inside, total[inside]


def passages(items: DataFrame, n: int, passage: int, item_id: str, text: str) -> DataFrame:
    """Passages of every item: (item_id, passage, tokens, grams, width of the grams)."""
    kind = items.schema[item_id].dataType.simpleString()

    def run(batches):
        rolling, between = Rolling(), separators()
        for batch in batches:
            out = {k: [] for k in ("item_id", "passage", "tokens", "grams", "width")}
            ids = batch.column("item_id")
            for a, b, row, token in tokens(batch.column("text"), rolling, between):
                for i in range(a, b):
                    own = token[row == i]
                    if not len(own):
                        continue
                    last = max(0, len(own) - passage)
                    for k, at in enumerate([*range(0, last, max(1, passage // 2)), last]):
                        part = own[at:at + passage]
                        width = min(n, len(part))
                        out["item_id"].append(ids[i])
                        out["passage"].append(k)
                        out["tokens"].append(part.view(np.int64))
                        out["grams"].append(grams(np.zeros(len(part)), part, width)[1]
                                            .view(np.int64))
                        out["width"].append(width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["item_id"], ids.type), pa.array(out["passage"], pa.int32()),
                 pa.array(out["tokens"], pa.list_(pa.int64())),
                 pa.array(out["grams"], pa.list_(pa.int64())), pa.array(out["width"], pa.int32())],
                names=list(out))

    return items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).mapInArrow(
        run, f"item_id {kind}, passage int, tokens array<bigint>, grams array<bigint>, width int")


def documents_with(docs: DataFrame, bits: np.ndarray, widths: list[int], text: str) -> DataFrame:
    """(gram, docs): number of rows that hold each n-gram of the bitmap."""
    def run(batches):
        rolling, between = Rolling(), separators()
        for batch in batches:
            for _, _, row, token in tokens(batch.column("text"), rolling, between):
                for width in widths:
                    at, gram = grams(row, token, width)
                    known = present(bits, gram)
                    own, gram = row[at[known]], gram[known]
                    order = np.lexsort((own, gram))
                    own, gram = own[order], gram[order]
                    new = np.ones(len(gram), bool)
                    new[1:] = (gram[1:] != gram[:-1]) | (own[1:] != own[:-1])
                    found, times = np.unique(gram[new], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.view(np.int64)), pa.array(times.astype(np.int64))],
                        names=["gram", "docs"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "gram bigint, docs bigint") \
        .groupBy("gram").agg(F.sum("docs").alias("docs"))


def rare_seeds(items: DataFrame, counts: DataFrame, rare: float, window: int) -> DataFrame:
    """(item_id, passage, gram, docs): the n-grams of each passage that serve as its seeds."""
    at = items.select("item_id", "passage", F.posexplode("grams").alias("pos", "gram")) \
        .join(counts, "gram")
    along = Window.partitionBy("item_id", "passage").orderBy("pos")  # a passage's n-grams
    ahead = along.rowsBetween(0, window - 1)
    at = at.withColumn("least", F.when(
        (F.count("*").over(ahead) == window) | (F.row_number().over(along) == 1),
        F.min("docs").over(ahead)))
    at = at.withColumn("least", F.max("least").over(along.rowsBetween(1 - window, 0)))
    return at.where((F.col("docs") <= rare) | (F.col("docs") == F.col("least"))) \
        .select("item_id", "passage", "gram", "docs").distinct()


def regions(docs: DataFrame, bits: np.ndarray, widths: list[int], reach: int,
            doc_id: str, text: str) -> DataFrame:
    """Token ranges around seed hits: (doc_id, row, start, tokens, grams).

    Hits closer than ``reach`` share a region, which extends ``reach`` tokens to either side.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        rolling, between = Rolling(), separators()
        for batch in batches:
            ids, rows = batch.column("doc_id"), batch.column("row")
            out = {k: [] for k in ("doc_id", "row", "start", "tokens", "grams")}
            for _, _, row, token in tokens(batch.column("text"), rolling, between):
                hits = [grams(row, token, n) for n in widths]
                keep = [present(bits, g) for _, g in hits]
                at = np.concatenate([h[k] for (h, _), k in zip(hits, keep)])
                gram = np.concatenate([g[k] for (_, g), k in zip(hits, keep)])
                order = np.argsort(at, kind="stable")
                at, gram = at[order], gram[order]
                if not len(at):
                    continue
                own = row[at]
                new = np.flatnonzero(np.concatenate(
                    [[True], (own[1:] != own[:-1]) | (at[1:] - at[:-1] > 2 * reach)]))
                for lo, hi in zip(new, np.append(new[1:], len(at))):
                    i = own[lo]
                    first = np.searchsorted(row, i)
                    a = max(first, at[lo] - reach)
                    b = min(np.searchsorted(row, i, "right"), at[hi - 1] + reach + max(widths))
                    out["doc_id"].append(ids[int(i)])
                    out["row"].append(rows[int(i)])
                    out["start"].append(int(a - first))
                    out["tokens"].append(token[a:b].view(np.int64))
                    out["grams"].append(np.unique(gram[lo:hi]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], ids.type), pa.array(out["row"], pa.int64()),
                 pa.array(out["start"], pa.int64()), pa.array(out["tokens"], pa.list_(pa.int64())),
                 pa.array(out["grams"], pa.list_(pa.int64()))], names=list(out))

    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("row"),
                       F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, row bigint, start bigint, tokens array<bigint>, grams array<bigint>")


def align(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Best local alignment of each pair (match 2, mismatch -1, gap -1), all pairs at once.

    One step per token of the left side. The running gap along a row is a cumulative maximum.
    """
    m, w = max(map(len, left)), max(map(len, right))
    a = np.zeros((len(left), m), np.int64)
    b = np.zeros((len(left), w), np.int64)
    filled_a, filled_b = np.zeros(a.shape, bool), np.zeros(b.shape, bool)
    for k, (x, y) in enumerate(zip(left, right)):
        a[k, :len(x)], filled_a[k, :len(x)] = x, True
        b[k, :len(y)], filled_b[k, :len(y)] = y, True
    slope = np.arange(w, dtype=np.int32)
    row = np.zeros((len(left), w), np.int32)
    best = np.zeros(len(left), np.int32)
    for i in range(m):
        same = (a[:, i:i + 1] == b) & filled_a[:, i:i + 1] & filled_b
        diagonal = np.zeros_like(row)
        diagonal[:, 1:] = row[:, :-1]
        row = np.maximum(np.maximum(diagonal + np.where(same, 2, -1), row - 1), 0)
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        best = np.maximum(best, row.max(axis=1))
    return best


def aligned(pairs: DataFrame, keep: list[str], threshold: float) -> DataFrame:
    """Column ``score`` for pairs with array columns ``tokens`` (region) and ``wanted``; zero if
    the tokens in common rule out a score of ``threshold``."""
    def run(batches):
        for batch in batches:
            wanted = [np.asarray(x.values) for x in batch.column("wanted")]
            have = [np.asarray(x.values) for x in batch.column("tokens")]
            scores = np.zeros(len(wanted))
            order = np.argsort([len(x) for x in have], kind="stable")
            order = [i for i in order if np.isin(wanted[i], have[i]).mean() >= threshold]
            at = 0
            while at < len(order):
                # at most about four million cells at once; a long region goes alone
                size = max(1, min(256, (1 << 22) // max(1, len(have[order[at]]) * 2)))
                part = order[at:at + size]
                while len(part) > 1 and len(part) * len(have[part[-1]]) > 1 << 22:
                    part = part[:len(part) // 2]
                best = align([wanted[i] for i in part], [have[i] for i in part])
                scores[part] = best / (2.0 * np.array([len(wanted[i]) for i in part]))
                at += len(part)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keep], pa.array(scores)], names=[*keep, "score"])

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.select(*keep).schema.fields]
    return pairs.mapInArrow(run, ", ".join([*schema, "score double"]))


def seeded(found: DataFrame, seeds: DataFrame) -> DataFrame:
    """(row, start, item_id, passage) of regions and passages that share a seed."""
    deals = F.ceil(F.col("docs") / DEAL_DOCS).cast("bigint")
    often = seeds.where(F.col("docs") > DEAL_DOCS).select("gram", "docs").distinct() \
        .orderBy(F.desc("docs"), "gram").limit(MOST_DEALT).select("gram", deals.alias("deals"))
    often = materialise(often, "bench-often")  # a proven bound for the broadcasts below
    left = found.select("row", "start", F.explode("grams").alias("gram")) \
        .join(F.broadcast(often), "gram", "left") \
        .withColumn("deal", F.pmod(F.xxhash64("row", "start"), F.coalesce("deals", F.lit(1))))
    right = seeds.join(F.broadcast(often), "gram", "left").select(
        "gram", "item_id", "passage", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.coalesce("deals", F.lit(1)) - 1)).alias("deal"))
    return left.join(right, ["gram", "deal"]).select("row", "start", "item_id", "passage") \
        .distinct()


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.4, n: int = 3,
                 passage: int = 64, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text",
                 window: int = 2) -> DataFrame:
    """(doc_id, item_id, score) of every document that holds a passage of an item."""
    items = materialise(passages(items, n, passage, item_id, item_text), "bench-passages")
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # 1 to n
    kind = docs.schema[doc_id].dataType.simpleString()
    if not widths:
        return docs.sparkSession.createDataFrame(
            [], f"doc_id {kind}, item_id {items.schema['item_id'].dataType.simpleString()}, "
                "score double")
    every = materialise(items.select(F.explode("grams").alias("gram")).distinct(), "bench-grams")
    counts = materialise(documents_with(docs, bitmap(every), widths, text), "bench-counts")
    seeds = materialise(rare_seeds(items, counts, docs.count() ** 0.5, window), "bench-seeds")
    found = materialise(regions(docs, bitmap(seeds.select("gram").distinct()), widths,
                                passage + passage // 4, doc_id, text), "bench-regions")
    key = ["row", "start"]
    pairs = seeded(found, seeds) \
        .join(items.select("item_id", "passage", F.col("tokens").alias("wanted")),
              ["item_id", "passage"]).join(found.drop("grams"), key)
    return aligned(pairs.select("doc_id", "item_id", "wanted", "tokens"), ["doc_id", "item_id"],
                   threshold) \
        .where(F.col("score") >= threshold) \
        .groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no passage of an item, all columns."""
    row = unused(docs, "_row")
    # the id beside the hash: two rows go together only if they are equal in both
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64("doc_id", "text").alias("hash"))
    keyed = docs.withColumn(row, key)
    marked = contaminated(keyed, items, doc_id=row, **options).select(
        F.col("doc_id").alias(row)).distinct()
    return keyed.join(marked, row, "left_anti").drop(row)
