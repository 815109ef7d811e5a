"""Source divergence audit: how far sources of a language stray from each other and from it.

Every (language, source) group and every language gives each term a share p, smoothed and scaled
to an integer. A term's divergence of p from q is floor((p - q)**2 / q). For two sources it is
summed over all kept terms of the language, so it only depends on the joint table of the two:
how many terms have count a in the one and count b in the other.

These tables come from one-hot level products. The kept terms of a language are cut into blocks;
a block's matrix has one row per term and one indicator column per (group, count level), level 0
included. The matrix, times its transpose, holds the joint tables of all its pairs of groups
at once; products of zeros and ones are summed in floats far below 2**24, so they are exact.
Products are taken tile by tile, priced in the task, and leave as one number per pair of groups;
the blocks' numbers are added up. Sources are cut into blocks as well, so that a task sees at
most ``TERMS`` terms and two blocks of ``GROUPS`` sources, whatever the table.

Counting is pre-aggregated in the tasks before the shuffle. All arithmetic is in integers.

Defined results: null text, lang and source count as ''; empty texts and groups without kept
terms have N = 0 and p = 1 + floor(scale / V); a language without kept terms has value 0 for all
pairs and no term rows; repeated rows are documents of their own; texts of any length are counted
whole; an empty table gives an empty table; extra columns do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmill.session import materialise

SCALE = 1_000_000_000
TERMS = 1_024      # rows of a block's matrix
GROUPS = 64        # sources of a block
TILE = 1_024       # columns of a tile
HELD = 500_000     # different (group, term) that a task counts before it passes them on
STEP = 1 << 20     # bytes of a text that are split at once
DOCUMENT = 1 << 40  # one document in a count that holds documents above times

#: per byte: letters in lower case, bytes of other characters as they are, everything else a blank
_FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32
              for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, some at a time."""
    start = 0
    while start < len(text):
        stop = len(text)
        if stop - start > STEP:
            piece = text[start:start + STEP].translate(_FOLD)
            stop = start + STEP
            blank = piece.rfind(b" ")
            while blank < 0 and stop < len(text):  # a term beyond the step: go on to its end
                more = text[stop:stop + STEP].translate(_FOLD)
                blank = more.find(b" ")
                piece += more if blank < 0 else more[:blank]
                stop += len(more) if blank < 0 else blank
                if blank >= 0:
                    blank = len(piece)
            if 0 <= blank < len(piece):
                piece, stop = piece[:blank], start + blank + 1
        else:
            piece = text[start:].translate(_FOLD)
        yield piece.split()
        start = stop


COUNTS = "lang string, source string, term string, docs bigint, n bigint"


def count_terms(docs: DataFrame, text: str = "text", lang: str = "lang",
                source: str = "source") -> DataFrame:
    """(lang, source, term, docs, n); one row per group without a term (null) as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, dict[bytes, int]] = {}  # times, and documents above them
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (l, s), words in groups.items():
                both = np.fromiter(words.values(), np.int64, len(words))
                yield pa.RecordBatch.from_arrays([
                    pa.array([l] * (len(words) + 1)), pa.array([s] * (len(words) + 1)),
                    pa.array([None, *words], pa.binary()).cast(pa.string()),
                    pa.array(np.append(0, both // DOCUMENT)),
                    pa.array(np.append(0, both % DOCUMENT))],
                    names=["lang", "source", "term", "docs", "n"])
            groups.clear()

        for batch in batches:
            for l, s, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                               batch.column(2)):
                words = groups.setdefault((l, s), {})
                own: Counter = Counter()
                for found in terms_of(t.as_py()):
                    own.update(found)
                before, seen = len(words), words.get
                for word, times in own.items():
                    words[word] = seen(word, 0) + times + DOCUMENT
                held += len(words) - before
                if held > HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    blank = F.lit("")
    rows = docs.select(F.coalesce(lang, blank), F.coalesce(source, blank),
                       F.coalesce(text, blank).cast("binary"))
    return rows.mapInArrow(run, COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def _share(n, total, kept, scale: int):
    """1 + floor(scale * (n + 1) / (total + kept)), exact."""
    big = lambda x: x.cast("decimal(20,0)")
    top = (F.lit(scale).cast("decimal(11,0)") * big(n + 1)).cast("decimal(38,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", top, big(total + kept))


def _divergence(p, q):
    return F.call_function("div", (p - q) * (p - q), q)


def _joint_prices(rows: pa.Table) -> pa.Table:
    """Divergence sums of all pairs of groups of two source blocks over one block of terms.

    ``rows``: (left, right, group, term, p); group rows have a null term and the share of count
    0, term rows the share of an occurring term. ``rest`` counts terms that occur in no group
    here.
    """
    left, right = rows.column("left")[0].as_py(), rows.column("right")[0].as_py()
    head = rows.filter(pc.is_null(rows.column("term")))
    body = rows.filter(pc.is_valid(rows.column("term")))
    order = np.argsort(head.column("group").to_numpy())
    groups = head.column("group").to_numpy()[order]
    zero = head.column("p").to_numpy()[order]
    names = pc.dictionary_encode(body.column("term").combine_chunks())
    row = names.indices.to_numpy().astype(np.int64)
    g = np.searchsorted(groups, body.column("group").to_numpy())
    p = body.column("p").to_numpy()
    n = len(names.dictionary)
    absent = int(head.column("terms")[0].as_py()) - n  # kept terms of the block in neither
    # columns: level 0 of every group, then the other levels that occur
    level = np.zeros((n, len(groups)), np.int64)  # column number of every (term, group)
    pairs = np.stack([g, p], axis=1) if len(g) else np.zeros((0, 2), np.int64)
    seen, where = np.unique(pairs, axis=0, return_inverse=True)
    owner = np.concatenate([np.arange(len(groups)), seen[:, 0]])
    price = np.concatenate([zero, seen[:, 1]])
    level[:] = np.arange(len(groups))
    level[row, g] = len(groups) + where.reshape(-1)
    # columns side by side by group, so that a tile holds few groups
    place = np.argsort(owner, kind="stable")
    rank = np.empty(len(place), np.int64)
    rank[place] = np.arange(len(place))
    owner, price, level = owner[place], price[place], rank[level]
    width = len(owner)
    sums = np.zeros((len(groups), len(groups)), np.int64)

    def indicators(a: int, b: int) -> np.ndarray:
        part = np.zeros((n, b - a), np.float32)
        term, group = np.nonzero((level >= a) & (level < b))
        part[term, level[term, group] - a] = 1
        return part

    if n:
        for a in range(0, width, TILE):
            one = indicators(a, min(width, a + TILE))
            for b in range(a, width, TILE):
                two = one if a == b else indicators(b, min(width, b + TILE))
                joint = (one.T @ two).astype(np.int64)
                i, j = np.nonzero(joint)
                times = joint[i, j]
                i, j = i + a, j + b
                apart = owner[i] < owner[j]
                i, j, times = i[apart], j[apart], times[apart]
                square = (price[i] - price[j]) ** 2
                np.add.at(sums, (owner[i], owner[j]), times * (square // price[j]))
                np.add.at(sums, (owner[j], owner[i]), times * (square // price[i]))
    if absent:
        sums += absent * ((zero[:, None] - zero[None]) ** 2 // zero[None])
    block = groups // GROUPS
    i, j = np.nonzero(~np.eye(len(groups), dtype=bool))
    mine = (np.minimum(block[i], block[j]) == left) & (np.maximum(block[i], block[j]) == right)
    i, j = i[mine], j[mine]
    return pa.table({"lang": pa.array([rows.column("lang")[0].as_py()] * len(i), pa.string()),
                     "group": groups[i], "other": groups[j], "value": sums[i, j]})


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200, scale: int = SCALE) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` against each other source of the
    language, part ``term`` the terms that a source uses more than its language."""
    counts = materialise(count_terms(docs), "term-counts")
    kept = materialise(counts.where("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"))
        .where(F.col("docs") >= least_docs).select("lang", "term", "total"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    used = counts.where("term IS NOT NULL").select("lang", "source", "term", "n").join(
        kept, ["lang", "term"])
    own = used.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    # one row per group: numbered inside its language, with N, V and the language's N
    groups = counts.where("term IS NULL").select("lang", "source").join(
        own, ["lang", "source"], "left").join(langs, "lang", "left").fillna(
        0, ["group_n", "v", "lang_n"]).withColumn("group", (F.row_number().over(
            W.partitionBy("lang").orderBy("source")) - 1).cast("bigint"))
    groups = materialise(groups, "groups")
    v, group_n = F.col("v"), F.col("group_n")
    priced = used.join(groups, ["lang", "source"]).withColumns({
        "p": _share(F.col("n"), group_n, v, scale),
        "q": _share(F.col("total"), F.col("lang_n"), v, scale)})
    priced = materialise(priced.select("lang", "source", "group", "term", "p", "q", "v"), "shares")
    return _pairs(priced, groups, kept, scale).unionByName(_terms(priced, top))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                       F.row_number().over(order).alias("rank"))


def _terms(priced: DataFrame, top: int) -> DataFrame:
    """The limit on the rank cuts each task's rows before the shuffle."""
    rows = priced.where("p > q").select(
        "lang", "source", F.col("term").alias("item"),
        _divergence(F.col("p"), F.col("q")).alias("value"))
    return _ranked(rows, "term").where(F.col("rank") <= top)


def _pairs(priced: DataFrame, groups: DataFrame, kept: DataFrame, scale: int) -> DataFrame:
    blocks = F.greatest(F.lit(1), F.ceil(F.col("v") / TERMS)).cast("int")
    of_term = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    numbered = groups.select("lang", "v", blocks.alias("blocks")).distinct()
    sizes = kept.join(numbered, "lang").withColumn("block", of_term).groupBy(
        "lang", "block").agg(F.count("*").alias("terms"))
    # source blocks meet as unordered pairs: a row goes to each pair that holds its block
    last = F.floor((F.max("group").over(W.partitionBy("lang"))) / GROUPS).cast("int")
    sides = groups.withColumn("last", last).withColumn("mine", F.floor(
        F.col("group") / GROUPS).cast("int"))

    def meet(df: DataFrame) -> DataFrame:
        other = F.explode(F.sequence(F.lit(0), F.col("last")))
        return df.withColumn("other", other).withColumns({
            "left": F.least("mine", "other"), "right": F.greatest("mine", "other")})

    zero = F.when(F.col("v") > 0, _share(F.lit(0).cast("bigint"), F.col("group_n"), F.col("v"), scale)) \
        .otherwise(F.lit(1)).cast("bigint")
    heads = sides.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).join(
        sizes, ["lang", "block"], "left")
    heads = meet(heads).select("lang", "block", "left", "right", "group",
                               F.lit(None).cast("string").alias("term"), zero.alias("p"),
                               F.coalesce("terms", F.lit(0).cast("bigint")).alias("terms"))
    placed = priced.join(sides.select("lang", "source", "last", "mine"), ["lang", "source"])
    body = meet(placed.withColumn("blocks", blocks).withColumn("block", of_term)).select(
        "lang", "block", "left", "right", "group", "term", "p",
        F.lit(None).cast("bigint").alias("terms"))
    sums = heads.unionByName(body).groupBy("lang", "block", "left", "right").applyInArrow(
        _joint_prices, "lang string, group bigint, other bigint, value bigint")
    sums = sums.groupBy("lang", "group", "other").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "group", "source")
    rows = sums.join(names, ["lang", "group"]).join(
        names.select("lang", F.col("group").alias("other"), F.col("source").alias("item")),
        ["lang", "other"])
    return _ranked(rows.select("lang", "source", "item", "value"), "pair")


def oracle() -> str:
    """The audit of ``documents`` in SQL."""
    folded = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              "'abcdefghijklmnopqrstuvwxyz')")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang,
                  coalesce(source, '') AS source, {folded} AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t,
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 3),
lang_n AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term)
      GROUP BY ALL),
g AS (SELECT d.lang, d.source, coalesce(any_value(x.n), 0) AS n
      FROM (SELECT DISTINCT lang, source FROM d) d
      LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) x USING (lang, source)
      GROUP BY ALL),
s AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + l.v) AS p,
             1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n + l.v) AS q
      FROM g JOIN kept k USING (lang) JOIN lang_n l USING (lang)
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item,
                 sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
          FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
          GROUP BY ALL),
rows_ AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                 CAST(coalesce(p.value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
          UNION ALL
          SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT)
          FROM s WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part
                  ORDER BY value DESC, item) AS INTEGER) AS rank FROM rows_)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""
