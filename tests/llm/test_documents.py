"""The document operators against brute force and on awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from lendmill.llm import (decontaminate, license, lines, mix, quality, queries, shard, simhash,
                          suffix)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(seed=3, rows=120):
    """Random prose with exact copies, near copies, shared passages and awkward rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdéß") for _ in range(rng.randint(2, 7)))
                  for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = say(60)
    texts = []
    for _ in range(rows):
        body = "\n".join(say(rng.randint(5, 40)) for _ in range(rng.randint(1, 5)))
        texts.append(body if rng.random() < 0.8 else f"{body}\n{passage}\n{say(9)}")
    texts += [texts[1], texts[1], texts[2] + " zz", texts[3].replace(" ", "  ", 1), passage]
    texts += ["", None, " \n\t ", "one", "x" * 49, "y" * 50, "y" * 50, say(40_000)]
    table = [(i, t, "en", rng.choice(["a", "b", None]), len(t or "")) for i, t in enumerate(texts)]
    return [*table, table[0], table[0], (None, texts[4], None, None, None),
            (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    clash = [(*r, 1, "z", 2) for r in documents()]
    return spark.createDataFrame(clash, f"{SCHEMA}, _row int, size string, shard int") \
        .repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---- SimHash ---------------------------------------------------------------------------------

def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    width = min(4, len(words))
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def classes(codes, distance):
    parent = list(range(len(codes)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(codes):
        for j in range(i):
            if (x ^ codes[j]).bit_count() <= distance:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(codes))]


@pytest.mark.parametrize("group_rows", [20_000, 5])
def test_simhash_equals_brute_force(docs, group_rows):
    data = documents()
    codes = [plain_fingerprint(r[1]) for r in data]
    roots = classes(codes, 4)
    least = {}
    for root, r in zip(roots, data):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    want = sorted((str(r[0]), f"{c:016x}", str(least.get(root)))
                  for r, c, root in zip(data, codes, roots))
    found = simhash.near_duplicates(docs, group_rows=group_rows).select(
        "doc_id", simhash.hex_digits(), "component_id")
    assert sorted(tuple(map(str, r[:1])) + (r[1], str(r[2])) for r in rows(found)) == want


def test_simhash_links_of_clustered_codes():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    codes = np.unique(np.concatenate([
        c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (3, 300)).astype(np.uint64),
                                 axis=0) for c in centres]))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    i, j = simhash.links(np.zeros(len(codes)), codes, 4)
    label = np.arange(len(codes))
    for a, b in zip(i, j):
        label[label == label[b]] = label[a]
    want = classes([int(c) for c in codes], 4)
    assert len(set(zip(label.tolist(), want))) == len(set(want)) == len(set(label.tolist()))


def test_simhash_links_inside_large_nodes(spark):
    """Thousands of codes under one node; each has a partner that only this node can find."""
    rng = np.random.default_rng(6)
    base = (rng.integers(0, 1 << 63, 2000, dtype=np.uint64) >> np.uint64(12)) << np.uint64(12)
    flip = np.uint64(sum(1 << lo for lo, _ in simhash.segments(4)[1:]))
    loose = rng.integers(0, 1 << 63, 500, dtype=np.uint64) << np.uint64(1)
    codes = np.unique(np.concatenate([base, base ^ flip, loose, loose ^ np.uint64(1)]))
    table = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp bigint")
    place = {int(c): i for i, c in enumerate(codes.view(np.int64))}
    found = [(place[r["u"]], place[r["v"]])
             for r in simhash.forest(table, 4, group_rows=300).collect()]
    near = np.concatenate([np.argwhere(np.bitwise_count(codes[a:a + 500, None] ^ codes) <= 4)
                           + [a, 0] for a in range(0, len(codes), 500)])
    names = lines.roots(len(codes), near[:, 0], near[:, 1])
    u, v = (np.array(x, np.int64) for x in zip(*found))
    assert (lines.roots(len(codes), u, v) == names).all()


def test_one_document_of_each_group_stays(docs, empty):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    data = documents()
    roots = classes([plain_fingerprint(r[1]) for r in data], 4)
    found = rows(kept.select("doc_id", "text", "_row"))
    assert len(found) == len(set(roots)) and {r[2] for r in found} == {1}
    ids = [r[0] for r in found if r[0] is not None]
    assert len(ids) == len(set(ids)) and 0 in ids
    assert simhash.one_of_each(empty).count() == 0


# ---- suffix dedup ----------------------------------------------------------------------------

def plain_dedup(data, length=50):
    least = {}
    body = [(r[0], (r[1] or "").encode()) for r in data]
    for i, t in body:
        if i is not None:
            for a in range(len(t) - length + 1):
                w = t[a:a + length]
                least[w] = min(least.get(w, i), i)
    for i, t in body:
        gone = np.zeros(len(t) + 2, bool)
        for a in range(len(t) - length + 1 if i is not None else 0):
            if least[t[a:a + length]] < i:
                gone[a + 1:a + 1 + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[1:-1]])
        yield (i, len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()),
               hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("bucket_bytes", [1 << 21, 20_000])
def test_suffix_dedup_equals_brute_force(docs, bucket_bytes):
    want = sorted(plain_dedup(documents()), key=str)
    found = suffix.dedup(docs, bucket_bytes=bucket_bytes, blocks=3)
    assert sorted(rows(found), key=str) == want
    assert sum(r[2] for r in want) > 1000


def test_suffix_shards_and_periodic_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix, "SHARD_ROWS", 4)
    monkeypatch.setattr(suffix, "STEP", 64)
    rng = random.Random(1)
    unit = ["ab", "abc", "aaaaab"]
    data = [(i, (rng.choice(unit) * 60)[:rng.randint(40, 120)] + rng.choice("xy") * 3
             + "".join(rng.choice("ab") for _ in range(rng.randint(0, 80)))) for i in range(40)]
    rng.shuffle(data)
    found = suffix.dedup(spark.createDataFrame(data, "doc_id bigint, text string").coalesce(2),
                         bucket_bytes=500, blocks=2)
    assert sorted(rows(found)) == sorted(plain_dedup(data))


def test_suffix_empty(empty):
    assert suffix.dedup(empty).count() == 0


# ---- lines -----------------------------------------------------------------------------------

def distance(a, b):
    now = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, now = now, [i]
        for j, y in enumerate(b, 1):
            now.append(min(now[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return now[-1]


def edited(rng, line, n):
    line = list(line)
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(max(1, len(line)))
        if kind == 0 or not line:
            line.insert(at, rng.choice("abé"))
        elif kind == 1:
            line[at] = rng.choice("abé")
        else:
            del line[at]
    return "".join(line)


def test_edit_distance_within_band():
    rng = random.Random(2)
    for limit in (1, 2, 3):
        left = ["".join(rng.choice("abé") for _ in range(rng.choice([1, 3, 9, 70, 130])))
                for _ in range(300)]
        right = [edited(rng, x + "a", rng.randint(0, 4)) for x in left]
        at = np.arange(len(left))
        found = lines.within(lines.Points(left), at, lines.Points(right), at, limit)
        assert found.tolist() == [distance(a, b) <= limit for a, b in zip(left, right)]


def line_texts(rng):
    base = ["".join(rng.choice("abcde ") for _ in range(rng.randint(20, 60))).strip() + "x"
            for _ in range(40)]
    made = [edited(rng, rng.choice(base), rng.randint(0, 3)).strip(lines.BLANKS) or "q"
            for _ in range(200)]
    made += ["short", "shirt", "short"] + ["template number one hundred %05d end" % (i * 7)
                                           for i in range(60)]
    rng.shuffle(made)
    return [(i, "\n".join([*made[i * 5:i * 5 + 5], " "][:rng.randint(3, 6)])) for i in range(53)] \
        + [(99, None), (None, made[0]), (98, "")]


@pytest.mark.parametrize("busy", [256, 8])
def test_line_dedup_equals_brute_force(spark, busy):
    data = line_texts(random.Random(4))
    order = sorted(data, key=lambda r: (r[0] is None, r[0] or 0))
    seen = [(i, k, x) for i, t in order for k, x in enumerate(lines.pieces(t)) if x]
    unique = list(dict.fromkeys(x for *_, x in seen))
    parent = {x: x for x in unique}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(unique):
        for b in unique[:n]:
            if min(len(a), len(b)) >= 24 and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2:
                parent[find(a)] = find(b)
    want = {i: [0, 0, 0, 0] for i, _ in data}
    known, known_class = set(), set()
    for i, _, x in seen:
        row = want[i]
        row[0] += 1
        row[1] += x in known
        row[2] += x not in known and find(x) in known_class
        row[3] += len(x) if find(x) not in known_class else 0
        known.add(x)
        known_class.add(find(x))
    table = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    found = lines.summary(table, busy=busy, block_rows=20)
    assert {r[0]: list(r[1:]) for r in rows(found)} == want
    assert sum(r[2] for r in want.values()) > 20
    kept = {r["doc_id"]: r["text"] for r in lines.cleaned(table, busy=busy).collect()}
    assert kept[99] is None and all(
        sum(len(x) for x in lines.pieces(kept[i])) == want[i][3] for i in want)


@pytest.mark.parametrize("busy,block_rows", [(256, 2000), (16, 60)])
def test_lines_of_one_template(spark, busy, block_rows):
    """A hot key: all lines agree but for a number and a word in the middle."""
    rng = random.Random(5)
    made = list(dict.fromkeys(
        f"the same beginning {rng.randrange(10 ** 7):07d} and {rng.choice(['one', 'other'])} end of it"
        for _ in range(1500)))
    points = lines.Points(made)
    a, b = np.triu_indices(len(made), 1)
    near = lines.within(points, a, points, b, 2)
    want = lines.roots(len(made), a[near], b[near])
    table = spark.createDataFrame([(i, x) for i, x in enumerate(made)], "doc_id bigint, text string")
    found = lines.cleaned(table.repartition(6), busy=busy, block_rows=block_rows)
    kept = {r.doc_id for r in found.collect() if r.text}
    assert kept == set(want.tolist())
    assert 10 < len(kept) < len(made) - 10


def test_long_lines_and_clashing_columns(spark):
    rng = random.Random(6)
    long = "".join(rng.choice("abcdefgh ") for _ in range(12_000)).strip()
    data = [(1, long), (2, long[:6_000] + "Z" + long[6_000:]), (3, long + "four"), (4, "a\nb")]
    table = spark.createDataFrame([(*r, "x", 7, "k", b"l") for r in data],
                                  "doc_id bigint, text string, _row string, _gone int, "
                                  "key string, line binary")
    found = {r.doc_id: r for r in lines.cleaned(table).collect()}
    assert found[1].text == long and found[2].text == "" and found[3].text == long + "four"
    assert all(r._row == "x" and r._gone == 7 and r.key == "k" for r in found.values())
    counts = {r[0]: tuple(r[1:]) for r in lines.summary(table).collect()}
    assert counts[2] == (1, 0, 1, 0) and counts[4] == (2, 0, 0, 2)


def test_lines_empty(empty):
    assert lines.summary(empty).count() == 0


# ---- licenses --------------------------------------------------------------------------------

def test_license_digests(spark, empty):
    mit = license.TEXTS["MIT"]
    shouted = "Copyright (c) 1999 Some Body\n\n" + mit.upper().replace(",", " ;").replace(" ", "\n")
    data = [(1, mit), (2, shouted), (3, mit + " more"), (4, None), (5, ""), (5, ""),
            (6, "text\nreleased under the MIT Licence\nend"), (7, "LICENSE: MIT"),
            (8, "Licensed under CC BY-NC 4.0.\n# Licensed under the Apache License, Version 2.0!"),
            (9, "a" * 200_000 + "\nThis work is licensed under GPL-3.0-only"), (10, "no licence")]
    found = {}
    table = spark.createDataFrame(data, "doc_id bigint, text string")
    for r in license.scan(table.withColumn("license", table["doc_id"])).collect():
        found.setdefault(r[0], []).append(tuple(r)[1:])
    assert found[1] == [("MIT", "", 0)] and found[2] == [("MIT", "", 0)]
    assert found[3] == [(None, "", 0)] and found[4] == [(None, "", 0)]
    assert found[5] == [(None, "", 0)] * 2
    assert found[6] == [(None, "MIT", 1)] and found[7] == [("MIT", "MIT", 1)]
    assert found[8] == [(None, "Apache-2.0,CC-BY-NC-4.0", 2)]
    assert found[9] == [(None, "GPL-3.0-only", 1)] and found[10] == [(None, "", 0)]
    assert license.scan(empty).count() == 0
    with pytest.raises(ValueError):
        license.known(spark, [("X", "nothing of the kind")])


def test_license_whole_texts(spark):
    bsd = license.TEXTS["BSD-2-Clause"].replace("THIS SOFTWARE IS", (
        "3. Neither the name of the copyright holder nor the names of its contributors may be "
        "used to endorse or promote products derived from this software without specific prior "
        "written permission.\n\nTHIS SOFTWARE IS"), 1)
    data = [(1, f"BSD 3-Clause License\n\nCopyright (c) 2020, Some Body\n\n{bsd}"), (2, bsd),
            (3, license.TEXTS.get("Unlicense", "no license"))]
    found = license.scan(spark.createDataFrame(data, "doc_id bigint, text string")).collect()
    assert sorted((r[0], r[1]) for r in found) == [
        (1, "BSD-3-Clause"), (2, "BSD-3-Clause"), (3, "Unlicense")]


# ---- decontamination -------------------------------------------------------------------------

def test_alignment_equals_plain_smith_waterman():
    rng = np.random.default_rng(3)
    left = [rng.integers(0, 5, rng.integers(1, 12)) for _ in range(40)]
    right = [rng.integers(0, 5, rng.integers(1, 25)) for _ in range(40)]
    for a, b, score in zip(left, right, decontaminate.align(left, right)):
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1),
                                      h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert score == h.max()


def test_decontamination_finds_edited_copies(spark, empty):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    common = [word() for _ in range(30)]
    say = lambda n: [word() if rng.random() < 0.5 else rng.choice(common)
                     for _ in range(n)]
    items = [(k, " ".join(say(rng.randint(20, 200)))) for k in range(12)]
    items += [(50, ""), (51, None), (52, "Two words"), (items[0][0], items[0][1])]
    data, want = [], set()
    for i in range(60):
        body = say(rng.randint(0, 300))
        if i % 3 == 0:
            k, text = items[i % 12]
            copy = text.split()
            if i % 2:  # every eighth word replaced, one left out, other case and punctuation
                copy = [word() if n % 8 == 7 else w.upper() + "," for n, w in enumerate(copy)]
                del copy[10]
            at = rng.randint(0, len(body))
            body[at:at] = copy
            want.add((i, k))
        data.append((i, " ".join(body)))
    data += [(70, None), (71, ""), (72, "he said two... WORDS there"), data[0]]
    want.add((72, 52))
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contaminated(docs.withColumn("gram", docs["doc_id"]), table)
    assert {(r[0], r[1]) for r in rows(found)} == want
    clean = decontaminate.clean(docs, table)
    assert {r[0] for r in rows(clean)} == {r[0] for r in data} - {i for i, _ in want}
    assert decontaminate.contaminated(empty, table).count() == 0
    assert decontaminate.contaminated(docs, table.limit(0)).count() == 0
    assert decontaminate.clean(docs, table.limit(0)).count() == len(data)


def test_decontamination_finds_the_half_that_leaked_most(spark):
    """Many documents quote the first half of a passage, one the second: all score 0.5."""
    tokens = [f"t{k}" for k in range(64)]
    filler = lambda i: " ".join(f"f{i}x{k}" for k in range(100))
    data = [(i, f"{filler(i)} {' '.join(tokens[:32])} {filler(i)}") for i in range(1, 30)]
    data += [(50, " ".join(tokens[30:])), (51, filler(51)), (52, " ".join(tokens[:25]))]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    table = spark.createDataFrame([(1, " ".join(tokens))], "item_id bigint, text string")
    found = {r[0]: r[2] for r in rows(decontaminate.contaminated(docs, table))}
    assert found == {**{i: 0.5 for i in range(1, 30)}, 50: 34 / 64}


def plain_contamination(data, items, threshold=0.4, passage=64):
    """Every document against every passage that it shares an n-gram with, over its whole
    length."""
    def shingles(x, width):
        return {tuple(x[a:a + width]) for a in range(len(x) - width + 1)}

    number = {}
    read = lambda text: np.array([number.setdefault(w, len(number)) for w in
                                  re.findall("[a-z0-9]+", (text or "").lower())], int)
    parts = []
    for k, text in items:
        own = read(text)
        ends = {*range(passage, len(own), passage // 2), len(own)} if len(own) else ()
        parts += [(k, own[max(0, e - passage):e]) for e in ends]
    best = {}
    for i, text in data:
        have = read(text)
        if not len(have):
            continue
        for (k, wanted), score in zip(parts, decontaminate.align(
                [w for _, w in parts], [have] * len(parts))):
            width = min(3, len(wanted))
            if score / (2 * len(wanted)) >= threshold \
                    and shingles(wanted, width) & shingles(have, width):
                best[i, k] = max(best.get((i, k), 0), score / (2 * len(wanted)))
    return best


def test_decontamination_equals_all_pairs(spark, monkeypatch):
    rng = random.Random(21)
    vocabulary = [f"v{k}" for k in range(3000)]
    common = "it is one of the most and so on".split()
    say = lambda n: [rng.choice(vocabulary) if rng.random() < 0.7
                     else rng.choice(common) for _ in range(n)]
    items = [(k, " ".join(say(rng.choice([2, 5, 20, 64, 65, 96, 130, 250])))) for k in range(25)]
    data = []
    for i in range(400):
        body = say(rng.randint(0, 200))
        if i % 2:
            copy = items[i % 7 if i % 5 else i % 25][1].split()  # some items leak widely
            a = rng.randrange(len(copy))
            copy = copy[a:a + rng.randint(5, 80)] if i % 3 else copy
            copy = [w if rng.random() > 0.12 else rng.choice(vocabulary) for w in copy]
            at = rng.randint(0, len(body))
            body[at:at] = copy
        data.append((i, " ".join(body)))
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(4)
    table = spark.createDataFrame(items, "item_id bigint, text string")
    want = plain_contamination(data, items)
    assert len(want) > 100
    monkeypatch.setattr(decontaminate, "DEAL_DOCS", 3)  # deals n-grams over tasks
    monkeypatch.setattr(decontaminate, "MOST_DEALT", 40)
    got = {(r[0], r[1]): r[2] for r in rows(decontaminate.contaminated(docs, table))}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


@pytest.mark.parametrize("at", range(0, 89, 8))
def test_a_leak_across_two_passages_fills_enough_of_one(at):
    starts = [*range(0, 64, 32), 64]
    assert max(min(at + 40, s + 64) - max(at, s) for s in starts) >= 0.5 * 64


def test_straddling_leak_is_found(spark):
    item = [f"t{k}" for k in range(128)]
    fill = lambda i: " ".join(f"f{i}x{k}" for k in range(90))
    data = [(i, f"{fill(i)} {' '.join(item[a:a + 40])} {fill(-i)}")
            for i, a in enumerate(range(0, 89, 8))]
    docs = spark.createDataFrame([*data, (99, fill(99))], "doc_id bigint, text string")
    table = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    found = {r[0]: r[2] for r in rows(decontaminate.contaminated(docs, table))}
    assert found.keys() == {i for i, _ in data} and min(found.values()) >= 0.5


def test_common_ngrams_yield_to_rarer_neighbours(spark):
    """Phrases of every document are no seeds beside n-grams that few documents hold."""
    phrase = "and so it is one of the most"
    data = [(i, f"{phrase} w{i} x{i} y{i} z{i}") for i in range(200)]
    leak = "a rare question that nobody else would ever think of asking here"
    data.append((500, f"before {phrase} {leak} after"))
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    items = decontaminate.passages(spark.createDataFrame(
        [(1, f"{phrase} {leak}")], "item_id bigint, text string"), 3, 64, "item_id", "text")
    every = items.selectExpr("explode(grams) AS gram").distinct()
    counts = decontaminate.documents_with(docs, decontaminate.bitmap(every), [3], "text")
    seeds = decontaminate.rare_seeds(items, counts, 201 ** 0.5, 2).collect()
    assert [r["docs"] for r in seeds].count(1) == 12 and len(seeds) < 19
    found = decontaminate.contaminated(docs, spark.createDataFrame(
        [(1, f"{phrase} {leak}")], "item_id bigint, text string"))
    assert (500, 1, 1.0) in rows(found)


def test_decontamination_of_a_very_long_text(spark):
    item = " ".join(f"t{k}" for k in range(60))
    body = " ".join(f"w{k % 9973}" for k in range(300_000))
    docs = spark.createDataFrame([(1, f"{body} {item} {body}"), (2, body)],
                                 "doc_id bigint, text string")
    table = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    assert rows(decontaminate.contaminated(docs, table)) == [(1, 7, 1.0)]


# ---- quality ---------------------------------------------------------------------------------

def test_quality_is_accurate_on_held_out_rows(spark, sf_dir):
    found = {r["doc_id"]: r for r in queries.op9_quality(spark, sf_dir).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
               for r in found.values())
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    test = [(r["quality"], found[r["doc_id"]]) for r in labels if found[r["doc_id"]]["held_out"]]
    good = [x["score"] for y, x in test if y == 1]
    bad = [x["score"] for y, x in test if y == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert np.mean([(y == 1) == (x["predicted"] == 1) for y, x in test]) > 0.9


def test_quality_on_awkward_rows(spark, docs, empty):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    for labels, score in ((none, 0.5), (spark.createDataFrame([(1, 1), (1, 1)], none.schema), 0.75)):
        model = quality.fit(quality.labelled_texts(docs, labels))
        scores = quality.score(quality.with_statistics(docs), model).select("score").collect()
        assert len(scores) == len(documents()) and {r[0] for r in scores} == {score}
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], none.schema)
    model = quality.fit(quality.labelled_texts(docs, labels))
    scores = [r[0] for r in quality.score(quality.with_statistics(docs), model)
              .select("score").collect()]
    assert np.isfinite(scores).all() and 0 <= min(scores) <= max(scores) <= 1
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(s >= 0.7 for s in scores)
    assert quality.accepted(empty, model).count() == 0


def test_discriminant_equals_gaussian_densities(spark):
    rng = np.random.default_rng(1)
    d = len(quality.FEATURES)
    x = rng.standard_normal((200, d)) * rng.uniform(0.5, 2, d)
    y = (np.arange(200) % 4 > 0).astype(int)
    x[y == 0] += 1
    table = spark.createDataFrame(list(zip(x.tolist(), y.tolist())),
                                  "statistics array<double>, label int").repartition(3)
    model = quality.fit(table, pooled=0.2, ridge=0.1)
    density = []
    for k in (0, 1):
        own = np.cov(x[y == k].T)
        both = sum(np.cov(x[y == j].T) * ((y == j).sum() - 1) for j in (0, 1)) / 198
        s = 0.8 * own + 0.2 * both
        s = 0.9 * s + 0.1 * np.diag(np.diag(s) + 1e-3) + 1e-6 * np.eye(d)
        z = x - x[y == k].mean(0)
        density.append(np.log(((y == k).sum() + 1) / 202) - 0.5 * np.linalg.slogdet(s)[1]
                       - 0.5 * (z @ np.linalg.inv(s) * z).sum(1))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(density[0] - density[1])))


# ---- mixing ----------------------------------------------------------------------------------

def plain_targets(size, weights=(3, 1, 2)):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + \
        [None] * (None in size)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    goal, full = 1.5 * sum(size.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        free = goal - sum(2 * size[s] for s in full)
        got = {s: 2.0 * size[s] if s in full else free * weight[s] / sum(map(weight.get, rest))
               for s in names}
        more = {s for s in rest if got[s] > 2 * size[s]}
        if not more:
            return got
        full |= more


@pytest.mark.parametrize("block_rows", [20_000, 10])
def test_mix_meets_targets(docs, block_rows):
    found = mix.copies(docs, block_rows=block_rows).toPandas()
    data = documents()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(found["size"]) == sorted(count(r[1]) for r in data)
    size = {}
    for r in data:
        size[r[3]] = size.get(r[3], 0) + count(r[1])
    targets = plain_targets(size)
    found["source"] = found["source"].where(found["source"].notna(), None)
    for name, part in found.groupby(found["source"].map(lambda s: s or "")):
        want = targets[name or None]
        assert part["target"].iloc[0] == pytest.approx(want)
        assert part["source_size"].iloc[0] == size[name or None]
        taken = (part["size"] * part["times"]).sum()
        # one document can be most of its source; else the landing leaves a few words
        largest = part["size"].max()
        assert abs(taken - want) <= (largest / 2 if largest > want / 4 else max(0.02 * want, 60))
        assert abs(part["times"].sum() - len(part) * want / size[name or None]) < 6
    assert found["times"].between(0, 2).all()


def test_mix_reruns_agree_and_rows_repeat(docs, empty):
    first = sorted(rows(mix.copies(docs)), key=str)
    assert first == sorted(rows(mix.copies(docs.repartition(7))), key=str)
    mixed = mix.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r[-1] for r in first)
    assert mix.mixed(empty).count() == 0 and mix.copies(empty).count() == 0


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 50, 500).astype(float)
    p = np.full(500, 0.37)
    got = mix.flight(p, x, rng.random)
    assert ((got > 0) & (got < 1)).sum() <= 2
    assert got.sum() == pytest.approx(p.sum()) and got @ x == pytest.approx(p @ x)


# ---- sharding --------------------------------------------------------------------------------

def test_shards_are_balanced_and_gapless(docs, empty):
    data = documents()
    found = shard.assign(docs, shards=4, bucket_rows=5).toPandas()
    assert len(found) == len(data) and set(found["law"]) == {"bytes"}
    assert sorted(zip(found["size"], found["text_crc32"])) == sorted(
        (len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in data)
    for _, part in found.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    held = found.groupby("shard")["size"].sum().reindex(range(4), fill_value=0)
    # the one long text is more than all others; they share the other shards evenly
    rest = held.drop(found.loc[found["size"].idxmax(), "shard"])
    assert rest.max() - rest.min() <= 5000  # a group of copies
    assert found.groupby(["size", "text_crc32"])["shard"].nunique().max() == 1
    assert shard.assign(empty).count() == 0
    out = shard.sharded(docs, shards=4)
    assert out.columns == [*docs.columns, "_size", "_shard", "slot"]
    assert out.count() == len(data)


def test_a_group_larger_than_a_shard_is_spread(spark):
    data = [(i, "same text") for i in range(900)] + [(i, f"other {i}") for i in range(900, 1800)]
    found = shard.assign(spark.createDataFrame(data, "doc_id bigint, text string"), shards=8)
    held = found.groupBy("shard").agg({"size": "sum"}).toPandas()["sum(size)"]
    assert len(held) == 8 and held.max() - held.min() <= 0.12 * held.mean()


def test_ring_moves_little():
    small, large = shard.ring(8, 64), shard.ring(9, 64)
    moved = [(a[0], b[0]) for a, b in zip(small, large) if a[0] != b[0]]
    assert all(b == 8 for _, b in moved) and len(moved) < 0.25 * shard.POSITIONS
