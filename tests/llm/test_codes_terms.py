"""Codebooks, the divergence audit and piece encoding against brute force and awkward rows."""

import hashlib
import math
import random
import re

import pytest

from lendmill.llm import codebooks, divergence, pieces, queries

DOCS = "doc_id bigint, text string, lang string, source string"


# ---- codebooks -------------------------------------------------------------------------------

def plain_books(rows, positions, size, rounds, scale=256):
    """Lloyd rounds over all parts, as plain loops."""
    rows = [[math.floor(scale * x) for x in v] for _, v in rows]
    width = len(rows[0]) // positions
    cut = [[tuple(r[p * width:(p + 1) * width]) for r in rows] for p in range(positions)]
    books = [[list(c) for c in column[:size]] for column in cut]

    def near(part, book):
        d = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return min(range(len(d)), key=lambda i: (d[i], i)), min(d)

    for _ in range(rounds):
        for p in range(positions):
            members = [near(x, books[p])[0] for x in cut[p]]
            for e in range(len(books[p])):
                mine = [x for x, m in zip(cut[p], members) if m == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[near(cut[p][i], books[p]) for p in range(positions)] for i in range(len(rows))]
    return books, [([c for c, _ in f], sum(d for _, d in f)) for f in found]


def vectors(seed=5, rows=150, width=8, huge=1.0):
    rng = random.Random(seed)
    out = [(i * 3 % 151, [rng.gauss(0, 1) * huge for _ in range(width)]) for i in range(rows)]
    return out + [(200 + i, out[7][1]) for i in range(60)] + [out[3], (None, out[5][1])]


@pytest.mark.parametrize("size,huge", [(6, 1.0), (400, 1.0), (5, 80_000.0)])
def test_codebooks_equal_plain_rounds(spark, size, huge):
    good = vectors(huge=huge)
    bad = [(1, None), (2, [1.0] * 7 + [float("nan")]), (0, [None] + [1.0] * 7), (4, []),
           (5, [float("inf")] * 8)]
    table = [(i, v, 1, "x") for i, v in [*good, *bad]]
    df = spark.createDataFrame(table, "vec_id int, embedding array<double>, position int, salt string")
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books, codes = plain_books(good, 4, size, 2)
    found = codebooks.fit(df.repartition(5), positions=4, size=size, rounds=2)
    assert found.entries.tolist() == books
    coded = codebooks.encode(df, found, keep=["vec_id"]).collect()
    key = lambda r: repr(r)
    assert sorted(((r.vec_id, r.code, r.error) for r in coded), key=key) == sorted(
        ((i, c, e) for (i, _), (c, e) in zip(good, codes)), key=key)


def test_codebooks_empty_table_and_bad_width(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    books = codebooks.fit(empty)
    assert codebooks.encode(empty, books).count() == 0
    assert books.sha256() == hashlib.sha256(b"").hexdigest()
    odd = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "vec_id bigint, embedding array<float>")
    with pytest.raises(ValueError):
        codebooks.fit(odd, positions=2)


def test_group_total_hot_and_null_groups(spark):
    rows = [(i, i % 3 if i % 2 else None, i) for i in range(300)] + [(999, 500 + i, 1)
                                                                    for i in range(300)]
    df = spark.createDataFrame(rows, "k int, label int, error bigint")
    sums = {}
    for _, g, e in rows:
        sums[g] = sums.get(g, 0) + e
    for hot in (2, 64):
        found = codebooks.with_group_total(df, "label", "error", "total", hot).collect()
        assert len(found) == len(rows) and all(r.total == sums[r.label] for r in found)


def test_op11_equals_plain_rounds(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    good = sorted(((r.vec_id, r.embedding) for r in table))
    books, codes = plain_books(good, 16, 64, 2)
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    label = {r.vec_id: r.label for r in table}
    total = {}
    for (i, _), (_, e) in zip(good, codes):
        total[label[i]] = total.get(label[i], 0) + e
    found = {r.vec_id: r for r in queries.QUERIES["op11_codebooks"](spark, sf_dir).collect()}
    assert len(found) == len(good)
    for (i, _), (c, e) in zip(good, codes):
        r = found[i]
        assert (r.code, r.error, r.label_error, r.codebooks_sha256) == (
            "".join(f"{x:02x}" for x in c), e, total[label[i]],
            hashlib.sha256(text.encode()).hexdigest())


# ---- divergence ------------------------------------------------------------------------------

def plain_audit(rows, least=3, top=200):
    docs = [(lang or "", source or "", re.findall("[A-Za-z\x80-\U0010ffff]+", text or ""))
            for _, text, lang, source in rows]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang, source, [w.translate(low) for w in words]) for lang, source, words in docs]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        has = {}
        for _, _, words in mine:
            for w in set(words):
                has[w] = has.get(w, 0) + 1
        kept = {w for w, n in has.items() if n >= least}

        def shares(some):
            n = dict.fromkeys(kept, 0)
            for _, _, words in some:
                for w in words:
                    if w in kept:
                        n[w] += 1
            total = sum(n.values())
            return n, {w: 1 + 10 ** 9 * (c + 1) // (total + len(kept)) for w, c in n.items()}

        _, q = shares(mine)
        of = {s: shares([d for d in mine if d[1] == s]) for s in {d[1] for d in mine}}
        for s, (n, p) in of.items():
            pairs = [(t, sum((p[w] - r[w]) ** 2 // r[w] for w in kept))
                     for t, (_, r) in of.items() if t != s]
            terms = [(w, (p[w] - q[w]) ** 2 // q[w]) for w in kept if n[w] > 0 and p[w] > q[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(found)
                        if part == "pair" or k < top]
    return sorted(out)


def corpus(seed=8, rows=150, sources=5):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abCdéßΩ") for _ in range(rng.randint(1, 3)))
                  for _ in range(120)]
    out = [(i, " ".join(rng.choice(vocabulary[:rng.randint(3, 120)])
                        for _ in range(rng.randint(0, 60))) + rng.choice(["", "!x1y", "\x00z"]),
            rng.choice(["en", "de", None]), rng.choice([*map(str, range(sources)), None]))
           for i in range(rows)]
    return out + [out[0], out[0], (None, None, None, "only"), (1, "", "xx", "p"), (2, "1 2", "xx", "q"),
                  (3, "a " * 70_000 + "b" * 9_000, "de", "1")]


@pytest.mark.parametrize("terms,groups,tile,held,step", [(1024, 64, 1024, 100_000, 1 << 20),
                                                        (16, 2, 8, 50, 100)])
def test_audit_equals_brute_force(spark, monkeypatch, terms, groups, tile, held, step):
    for name, value in (("TERMS", terms), ("GROUPS", groups), ("TILE", tile), ("HELD", held),
                        ("STEP", step)):
        monkeypatch.setattr(divergence, name, value)
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{DOCS}, n int, term string")
    found = sorted(tuple(r) for r in divergence.audit(df.repartition(4), top=30).collect())
    assert found == plain_audit(rows, top=30)


def test_audit_of_an_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_terms_of_long_texts_in_steps(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice("abZé 1") for _ in range(3_000)) + "q" * 500 + " " + "w" * 300
    whole = [w for some in divergence.terms_of(text.encode()) for w in some]
    for step in (1, 7, 64, 450):
        monkeypatch.setattr(divergence, "STEP", step)
        assert [w for some in divergence.terms_of(text.encode()) for w in some] == whole


# ---- pieces ----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(model):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=model)


def strange_texts(rng, n):
    letters = ["abcdefgh ", "ab ", "  \n\t", "aeiou ▁tshn ", "héßñ漢字 \u0000😀", " ",
               "the in er on <s></s><0x0A>▁", "0123456789. "]
    for _ in range(n):
        some = rng.choice(letters)
        yield "".join(rng.choice(some) for _ in range(rng.randint(0, 60)))


def test_encoder_and_decoder_equal_the_library(model, library):
    vocabulary = pieces.load(model)
    words = pieces.Words(pieces.Encoder(vocabulary, vocabulary.usable()))
    cut, decoder = vocabulary.words(), pieces.Decoder(vocabulary)
    rng = random.Random(4)
    long = ["a" * 30_000, " " * 30_000, "ab" * 20_000, "漢字" * 9_000,
            "".join(rng.choice("abcdefghijklmnop") for _ in range(50_000))]
    for text in [*strange_texts(rng, 8_000), *long]:
        marked = pieces.MARK + text.replace(" ", pieces.MARK) if text else ""
        found = [i for w in cut.findall(marked) for i in words[w]]
        assert found == library.encode(text)
        assert decoder.decode(found) == library.decode(found)
    for _ in range(8_000):  # ids that no text gives
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259), rng.randrange(3)])
               for _ in range(rng.randint(0, 12))]
        assert decoder.decode(ids) == library.decode(ids)


def test_seams_equal_merging_again(model):
    vocabulary = pieces.load(model)
    encoder = pieces.Encoder(vocabulary, vocabulary.usable())
    names, rng = encoder.usable, random.Random(6)
    place = {p: i for i, p in enumerate(names)}
    for _ in range(20_000):
        whole = rng.choice(names)
        cut = rng.randrange(1, len(whole) + 1)
        a, b = whole[:cut], whole[cut:] + rng.choice(names)
        a, b = place.get(a, rng.randrange(len(names))), place.get(b, rng.randrange(len(names)))
        joined = names[a] + names[b]
        assert encoder._compatible(a, b) == (vocabulary.merge(joined)[0] == [names[a], names[b]])


def test_encode_and_decode_tables(spark, model, library):
    vocabulary = pieces.load(model)
    texts = [None, "", " ", "Hello  world", "Hello  world", "x▁y\n\n", "😀" * 5, "word " * 40_000]
    df = spark.createDataFrame([(i, t, "mine", [1]) for i, t in enumerate(texts)],
                               "doc_id int, text string, _text string, ids array<int>")
    found = pieces.decode(pieces.encode(df, vocabulary), vocabulary).orderBy("doc_id").collect()
    for r, text in zip(found, texts):
        assert r.ids == [*library.encode(text or ""), library.eos_id()]
        assert r.decoded == library.decode(r.ids) and r._text == "mine"
    empty = pieces.encode(df.limit(0), vocabulary)
    assert pieces.decode(empty, vocabulary).count() == 0


def test_op13_equals_the_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in queries.QUERIES["op13_pieces"](spark, sf_dir).collect():
        ids = [*library.encode(texts[r.doc_id] or ""), library.eos_id()]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
