"""Language identification, the Merkle manifest and vector codes against plain forms of themselves."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm import codes, langid, merkle

SF_DIR = "/root/testdata/sf0.01"
RANDOM = random.Random(11)
CLASHING = ["tree", "block", "position", "total", "digest", "path", "slice", "hash", "bucket", "best", "margin", "score", "vector", "length", "value", "part"]


VOCABULARY = {}


def words(letters, n):
    """Words of a small vocabulary of the letters."""
    if letters not in VOCABULARY:
        VOCABULARY[letters] = ["".join(RANDOM.choice(letters) for _ in range(RANDOM.randint(3, 9))) for _ in range(60)]
    return " ".join(RANDOM.choice(VOCABULARY[letters]) for _ in range(n))


# ---- language identification


def test_language_edges(spark):
    rows = [(i, words("abcde", 40), "a") for i in range(60)] + [(100 + i, words("vwxyz", 40), "z") for i in range(30)]
    rows += [(200 + i, "123 !", "digits") for i in range(5)] + [(300, None, "z"), (301, "", "a"), (302, "12 !?", "a"), (303, words("abcde", 20), None)]
    rows += [(304, words("abcde", 60_000), "a"), (305, words("vwxyz", 3).upper(), None), (None, words("abcde", 9), "a"), (3, rows[3][1], "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).select("*", *(F.lit("x").alias(c) for c in CLASHING))
    got = {(r.doc_id, r.lang_pred): r for r in langid.predict_documents(docs).collect()}
    assert langid.predict_documents(docs).count() == len(rows)
    want = {(i, "und" if not t or not any(c.isalpha() for c in t) else "z" if set(t.lower()) & set("vwxyz") else "a") for i, t, _ in rows}
    assert set(got) == want
    for (_, lang), r in got.items():
        assert 0 <= r.score <= 1 and (lang != "und" or (r.score == 0 and not r.accepted))
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert got[304, "a"].accepted and got[305, "z"].score > 0
    assert langid.predict_documents(docs.filter("doc_id = -1")).count() == 0
    unlabelled = langid.predict_documents(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred", "score").distinct()
    assert [tuple(r) for r in unlabelled.collect()] == [("und", 0.0)]
    alone = langid.predict_documents(docs.withColumn("lang", F.lit("a"))).filter("doc_id = 4").first()
    assert alone.lang_pred == "a" and alone.accepted


def test_language_margin_and_sizes(spark):
    """The predicted language has the smallest sum of compressed pieces; narrow margins are rejected."""
    dictionaries = [("one", words("abcdefgh", 800).encode()), ("two", words("hgfedcba", 800).encode()), ("three", words("stuvwxyz", 800).encode())]
    model = langid.Model(dictionaries)
    texts = [words("abcdefgh", 50), dictionaries[1][1].decode()[500:900], words("stuvwxyz", 30), words("ijkl", 20_000), "ab", "".join(RANDOM.choice("ijkl ") for _ in range(3000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in langid.identify(docs, model).collect():
        plain = langid.normalised(__import__("pyarrow").array([texts[r.doc_id]]))[0].as_py().encode()
        sizes = {}
        for name, dictionary in dictionaries:
            sizes[name] = sum(len(langid.coder(dictionary).compress(plain[a : a + langid.PIECE])) for a in range(0, len(plain), langid.PIECE))
        first, second = sorted(sizes.values())[:2]
        assert sizes[r.best] == first and r.margin == (second - first) / len(plain)
        assert r.lang == (r.best if r.margin >= langid.MARGIN else "und")
    assert model.judged(b"")[0] == "und" and langid.identify(docs, model).filter("doc_id = 1").first().lang == "two"


def test_language_copies_do_not_fill_the_sample(spark):
    copy = words("abcdefgh", 30)
    docs = spark.createDataFrame([(i, copy if i % 2 else words("abcdefgh", 30), "a") for i in range(400)], "doc_id long, text string, lang string")
    model = langid.learned(docs, samples=64)
    assert model.dictionaries[0][1].count(copy.encode()[:60]) == 1 and len(model.dictionaries[0][1]) > 5_000
    many = docs.withColumn("lang", (F.col("doc_id") % 7).cast("string"))
    assert len(langid.learned(many, languages=5).dictionaries) == 5


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = langid.predict_documents(docs).filter("held_out").join(docs, "doc_id").filter(r"text rlike '\\p{L}'")
    right, sure, n = got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.avg(F.col("accepted").cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.98 and sure > 0.95


# ---- Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves):
    """The top, and for each leaf the (before, after) digests of each level."""
    nodes, paths, own = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(nodes) > 1:
        for path, at in zip(paths, own):
            first = at - at % 8
            path.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 8])))
        nodes, own = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)], [at // 8 for at in own]
    return nodes[0], paths


def plain_leaf(row, text):
    fields = [row[0], row[1], row[2], row[3], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def plain_merkle(rows):
    groups = {}
    for r in rows:
        changed = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if changed else r[4]
        groups.setdefault(r[2], []).append((r[0], plain_leaf(r, r[4]), plain_leaf(r, lower)))
    trees = {}
    for lang in sorted(groups, key=lambda x: (x is not None, (x or "").encode())):
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = plain_tree([leaf for _, leaf, _ in groups[lang]])
    root, upper = plain_tree([top for top, _ in trees.values()])
    out = []
    for (lang, (subroot, paths)), above in zip(trees.items(), upper):
        for (i, leaf, other), path in zip(groups[lang], paths):
            folded = other
            for before, after in path + above:
                folded = sha(before + folded + after)
            out.append((i, leaf, subroot, root, sha("".join(b + a for b, a in path + above)), folded, folded == root))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("height", [4, 1, 2])
def test_merkle_is_the_plain_tree(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "SPAN", 8**height)
    rows = [(i, "s", "en", 5, f"Text {i}") for i in range(530)] + [(i, None, "de", None, "Ü" * (i % 5)) for i in range(1000, 1065)]
    rows += [(i, "s", None, 1, f"N{i}") for i in range(2000, 2009)] + [(3000, "s", "fr", 1, None), (3001, "", "", 0, ""), (3002, "s", "zh", 1, "LONG " * 50_000)]
    rows += [(None, "s", "en", 1, "ABC"), (None, None, None, None, None), (7, "s", "en", 5, "Text 7"), (7, "s", "en", 5, "TEXT 7")]
    rows += [(4000 + i, "s", f"l{i}", 1, "A") for i in range(9)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).select("*", *(F.lit("x").alias(c) for c in CLASHING))
    got = sorted(map(tuple, merkle.tampered_documents(docs).collect()), key=repr)
    assert got == sorted(plain_merkle(rows), key=repr)
    assert {g[6] for g in got} == {True, False}


def test_merkle_edges(spark):
    docs = spark.createDataFrame([(5, "s", "en", 1, "A")], SCHEMA)
    (row,) = merkle.tampered_documents(docs).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")
    assert merkle.tampered_documents(docs.filter("doc_id = 6")).count() == 0
    same = spark.createDataFrame([(5, "s", "en", 1, "A")] * 70, SCHEMA)  # one row repeated
    assert sorted(map(tuple, merkle.tampered_documents(same).collect())) == sorted(plain_merkle([(5, "s", "en", 1, "A")] * 70))
    tree = merkle.manifest(merkle.leaves(same))
    for r in merkle.verified(tree, with_siblings=True).collect():
        assert r.verified and sha(r.siblings) == r.proof_sha256 and len(r.siblings) % 64 == 0


def test_states_resume():
    subtree = merkle.Subtree([sha(str(i)).encode() for i in range(70)], 3)
    for slot in (0, 7, 8, 63, 64, 69):
        nodes = [sha(str(i)) for i in range(70)]
        nodes[slot] = sha("changed")
        assert subtree.fold(slot, sha("changed").encode()).decode() == plain_tree(nodes)[0]
        assert list(subtree.around(slot)) == [(b.encode(), a.encode()) for b, a in plain_tree([sha(str(i)) for i in range(70)])[1][slot]]


# ---- vector codes


def plain_nearest(point, book):
    return min((sum((a - b) ** 2 for a, b in zip(point, entry)), e) for e, entry in enumerate(book))


@pytest.mark.parametrize("spread, factor", [(3, 1), (1000, 1), (1000, 1 << 45)])
def test_orchard_is_exact(spread, factor):
    random_ = np.random.default_rng(spread)
    books = random_.integers(-spread, spread, (4, 16, 3)).astype(object) * factor
    points = random_.integers(-spread, spread, (300, 4, 3)).astype(object) * factor
    books[2, 5] = books[2, 9]  # equal entries: the lower number wins
    points[:16, 2] = books[2]
    narrow = (lambda x: x.astype(np.int64)) if factor == 1 else lambda x: x
    found, errors = codes.orchard(narrow(points), narrow(books))
    for i in range(300):
        for p in range(4):
            assert (errors[i, p], found[i, p]) == plain_nearest(points[i, p].tolist(), books[p].tolist())


def plain_codes(rows, parts=8, entries=16, rounds=6):
    good = [r for r in rows if r[1] is not None and len(r[1]) == 16 and all(x is not None and math.isfinite(x) for x in r[1])]
    cut = [[[(int(x) * 4096 if abs(x) > 2**52 else math.floor(4096 * x)) for x in r[1][p * 2 : p * 2 + 2]] for p in range(parts)] for r in good]
    first = sorted(range(len(good)), key=lambda i: (good[i][0] is None, good[i][0] or 0, good[i][1]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            near = [plain_nearest(v[p], books[p])[1] for v in cut]
            for e in range(len(books[p])):
                own = [v[p] for v, n in zip(cut, near) if n == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    found = [[plain_nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    digest = sha(",".join(str(x) for book in books for entry in book for x in entry))
    error = [min(codes.LARGEST, sum(d for d, _ in f)) for f in found]
    by_label = {}
    for r, e in zip(good, error):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return [(r[0], "".join(f"{e:02x}" for _, e in f), x, min(codes.LARGEST, by_label[r[2]]), digest) for r, f, x in zip(good, found, error)]


@pytest.mark.parametrize("kind, huge", [("float", False), ("double", False), ("double", True)])
def test_codes_are_the_plain_ones(spark, kind, huge):
    random_ = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in random_.normal(0, 0.3, 16)], int(i % 3) if i % 5 else None) for i in range(90)]
    rows += [(90 + i, rows[i][1], 1) for i in range(10)] + [(3, rows[3][1], 0), (None, rows[4][1], None), (None, None, 1)]
    rows += [(200, None, 1), (201, [], 1), (202, [1.0] * 8, 1), (203, [1.0] * 7, 2), (204, [0.5] * 15 + [float("nan")], 0)]
    rows += [(205, [0.5] * 15 + [float("inf")], 0), (206, [None] + [0.5] * 15, 0), (207, [0.0] * 16, 7), (208, [-0.0] * 16, 7)]
    rows += [(300, [1e300, -1e20] * 8, 4), (301, [3e19, 1.5] * 8, 4)] if huge else []
    schema = T.StructType.fromDDL(f"vec_id long, embedding array<{kind}>, label int")
    df = spark.createDataFrame(rows, schema).repartition(4).select("*", *(F.lit("x").alias(c) for c in CLASHING))
    assert sorted(map(tuple, codes.compress(df).collect()), key=repr) == sorted(plain_codes(rows), key=repr)
    assert codes.compress(df.filter("vec_id = -1")).count() == 0 and codes.compress(df.filter("vec_id in (200, 201, 203)")).count() == 0
    few = [r for r in rows if r[0] in (1, 2, 4)]
    assert sorted(map(tuple, codes.compress(df.filter("vec_id in (1, 2, 4)")).collect())) == sorted(plain_codes(few))


def test_codes_decode(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    vectors = codes.usable(df, "vec_id", "embedding", None, 8)
    books = codes.codebooks(vectors, rounds=3)
    back = codes.decoded(codes.encoded(vectors, books), books).join(vectors.select("vec_id", F.col("vector").alias("own")), "vec_id")
    for r in back.limit(50).collect():
        assert sum((math.floor(4096 * x) - round(4096 * y)) ** 2 for x, y in zip(r.own, r.vector)) == r.error
    assert codes.limbs(0) == [] and codes.limbs(-(5 << 32) - 7) == [-7, -5]
