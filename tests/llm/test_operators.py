"""Each operator against a plain form of itself, on nulls, empty and long texts, ties, repeated rows, empty tables and
extra columns with the names of helper columns."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import bpe, chat, fingerprints, jaccard, packing, substrings, topk, toxicity, url_filter, warc
from stratalake.llm.common import written
from stratalake.llm.components import connected

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
RANDOM = random.Random(7)


def prose(n, letters="abcdefghijklmnop"):
    return " ".join("".join(RANDOM.choice(letters) for _ in range(RANDOM.randint(2, 9))) for _ in range(n))


LONG = prose(30_000)
TEXTS = [None, "", " \n\t", "a", "A a\tb", "日本語のテキスト。" * 40, "naïve Ünïcode ΣΑΣ İx é ́x 😀", "the. " * 3000, "x" * 20_000,
         "<|endoftext|> a<|endoftext|>", "\x1c a\x1d\x85 ᠎ b", "<|im_end|><\\|x|>\\", "it's WE'LL 'S 12 345\n\n\n  y ", LONG, prose(300), prose(300)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (None, "no id"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    extra = ["id", "score", "node", "digest", "kind", "_doc", "__digests", "range", "tail", "sequence_id", "start", "_bin"]
    return df.select("*", *(F.lit("x").alias(c) for c in extra))


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("doc_id = -5")


def by_key(df, *keys):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, v) for v in r[: len(keys) or 1]) + (repr(r),))


def test_bpe_is_the_library(docs, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE)
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((r.doc_id, len(ids), sha, hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert by_key(bpe.round_trip_digests(docs, BYTE)) == sorted(want, key=lambda r: ((r[0] is None, r[0]), repr(r)))
    assert bpe.round_trip_digests(none, BYTE).count() == 0
    back = bpe.decode_documents(bpe.encode_documents(docs, BYTE), BYTE)
    assert by_key(back) == by_key(docs.select("doc_id", F.coalesce("text", F.lit(""))))


def test_bpe_joins():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE)
    shared = prose(800)
    texts = [prose(50) + shared + prose(70), "y" + shared, shared.replace(" ", ""), shared.replace(" ", "  \n"), "é" + shared]
    before, bpe.CHUNK = bpe.CHUNK, 32
    try:
        assert list(bpe.encoded(pa.array(texts), BYTE)) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    finally:
        bpe.CHUNK = before


def word_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD).encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("window", [4096, 64])
def test_packing(docs, none, window):
    got = packing.pack_documents(docs, WORD, window=window, keep_ids=True).collect()
    whole, sequences = {}, {}
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        whole.setdefault((r.doc_id, r.doc_tokens), {}).setdefault(r.start, []).append(r.ids)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    for r in docs.select("doc_id", "text").collect():
        ids = word_ids(r.text)
        pieces = whole[r.doc_id, len(ids)]
        assert sorted(pieces) == list(range(0, len(ids), window))
        assert b"".join(pieces[s][0] for s in sorted(pieces)) == np.array(ids, "<u4").tobytes()
    assert sum(r.length for r in got) == sum(len(word_ids(r.text)) for r in docs.collect())
    assert packing.pack_documents(none, WORD).count() == 0


def test_packing_deals_out_identical_rows(spark, monkeypatch):
    """However many rows are alike, no group of the greedy rest has more than SHARD of them."""
    monkeypatch.setattr(packing, "SHARD", 50)
    sizes = spark.sparkContext.accumulator(0)
    known = packing.best_fit

    def counted(lengths, window):
        sizes.add(max(0, len(lengths) - 50))
        return known(lengths, window)

    monkeypatch.setattr(packing, "best_fit", counted)
    pieces = spark.range(600).select(F.lit(1).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("start"), F.when(F.col("id") < 500, 3001).otherwise(F.col("id")).cast("int").alias("length"), F.lit(5).cast("long").alias("ids_crc32"))
    got = packing.pack_pieces(written(pieces, "alike"), 4096).collect()
    assert len(got) == 600 and sizes.value == 0
    spans = {}
    for r in got:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in spans.values():
        assert [o for o, _ in sorted(own)] == np.cumsum([0, *(n for _, n in sorted(own))])[:-1].tolist() and sum(n for _, n in own) <= 4096


def test_packing_plan():
    random_ = np.random.default_rng(1)
    histogram = np.bincount(-(-np.minimum(4096, random_.lognormal(6.5, 1, 20_000).astype(int) + 1) // 16), minlength=257)
    rows, _ = packing.plan_rows(histogram, 256)
    used = np.zeros(257, int)
    sums = {}
    for b, low, high, first, position, depth in rows:
        assert low == used[b]
        used[b] = high
        sums[first] = sums.get(first, 0) + b
    assert (used <= histogram).all() and used.sum() > 0.2 * histogram.sum() and set(sums.values()) == {256}
    places, offsets = packing.best_fit([3000, 1096, 2000, 2000, 90, 6], 4096)
    assert places == [0, 0, 1, 1, 1, 1] and offsets == [0, 3000, 0, 2000, 4000, 4090]


@pytest.mark.parametrize("kind, least", [("short", 0.98), ("mixed", 0.98), ("few", 0.95)])
def test_packing_plans_nearly_all(kind, least):
    """Short pieces take part in the plan like long ones, in combinations of as many pieces as are needed."""
    random_ = np.random.default_rng(4)
    lengths = random_.integers(5, 601, 50_000) if kind == "short" else np.minimum(4096, random_.lognormal(6.2, 1.2, 20_000 if kind == "mixed" else 4_000).astype(int) + 1)
    histogram = np.bincount(lengths, minlength=4097)
    rows, sequences = packing.plan_rows(histogram, 4096)
    held = np.bincount(packing.bin_sizes(histogram), histogram, 4097)
    used, sums = np.zeros(4097, int), np.zeros(sequences, int)
    for b, low, high, first, position, depth in rows:
        assert low == used[b]
        used[b] = high
        sums[first : first + high - low] += b
    assert (used <= held).all() and (sums <= 4096).all() and (sums >= 4096 - 4).all()
    assert used.sum() >= least * len(lengths)
    assert sum(high - low for _, low, high, *_ in packing.runs(rows)) == used.sum()


def test_best_combination_is_the_best():
    random_ = np.random.default_rng(8)
    for _ in range(40):
        sizes, window = np.sort(random_.choice(np.arange(1, 20), 4, replace=False)), 30
        counts, worth = random_.integers(0, 4, 4), random_.normal(0, 3, 4)
        every = [np.array(c) for c in np.ndindex(*(counts + 1)) if 28 <= np.dot(c, sizes) <= window]
        got = packing.best_combination(worth, sizes, counts, 28, window)
        assert (got is None) == (not every)
        if every:
            assert (got <= counts).all() and 28 <= got @ sizes <= window and np.isclose(got @ worth, max(c @ worth for c in every))


def test_packing_ranks_identical_rows_in_shards(spark, monkeypatch):
    """Rows that are alike in every column are planned and packed like others, whatever shard they are ranked in."""
    monkeypatch.setattr(packing, "SHARD", 40)
    pieces = spark.range(1000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("start"), F.when(F.col("id") < 700, 300).otherwise(F.col("id") + 2000).alias("length"), F.lit(5).cast("long").alias("ids_crc32"))
    got = packing.pack_pieces(written(pieces.repartition(4), "alike"), 4096).collect()
    spans = {}
    for r in got:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(r.length for r in got) == sorted([300] * 700 + list(range(2700, 3000)))
    for own in spans.values():
        assert [o for o, _ in sorted(own)] == np.cumsum([0, *(n for _, n in sorted(own))])[:-1].tolist() and sum(n for _, n in own) <= 4096


def test_packing_pads_little(spark):
    docs = spark.createDataFrame([(i, prose(RANDOM.randint(1, 500))) for i in range(700)], "doc_id long, text string")
    got = packing.pack_documents(docs, WORD).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sum(r.n for r in got) > 0.97 * 4096 * len(got)


def test_least_squares():
    matrix = np.random.default_rng(0).integers(0, 3, (8, 30)).astype(float)
    target = matrix @ np.maximum(0, np.arange(30) - 25.0)
    x = packing.least_squares(matrix, target)
    assert (x >= 0).all() and np.allclose(matrix @ x, target)
    assert not packing.least_squares(matrix, np.zeros(8)).any()


def test_chat(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "user", said), (1, 1, "assistant", said), (1, 1, "assistant", said), (2, None, None, None), (2, 0, "assistant", None),
            (None, 0, "a\\n\nb<|", "x<"), (None, 1, "assistant", "<\\|é"), (3, 0, "user", "y" * 40_000), (3, 1, "assistant", LONG)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1)).repartition(3)
    formatted = chat.format_conversations(df)
    got = {r.conv_id: r for r in chat.conversation_digests(formatted).collect()}
    for key in (1, 2, 3, None):
        own = sorted(((t if t is not None else -1, r or "", s or "") for k, t, r, s in rows if k == key))
        text = "".join(f"{r}\n{s}\n" for _, r, s in own)
        learn = "".join(s for _, r, s in own if r == "assistant")
        assert got[key].n_turns == len(own) and got[key].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert got[key].loss_chars == len(learn) and got[key].loss_sha256 == hashlib.sha256(learn.encode()).hexdigest()
    assert chat.conversation_digests(chat.format_conversations(df.filter("turn = 9"))).count() == 0
    whole = b"".join(r.formatted for r in chat.sorted_segments(formatted.filter("conv_id = 1")).collect()).decode()
    assert whole.count("<|im_end|>") == 3 and chat.read_turns(whole) == [("user", said), ("assistant", said), ("assistant", said)]


def plain_top(rows, k, every):
    out = []
    ints = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, v in sorted({(i, tuple(v)) for i, v in ints if i % every == 0}):
        scores = {}
        for i, w in ints:
            if i != q and len(w) == len(v):
                scores[i] = max(scores.get(i, -(1 << 62)), sum(a * b for a, b in zip(v, w)))
        out += [(q, n + 1, i, s) for n, (i, s) in enumerate(sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return sorted(out)


def test_top_k(spark):
    random_ = np.random.default_rng(3)
    rows = [(i, [float(x) for x in random_.normal(0, 0.2, 24).astype(np.float32)]) for i in range(900)]
    rows += [(900 + i, rows[50][1]) for i in range(20)]  # ties
    rows += [(950, None), (1000, [None] * 24), (1050, [float("nan")] * 24), (1100, [float("inf")] * 24), (None, rows[0][1]), (1150, [1.0, 2.0]), (7, rows[7][1]), (1200, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(0)).repartition(3)
    assert sorted(map(tuple, topk.top_k(df).collect())) == plain_top(rows, 5, 50)
    before = topk.QUERY_BLOCK, topk.CANDIDATE_BLOCK
    topk.QUERY_BLOCK, topk.CANDIDATE_BLOCK = 4, 300
    try:
        assert sorted(map(tuple, topk.top_k(df).collect())) == plain_top(rows, 5, 50)
    finally:
        topk.QUERY_BLOCK, topk.CANDIDATE_BLOCK = before
    assert topk.top_k(df.filter("vec_id < 0")).count() == 0
    assert topk.top_k(df.filter("vec_id in (0, 1)")).collect()[0].vec_id == 1


def test_fingerprints(docs, none, spark):
    rows = {}
    for r in docs.select("doc_id", "text").collect():
        rows.setdefault(r.doc_id, []).append(r.text or "")
    order = [(i, t) for i in sorted((k for k in rows if k is not None), reverse=True) for t in sorted(rows[i])] + [(None, t) for t in sorted(rows[None])]
    want = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        a, b, c = (fingerprints.fingerprint(t) for t in (text, edited, after))
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, fingerprints.likeness(a, b), fingerprints.likeness(a, c)))
    for ranges in (1, 3, None):
        assert by_key(fingerprints.fingerprint_documents(docs, ranges=ranges)) == sorted(want, key=lambda r: ((r[0] is None, r[0]), repr(r)))
    assert fingerprints.fingerprint_documents(none).count() == 0
    assert fingerprints.fingerprint(None) == "3::" and fingerprints.likeness("3::", "3::") == 1.0
    near = [fingerprints.likeness(fingerprints.fingerprint(t), fingerprints.fingerprint(t[: 2 * len(t) // 3] + prose(200)[: len(t) // 3])) for t in (prose(200) for _ in range(20))]
    far = [fingerprints.likeness(fingerprints.fingerprint(prose(200)), fingerprints.fingerprint(prose(200))) for _ in range(20)]
    assert min(near) > 0.45 and max(far) < 0.3


def test_common_length():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row, old = [0], row
            for j, y in enumerate(b):
                row.append(old[j] + 1 if x == y else max(old[j + 1], row[-1]))
        return row[-1]

    for _ in range(200):
        a, b = ("".join(RANDOM.choice("abcd") for _ in range(RANDOM.randint(1, 70))) for _ in range(2))
        assert fingerprints.common_length(a, b) == plain(a, b)


def test_warc(spark, tmp_path):
    same = "<p>same é</p>"
    rows = [(5, "http://a/ b\r\nX: y", same), (3, "http://c", same), (9, None, same), (9, None, same), (None, "http://d", same), (1, "u", None), (2, "u", ""),
            (4, "u", "z" * 900_000), (6, "u", "HTTP/1.1\r\n\r\nWARC/1.1")] + [(i, "u", prose(40)) for i in range(100, 160)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha1", F.lit(1)).withColumn("first", F.lit(1)).repartition(2)
    got = by_key(warc.archived(pages))
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        refers = min(ids) if ids and len([1 for r in rows if (r[2] or "") == (html or "")]) > 1 and page != min(ids) else None
        want.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if refers is None else "revisit", refers))
    assert got == sorted(want, key=lambda r: ((r[0] is None, r[0]), repr(r)))
    assert warc.archived(pages.filter("page_id = -1")).count() == 0
    folder = f"file://{tmp_path}/bundles"
    index = written(warc.write_bundles(pages, folder, least_bytes=5), "index")
    place = index.filter("page_id = 150").first()
    found = warc.read_record(folder, place.bundle, place.frame, place.offset)
    assert found["page"] == "150" and found["payload"].decode() == dict((r[0], r[2]) for r in rows)[150]
    types = {r.page: r.record_type for r in warc.read_bundles(index, folder, with_payload=True).collect()}
    assert types["1"] == types["2"] == "response" and types["9"] == "revisit"
    import zstandard

    raw = open(f"{tmp_path}/bundles/{place.bundle}", "rb").read()
    assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read().count(b"WARC/1.1\r\nWARC-Type") > 5


def test_substrings(spark, docs, none):
    passage, other = prose(60), prose(45)
    rows = [(1, prose(200) + " " + passage + " " + prose(100)), (2, prose(30) + "\n" + passage + " " + prose(250)), (3, passage), (4, prose(400)), (5, None), (6, ""),
            (7, prose(20) + " " + " ".join(passage.split()[:12]) + " " + prose(20)), (None, passage), (8, other + " " + prose(90) + " " + other), (4, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_doc", F.lit(1)).withColumn("__digests", F.lit("k")).repartition(3)
    got = substrings.drop_repeated_passages(df, spans_col="spans")
    assert got.columns == ["doc_id", "text", "_doc", "__digests", "spans"] and got.count() == len(rows)
    kept = {(r.doc_id, (r.text or "")[:10]): r for r in got.collect()}
    texts = {}
    for r in kept.values():
        texts.setdefault(r.doc_id, []).append(r)
    before = {}
    for i, t in rows:
        before.setdefault(i, []).append(t)
    for i in (1, 4, 5, 6, 7, None, 8):
        assert sorted(r.text or "" for r in texts[i]) == sorted(t or "" for t in before[i])
    words = passage.split()
    for i in (2, 3):
        (r,) = texts[i]
        gone = sum(e - s for s, e in [tuple(x) for x in r.spans])
        assert gone >= 0.6 * len(passage) and " ".join(words[15:45]) not in r.text
        assert len(r.text) == len(before[i][0]) - gone
    assert substrings.drop_repeated_passages(none).count() == 0
    assert substrings.drop_repeated_passages(docs).count() == docs.count()


def test_substrings_need_one_document(spark):
    """Repeats that many documents hold, each a part, are no passage: neither single chunks nor pairs of neighbours."""
    array = lambda t: (np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
    clean = prose(300)
    bounds = substrings.chunks(*array(clean))[0].tolist()
    text, given = prose(150), []
    for at in range(len(bounds) - 4):  # some words around, so that the three chunks in the middle are cut alike
        given.append(prose(40) + " " + clean[bounds[at] : bounds[at + 4]] + prose(40))
    rows = [*enumerate(given), (1000, clean), (1001, text), (1002, prose(20) + " " + text + " " + prose(20))]
    held = {d for t in given for d in substrings.chunks(*array(t))[1].tolist()}
    assert sum(d in held for d in substrings.chunks(*array(clean))[1].tolist()) > 0.9 * (len(bounds) - 1)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in substrings.drop_repeated_passages(df).collect()}
    assert {i: t for i, t in got.items() if i < 1002} == {i: t for i, t in rows if i < 1002}
    assert len(got[1002]) < 0.4 * len(text)


def test_windows_cover_runs():
    """The windows inside any run of chunks with enough words cover all of it, and none crosses texts."""
    texts = [prose(120), "", " \n", prose(29), prose(31), "Is " * 100, "\n" + prose(70)]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    text, digest, first, end = substrings.windows(data, offsets, 30)
    assert all(offsets[t] <= a < b <= offsets[t + 1] and len(data[a:b].tobytes().split()) >= 30 for t, a, b in zip(text, first, end))
    assert set(text.tolist()) == {0, 4, 5, 6}
    bounds, _, held = substrings.chunks(data, offsets)
    for t in (0, 4, 5, 6):
        low, high = np.searchsorted(bounds, offsets[t : t + 2])
        for i in range(low, high):
            for j in range(i + 1, high + 1):
                if held[i:j].sum() >= 30:
                    inside = {b for a, e in zip(first, end) if bounds[i] <= a and e <= bounds[j] for b in range(a, e)}
                    assert len(inside) == bounds[j] - bounds[i]


def test_chunks_resist_shifts():
    text = prose(2000)
    array = lambda t: (np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
    a, b = (set(substrings.chunks(*array(t))[1].tolist()) for t in (text, text[:5000] + "inserted " + text[5000:]))
    assert len(a - b) <= 4 and len(a) > 300
    assert len(substrings.chunks(*array("Is " * 1000))[1]) <= 2


def plain_components(rows, n=5, percent=75):
    sets = []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append((i, {tuple(words[j : j + n]) for j in range(max(1, len(words) - n + 1))} if words else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if None in (sets[x][0], sets[y][0]):
                continue
            same_id = sets[x][0] == sets[y][0] and a and b
            if same_id or (a and b and 100 * len(a & b) >= percent * len(a | b)):
                root[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(least.get(find(x), i), i)
    return sorted(((i, len(s), least[find(x)] if i is not None else None) for x, (i, s) in enumerate(sets)), key=lambda r: ((r[0] is None, r[0]), repr(r)))


def variants(n, words, share, letters="abcdefgh"):
    base = prose(words, letters).split()
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(int(share * words)):
            own[RANDOM.randrange(words)] = prose(1)
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("group", [16, 3])
def test_jaccard(spark, docs, none, group):
    texts = [*variants(60, 150, 0.02), *variants(25, 40, 0.03), *variants(30, 12, 0.1), *variants(12, 700, 0.03), "a b c d e f", "A b\tc d e\nf", "one two", "one two", "two"]
    passage = prose(40)
    texts += [prose(RANDOM.randint(5, 60)) + " " + passage for _ in range(30)] + [passage]
    rows = list(enumerate(texts, 100)) + [(100, texts[0]), (None, texts[0]), (50, None), (51, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)).repartition(4)
    before, jaccard.GROUP = jaccard.GROUP, group
    try:
        assert by_key(jaccard.components(df)) == plain_components(rows)
    finally:
        jaccard.GROUP = before
    assert jaccard.components(none).count() == 0
    own = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert by_key(jaccard.components(docs)) == plain_components(own)


def test_no_link_through_rows_without_id(spark):
    base = prose(100).split()
    a, b = " ".join(base[:88]) + " " + prose(12), prose(12) + " " + " ".join(base[12:])
    rows = [(1, a), (2, b), (None, " ".join(base)), (3, prose(50))]
    got = by_key(jaccard.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)))
    assert got == plain_components(rows) and [r[2] for r in got] == [1, 2, 3, None]


def test_blocks_keep_the_sets_with_enough_shared_symbols():
    """Blocks, buckets and answers against plain counts of symbols."""
    random_, bands, buckets = np.random.default_rng(9), jaccard.Bands(), 32
    fresh = lambda n: np.unique(random_.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
    base = fresh(120)
    sets = [fresh(n) for n in (1, 3, 40, 300)] + [np.unique(np.concatenate([base[k:], fresh(k)])) for k in (0, 2, 5)] + [base[:3], np.concatenate([base[:3], fresh(90)])]
    blocks = [jaccard.Block() for _ in range(3)]
    for i, own in enumerate(sets):
        own.sort()
        blocks[i % 3].add(i, own, bands, buckets)
    blocks.append(blocks[0])  # a block that two tasks have alike
    sent = [m for b in blocks for m in b.messages(buckets)]
    through = [m for m in sent if m[1] != jaccard.ASK]
    for bucket in {m[2] for m in sent}:
        asked = [m for m in sent if m[1] == jaccard.ASK and m[2] == bucket]
        through += jaccard.answers(asked) if asked else []
    got = set()
    for block in {m[0] for m in through}:
        got |= set(zip(*(c.tolist() for c in jaccard.staying([m for m in through if m[0] == block], buckets))))
    spread = [(i, len(own), jaccard.short(s, buckets).view(np.int64).tolist(), sure) for i, own in enumerate(sets) for s, sure in bands.symbols(own)]
    holders: dict = {}
    for i, _, symbols, _ in spread:
        for s in symbols:
            holders.setdefault(s, []).append(i + 1)
    twice = {s for s, own in holders.items() if len(own) > 1 or (own[0] - 1) % 3 == 0}  # the doubled block counts twice
    expected = set()
    for i, size, symbols, sure in spread:
        shared = [s for s in symbols if s in twice]
        if len(shared) >= sure:
            expected |= {(i, size, s) for s in shared}
    assert got == expected and {4, 5, 6} <= {i for i, _, _ in got}


def test_sorted_values_come_back():
    values = np.sort(np.random.default_rng(3).integers(0, 1 << 32, 5000).astype(np.uint32))
    assert (jaccard.unpacked_sorted(jaccard.packed_sorted(values)) == values).all()


def test_symbols_lose_no_link():
    """Linked sets of any sizes share a symbol, and as many as the bound says."""
    random_, bands = np.random.default_rng(5), jaccard.Bands()
    for size in [3, 4, 5, 6, 7, 9, 12, 17, 25, 40, 64, 90, 130, 200, 333, 600, 1500] * 12:
        a = np.unique(random_.integers(0, 1 << 63, size).astype(np.uint64))
        common = int(random_.integers(int(0.75 * len(a)), len(a) + 1))
        most = int(common / 0.75) - len(a) + common  # |a| + |b| - common <= common / 0.75
        b = np.unique(np.concatenate([a[:0], random_.choice(a, common, replace=False), random_.integers(0, 1 << 63, max(0, random_.integers(0, max(1, most - common + 1)))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both) or (len(a) == len(b) == both):
            continue
        one, two = (np.concatenate([s for s, _ in bands.symbols(x)]) for x in (a, b))
        sure = min([n for x in (a, b) for _, n in bands.symbols(x)])
        assert len(np.intersect1d(one, two)) >= max(1, sure)
        words = [np.frombuffer(jaccard.bit_sketch(x), np.uint64)[None] for x in (a, b)]
        fold = min(w.shape[1] for w in words)
        assert np.bitwise_count(jaccard.folded(words[0], fold) ^ jaccard.folded(words[1], fold)).sum() <= len(a) + len(b) - 2 * both


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (105, 101), (200, 200), (300, 7)]
    got = dict(map(tuple, connected(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 300: 0, 100: 100, 101: 100, 105: 100}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_urls(spark):
    given = [
        ("http://EN.example.org/es/1?x", "en.example.org", "/es/1", "example.org/es/", "block"),
        ("https://example.org/en/17#t", "example.org", "/en/17", "example.org/en/1", "block"),
        ("https://example.org/en/27", "example.org", "/en/27", "org/", "allow"),
        ("x://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://a.com/fr/", "a.com", "/fr/", "com/fr/", "allow"),
        ("http://a.com/de/9://z", "a.com", "/de/9://z", "com/de/", "block"),
        ("http://org?/", "org", "", None, None), ("http://a.org", "a.org", "", None, None), ("no scheme", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
    ]
    many = [(f"http://h{i}.com/{'fr' if i % 2 else 'de'}/{i}",) for i in range(300)]
    rows = [(i, g[0]) for i, g in enumerate(given)] + [(100 + i, m[0]) for i, m in enumerate(many)] + [(1000 + i, f"http://s{i}.net/{'fr' if i % 2 else 'de'}/{i}") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("score", F.lit(1)).repartition(3)
    got = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(given):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict or (verdict is None and got[i].verdict in ("allow", "block"))
    right = [got[1000 + i].verdict == ("allow" if i % 2 else "block") for i in range(200)]
    assert sum(right) > 190
    assert url_filter.judge_urls(pages.filter("page_id < 0")).count() == 0
    alone = url_filter.judge_urls(pages.filter("page_id >= 1000")).collect()
    assert {r.verdict for r in alone} == {"allow"}


def test_url_model():
    """Scores against a model of dictionaries."""
    urls = ["http://a.org/x1", "", "É~{", "zz" * 40]
    kinds = np.array([1, 1, 0, 0])
    data, offsets = url_filter.strings(pa.array(urls))
    text, cell, lengths = url_filter.cells(data, offsets)
    counts = np.zeros((2, url_filter.STARTS[-1]))
    for order in range(url_filter.ORDER):
        np.add.at(counts, (kinds[text], cell[order]), 1)
    got = url_filter.Models(counts).scores(data, offsets)
    seen = [{}, {}]
    series = [[0] * url_filter.ORDER + [int(url_filter.CLASS[b]) for b in u.encode()] + [0] for u in urls]
    for u, kind in zip(series, kinds):
        for i in range(url_filter.ORDER, len(u)):
            for order in range(url_filter.ORDER):
                at = seen[kind].setdefault(tuple(u[i - order : i]), {})
                at[u[i]] = at.get(u[i], 0) + 1
    for u, score in zip(series, got):
        total = 0.0
        for i in range(url_filter.ORDER, len(u)):
            for kind, sign in ((1, 1), (0, -1)):
                p = 1 / url_filter.SYMBOLS
                for order in range(url_filter.ORDER):
                    at = seen[kind].get(tuple(u[i - order : i]))
                    if at:
                        p = (at.get(u[i], 0) + len(at) * p) / (sum(at.values()) + len(at))
                total += sign * np.log(p)
        assert abs(total / (len(u) - url_filter.ORDER) - score) < 1e-6


def test_url_counts_are_exact(spark):
    """Scores of more contexts than ``Models`` has rows, against dictionaries of all of them; repeated rows count."""
    letters = "abcdefghijklmnopqrstuvwxyz0123456789-_"
    word = lambda: "".join(RANDOM.choice(letters) for _ in range(24))
    urls = [f"http://{word()}.{'net' if i % 9 == 0 else 'com'}/{'fr' if i % 2 else 'de'}/{word()}" for i in range(1500)]
    urls += urls[:40] + ["http://É.net/~{"] * 2
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    held = {r.url for r in pages.filter(F.pmod(F.xxhash64("url"), F.lit(url_filter.HELD)) == 0).collect()}
    got = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    series = lambda u: [0] * url_filter.ORDER + [int(url_filter.CLASS[b]) for b in u.encode()] + [0]
    seen = [{}, {}]
    for i, u in enumerate(urls):
        if got[i].rule and u not in held:
            u = series(u)
            for at in range(url_filter.ORDER, len(u)):
                for order in range(url_filter.ORDER):
                    own = seen[got[i].verdict == "allow"].setdefault(tuple(u[at - order : at]), {})
                    own[u[at]] = own.get(u[at], 0) + 1
    assert min(sum(len(c) == 4 for c in own) for own in seen) > url_filter.CONTEXTS
    free = [i for i in got if not got[i].rule]
    assert len(got) == len(urls) and len(free) > 150 and all(got[i].score is None for i in got if got[i].rule)
    for i in free:
        u, total = series(urls[i]), 0.0
        for at in range(url_filter.ORDER, len(u)):
            for kind, sign in ((1, 1), (0, -1)):
                p = 1 / url_filter.SYMBOLS
                for order in range(url_filter.ORDER):
                    own = seen[kind].get(tuple(u[at - order : at]))
                    if own:
                        p = (own.get(u[at], 0) + len(own) * p) / (sum(own.values()) + len(own))
                total += sign * np.log(p)
        assert abs(total / (len(u) - url_filter.ORDER) - got[i].score) < 1e-6


def test_toxicity(spark, docs, none):
    bad = ["moronic", "trashing", "idiots", "losers"]
    rows = []
    for i in range(1500):
        words = prose(60).split()
        toxic = i % 8 == 0
        if toxic:
            words[5], words[30] = RANDOM.choice(bad), RANDOM.choice(bad)
        rows.append((i, " ".join(words), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    labels = df.select("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("toxic")).alias("toxic"))
    model = toxicity.learned(df.drop("toxic"), labels)
    got = {r.doc_id: r for r in toxicity.score_documents(df.drop("toxic"), model).collect()}
    held = [(r.predicted, t) for i, _, t in rows if (r := got[i]).held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got) and len(held) > 400
    assert sum(p == t for p, t in held) > 0.97 * len(held) and sum(p for p, t in held if t) > 0.85 * sum(t for _, t in held)
    plain = dict(zip(got, model.scores((dict((i, t) for i, t, _ in rows)[k] for k in got), {})))
    assert all(abs(plain[i] - got[i].score) < 1e-12 for i in got)
    odd = toxicity.score_documents(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd) and len({r.score for r in odd if r.doc_id in (0, 1, 2)}) == 1
    assert toxicity.score_documents(none, model).count() == 0
    blank = toxicity.learned(none, labels.filter("doc_id < 0"))
    assert all(r.predicted == 0 for r in toxicity.score_documents(docs, blank).collect())


def test_toxicity_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "fit", lambda positive, unlabelled, prior: (len(positive), len(unlabelled)))
    docs = spark.range(14_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    assert toxicity.learned(docs, docs.select("doc_id", F.lit(1).alias("toxic"))) == (3000, 6000)


def test_toxicity_takes_one_text_of_an_id(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "fit", lambda positive, unlabelled, prior: (len(positive), len(unlabelled)))
    docs = spark.range(900).select(F.least("id", F.lit(20)).alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    inside = docs.filter(toxicity.in_training()).select("doc_id").distinct()
    assert inside.filter("doc_id = 20").count() == 1
    assert toxicity.learned(docs, docs.select("doc_id", F.lit(1).alias("toxic"))) == (inside.count(),) * 2


def test_risk_step_needs_no_negatives():
    random_ = np.random.default_rng(2)
    rows = lambda n, toxic: [toxicity.text_features(prose(30) + (" awful nasty" if toxic(i) else "")) for i in range(n)]
    model = toxicity.fit(rows(200, lambda i: True), rows(600, lambda i: i % 5 == 0), 0.2)
    scores = list(model.scores([prose(30) + " awful nasty", prose(30), None], {}))
    assert scores[0] > 0.7 > max(scores[1:]) and random_ is not None
