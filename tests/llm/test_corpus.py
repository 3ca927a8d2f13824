"""The corpus operators against plain Python, with nulls, empty and repeated rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioflow.llm import bpe, digest, jaccard, katz, lines, phrases, pii, simhash, suffixes, toxicity, warc

RNG = random.Random(11)
WORDS = ["alpha", "Beta", "gamma,", "delta", "éta", "zêta.", "漢字", "x1", "9", "the", "of", "and"]


def sentence(n):
    return " ".join(RNG.choice(WORDS) + RNG.choice(["", "s", "ing"]) for _ in range(n))


BASE = [sentence(RNG.randint(5, 80)) for _ in range(12)]
TEXTS = [*BASE, BASE[0], BASE[1] + " more", BASE[2][5:] + BASE[3], None, "", " \n\t", "a\x00b" * 30, "é" * 60, BASE[4] + "\n" + BASE[5]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{i % 2}", "en", 1) for i, t in enumerate(TEXTS)] + [(None, BASE[6], None, "en", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").repartition(3).cache()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_suffix_arrays():
    for t in range(120):
        x = bytes(RNG.choice(b"a\x00\xff") for _ in range(RNG.randint(0, 50))) if t % 2 else b"abcab" * RNG.randint(0, 15)
        a = np.frombuffer(x, np.uint8)
        sa = suffixes.suffix_array(a)
        assert sa.tolist() == sorted(range(len(x)), key=lambda i: x[i:])
        lcp = suffixes.common_prefixes(a, sa).tolist()
        for r in range(1, len(x)):
            p, q = x[sa[r - 1] :], x[sa[r] :]
            assert lcp[r] == next((i for i, (m, n) in enumerate(zip(p, q, strict=False)) if m != n), min(len(p), len(q)))


@pytest.mark.parametrize("hot", [50_000, 1])
def test_suffix_dedup(docs, hot, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", hot)
    got, seen = by_id(suffixes.dedup(docs)), {}
    for i, t in [*enumerate(TEXTS), (None, BASE[6])]:
        x = (t or "").encode()
        gone = bytearray(len(x))
        for k in range(len(x) - 49):
            if seen.setdefault(x[k : k + 50], i) != i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(x, gone, strict=True) if not g)
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(x), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())


def test_minimizers_of_long_texts(monkeypatch):
    rng = np.random.default_rng(3)
    passage = rng.integers(97, 123, 400).astype(np.uint8)
    long = np.concatenate([passage, rng.integers(97, 123, 1 << 24).astype(np.uint8), passage, np.array([255], np.uint8)])
    place, first, count = suffixes.minimizers(long, np.array([len(long) - 1]))
    assert (np.diff(place) > 0).all() and ((place >= first + count - 1) & (place <= first + 24)).all()
    at = len(long) - 401
    head, tail = place[place + 50 < 400], place[(place >= at) & (place + 50 < at + 400)] - at
    assert set(head[head > 50]) == set(tail[tail > 50]) and len(head) > 10  # by content alone
    some = np.concatenate([long[:3000], [255], long[:20], [255], long[-900:]]).astype(np.uint8)
    want = [x.tolist() for x in suffixes.minimizers(some, np.array([3000, 20, 899]))]
    for piece in (50, 51, 120, 1000):
        monkeypatch.setattr(suffixes, "PIECE", piece)
        assert [x.tolist() for x in suffixes.minimizers(some, np.array([3000, 20, 899]))] == want


def test_many_buckets_rise_with_the_hash():
    c = suffixes.Chunk.__new__(suffixes.Chunk)
    c.uniq = np.unique(np.random.default_rng(4).integers(0, 1 << 52, 20_000, dtype=np.uint64))
    for n in (12, 4096, 4097, 60_000, 5_000_000):
        got = c.buckets(n)
        assert (np.diff(got) >= 0).all() and got[0] >= 0 and got[-1] == n * int(c.uniq[-1] >> 20) >> 32 < n
        ks = [k for k, _ in suffixes.slices(got)]
        assert len(ks) == len(set(ks))


def test_katz_normalises_and_matches(docs):
    got = by_id(katz.score(docs))
    tok = {i: (t or "").encode().lower().split() + [b"\n"] for i, t in [*enumerate(TEXTS), (None, BASE[6])]}
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i in tok}
    c, bg = Counter(), Counter()
    for i, w in tok.items():
        if not held[i]:
            c.update(w)
            bg.update(zip([b""] + w[:-1], w, strict=True))
    n, v = sum(c.values()), len(c)
    d1, d2 = katz.discounts(Counter(c.values())), katz.discounts(Counter(bg.values()))
    p1 = {w: d1[min(r, 6)] * r / n for w, r in c.items()}
    unknown, after = 1 - sum(p1.values()), defaultdict(dict)
    for (h, w), r in bg.items():
        after[h][w] = r

    def p(w, h):
        if h not in after:
            return p1.get(w, unknown)
        total, mass = sum(after[h].values()), sum(d2[min(r, 6)] * r for r in after[h].values())
        total += total - mass < 1e-9 * total
        if w in after[h]:
            return d2[min(after[h][w], 6)] * after[h][w] / total
        return (1 - mass / total) / (1 - sum(p1[x] for x in after[h])) * p1.get(w, unknown)

    for h in [*after, b"?"]:
        assert abs(sum(p(w, h) for w in [*c, b"never seen"]) - 1) < 1e-9
    for i, w in tok.items():
        r = got[i]
        want = sum(math.log10(p(x, h)) for h, x in zip([b""] + w[:-1], w, strict=True))
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(w), sum(x in c for x in w), n)
        assert abs(r["score"] - want) < 1e-6 and abs(r["base_score"] - base) < 1e-6


def test_katz_hot_histories(docs, monkeypatch):
    want = {i: r["score"] for i, r in by_id(katz.score(docs)).items()}
    monkeypatch.setattr(katz.Model, "hot", property(lambda m: 3))
    monkeypatch.setattr(katz, "CHUNK_BYTES", 200)
    got = by_id(katz.score(docs))
    assert all(abs(got[i]["score"] - s) < 1e-6 for i, s in want.items())


def test_line_dedup(spark):
    rows = [(i, f"head\nbody {i}\n\nhead " if i % 2 else f"only {i}", "a") for i in range(40)] + [(100, None, None), (101, "head", "b")]
    got = by_id(lines.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"), counts=True))
    assert got[1]["text"] == "body 1\n" and got[1]["n_dropped"] == 2 and got[0]["n_dropped"] == 0
    assert got[100]["text"] is None and got[101]["text"] == "head"


def test_bpe_round_trip():
    import public_tokenizers
    import tiktoken

    e = bpe.encoder()
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=e.transducer.ranks, special_tokens={})
    alphabets = ["abcdefghij etaoin", " \t\n\x1c\x85　\xa0", "éèüß漢字русский", "0123.,!?-'s", "😀👨‍́"]
    for t in [*[x for x in TEXTS if x], *("".join(RNG.choice(RNG.choice(alphabets)) for _ in range(RNG.randint(0, 40))) for _ in range(4000)), "a" * 5000]:
        ids = e.encode(t)
        assert ids == plain.encode_ordinary(t)
        d = bpe.StreamDecoder(e.transducer.bytes_of)
        assert "".join(d.feed([i]) for i in ids) + d.close() == t


def test_utf8_machine():
    for data in [bytes(RNG.randrange(256) for _ in range(30)) for _ in range(500)]:
        m, cut = bpe.Utf8Machine(), RNG.randrange(31)
        assert m.feed(data[:cut]) + m.feed(data[cut:]) + m.close() == data.decode("utf-8", "replace")


def test_simhash_groups(spark):
    fps = [RNG.getrandbits(64) for _ in range(30)]
    fps += [f ^ sum(1 << b for b in RNG.sample(range(64), RNG.randint(0, 4))) for f in fps * 3]
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    rows = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "doc_id long, fp long")
    want = {i: find(i) for i in range(len(fps))}
    for bucket in (4096, 3):  # the second cuts buckets further and compares in blocks
        kept = simhash.links.__defaults__
        simhash.links.__defaults__ = (bucket,)
        try:
            assert {r["doc_id"]: r["component_id"] for r in simhash.groups(rows).collect()} == want
        finally:
            simhash.links.__defaults__ = kept


@pytest.mark.parametrize("wide", [8, 0])
def test_near_duplicates_of_the_pipeline(spark, wide, monkeypatch):
    monkeypatch.setattr(jaccard, "WIDE", wide)  # 0: by leaders first
    monkeypatch.setattr(jaccard, "SAMPLED", 2)
    rng, texts = random.Random(5), [None, "", " ", "one", "One"]
    passage = " ".join(f"p{i}" for i in range(20))
    for base in range(12):
        ws = [f"w{rng.randrange(40)}" for _ in range(rng.randint(4, 150))]
        for _ in range(8):
            new = list(ws)
            for _ in range(rng.randint(0, 6)):
                new[rng.randrange(len(new))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(new) + (f" {passage}" if base % 3 == 0 else ""))
    sets = [set((w := (t or "").lower().split()) and [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))]) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    rows = spark.createDataFrame([(i, t, "s", "en", 1) for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string, n_chars long").repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, rows, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({find(i) for i in range(len(texts))})


def test_fingerprints_of_odd_texts(docs):
    got = by_id(simhash.fingerprints(docs))
    assert got[len(BASE) + 3]["fp"] == got[len(BASE) + 4]["fp"] == 0
    assert got[0]["fp"] == got[len(BASE)]["fp"]


def test_warc(spark, tmp_path):
    big = "<p>" + "x" * 200
    rows = [(1, "http://a/1", big), (2, None, big), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (6, "u", "é" * 70)] + [(i, "u", f"page {i} " * 40) for i in range(10, 40)]
    archives = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"))
    warc.save(archives, str(tmp_path / "w")).collect()
    back = {r["page"]: r for r in warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path / "w")), payloads=True).collect()}
    assert len(back) == len(rows) and back["2"]["record_type"] == "revisit" and back["2"]["refers_to"] == "1" and back["5"]["record_type"] == "response"
    for page, _, html in rows:
        data, r = (html or "").encode(), back[str(page)]
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == hashlib.sha256(data).hexdigest()
        assert r["record_type"] == "revisit" or bytes(r["payload"]) == data


def test_broken_archives():
    good = warc.pack([warc.write_record(str(i), "u", b"p" * 150, hashlib.sha256(b"p" * 150).hexdigest(), None) for i in range(3)])
    assert len(list(warc.unpack(good))) == 3
    for bad in (b"", good[:6], good[:-3], b"x" + good[1:], good + b"tail"):
        with pytest.raises(warc.BrokenArchive):
            list(warc.unpack(bad))
    with pytest.raises(warc.BrokenArchive):
        warc.parse_record(b"WARC/1.1\r\nWARC-Type: response\r\n\r\n")


def test_contamination(spark, docs):
    items = [(1, " ".join(BASE[0].split()[:14])), (2, "éta"), (None, ""), (3, None), (10, BASE[7])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    low = lambda t: find(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for i, t in items:
        w = low(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add(str(i))
    results = [by_id(phrases.contamination(docs, bench))]
    phrases.BLOCK_WORDS, kept = 1, phrases.BLOCK_WORDS  # a block for every item
    try:
        results.append(by_id(phrases.contamination(docs.filter("doc_id IS NOT NULL"), bench)))
    finally:
        phrases.BLOCK_WORDS = kept
    for got in results:
        for i, t in enumerate(TEXTS):
            w, hit, own = low(t), set(), set()
            for q, of in windows.items():
                for k in range(len(w) - len(q) + 1):
                    if tuple(w[k : k + len(q)]) == q:
                        hit |= set(range(k, k + len(q)))
                        own |= of
            r = got[i]
            assert (r["n_words"], r["n_hit"], r["items"]) == (len(w), len(hit), sorted(own))


def test_contaminated_documents_go_with_blocks(spark, docs, tmp_path, monkeypatch):
    spark.createDataFrame([(1, BASE[0]), (2, BASE[8]), (3, "never said")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = sorted(str(r) for r in corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect())
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 1)  # a block for every item
    assert 0 < len(want) < docs.count()
    assert sorted(str(r) for r in corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()) == want
    own = docs.withColumn("_number", F.lit(1))  # a column of the caller's
    assert "_number" in own.columns and phrases.contamination(own, spark.read.parquet(f"{tmp_path}/benchmark.parquet")).count() == docs.count()


def test_toxicity(spark):
    rows = [(i, sentence(30) + (f" {RNG.choice(['vile', 'scummy'])} {RNG.choice(['vile', 'scummy', 'rotten'])}" if i % 5 == 0 else "")) for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = by_id(toxicity.score(d, toxicity.fit(d, labels)))
    assert all(got[i]["toxic"] == (i % 5 == 0) for i in range(200, 300))
    none = toxicity.score(d, toxicity.fit(d, labels.filter("toxic = 0")))
    assert not none.filter("toxic").count()


def test_pii(spark):
    texts = ["mail a.b@c.d.com, 1.2.3.4 and 999.1.1.1 or 4539 1488 0343 6467", "+1 (988) 555-2485 x+33 1", None, "a" * 3000, "é a@b.c_x@y.z 1" + " 1" * 3000, "0" * 5000, "call 555-123-4567 or jo [at] mail [dot] com"]
    base = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(digits):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0

    got = by_id(pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for i, t in enumerate(texts):
        want = []
        for kind, pattern in base.items():
            for m in re.finditer(pattern, t or ""):
                n = re.sub("[^0-9]", "", m[0])
                if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(n) <= 19 and luhn(n), "phone": 9 <= len(n) <= 15}[kind]:
                    want.append((kind, m.start(), m.end()))
        assert [(x["kind"], x["s"], x["e"]) for x in got[i]["spans"] if x["base"]] == want


def test_em_prefers_agreeing_labelers():
    counts = [(("email", (1, 1, 1, 1, 1)), 50), (("email", (0, -1, -1, -1, -1)), 50), (("email", (1, 1, 0, 1, 1)), 20)]
    post, _ = pii.reliabilities(counts)
    assert post[counts[0][0]] > 0.9 and post[counts[1][0]] < 0.1


def test_digests(spark, docs):
    same = spark.createDataFrame([(1, "É  x\n"), (2, "é X"), (3, None), (4, " "), (5, "ﬁn"), (6, "FIN"), (6, "FIN")], "doc_id long, text string")
    groups = [(r["doc_id"], r["group_id"], r["group_size"]) for r in digest.duplicate_groups(same).collect()]
    assert sorted(groups) == [(1, 1, 2), (2, 1, 2), (3, 3, 2), (4, 3, 2), (5, 5, 3), (6, 5, 3), (6, 5, 3)]


def test_next_document(spark, monkeypatch):
    monkeypatch.setattr(digest, "RANGE_ROWS", 3)
    rows = [(i * 7, f"t{i}") for i in range(20)] + [(None, "n")]
    got = {r["doc_id"]: r["next_text"] for r in digest.with_next(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", ["text"]).collect()}
    assert got[133] == "t18" and got[0] == "n" and got[None] == "t19" and len(got) == 21


def test_empty_tables(spark, docs):
    none = docs.filter("doc_id < 0")
    labels, bench = spark.createDataFrame([], "doc_id long, toxic int"), spark.createDataFrame([], "item_id long, text string")
    for df in (suffixes.dedup(none), katz.score(none), lines.drop_boilerplate(none), bpe.encode_documents(none), simhash.groups(simhash.fingerprints(none)), phrases.contamination(none, bench), toxicity.score(none, toxicity.fit(none, labels)), pii.find(none), digest.with_next(none, "doc_id", ["text"])):
        assert df.count() == 0


def test_pipeline_stages_keep_columns(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, BASE[8])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        now = now.cache()
    kept = {r["doc_id"] for r in now.collect()}
    assert 8 not in kept and len(BASE) not in kept and 0 in kept
    assert now.select(F.count("*")).first()[0] == corpus_pipeline.run(spark, str(tmp_path)).count()
