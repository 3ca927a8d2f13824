"""Whole queries against plain Python, and operators on odd tables: clashing columns, large ids beside null, long texts."""

import hashlib
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from folioflow.llm import bpe, digest, katz, lines, phrases, pii, queries, simhash, suffixes, toxicity, warc

RNG = random.Random(23)
WORDS = ["Alpha", "beta", "gamma,", "delta", "ÉVIL", "straße", "漢字", "x1", "the", "of", "and", "we"]
LARGE = [(1 << 60) + 1, None, (1 << 60) + 3]


def sentence(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


SENTENCES = [sentence(RNG.randint(1, 60)) for _ in range(14)]
LONG = " ".join(f"w{i % 7919}x{i % 13}" for i in range(40_000))
TEXTS = [*SENTENCES, SENTENCES[0].upper(), SENTENCES[1] + " ", SENTENCES[2] + "\n" + SENTENCES[3], None, "", " ", LONG, LONG[:200_000], "mail a@b.co +1 555 123 4567\n1.2.3.4"]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    docs = spark.createDataFrame([(i * 3, t, "en", f"s{i % 3}", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{d}/documents.parquet")
    items = [("b1", " ".join(SENTENCES[4].split()[:14])), ("b2", SENTENCES[5]), ("b1", "the"), (None, "")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{d}/benchmark.parquet")
    labels = spark.createDataFrame([(i * 3, 1, i % 2) for i in range(10)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{d}/labels.parquet")
    return str(d), items


def got(spark, sf, name):
    rows = queries.QUERIES[name](spark, sf[0]).collect()
    assert len(rows) == len(TEXTS)
    return {r["doc_id"] // 3: r for r in rows}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_op4_query(spark, sf):
    import public_tokenizers
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, r in got(spark, sf, "op4_bpe").items():
        ids = plain.encode_ordinary(TEXTS[i] or "")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(TEXTS[i] or ""))


def test_bpe_forgets_and_stays_right(monkeypatch):
    e = bpe.Encoder(bpe.encoder().transducer.ranks, __import__("public_tokenizers").PATTERN)
    texts = [t for t in TEXTS if t]
    want = [e.packed(t) for t in texts]
    monkeypatch.setattr(bpe, "MAX_BYTES", 3000)
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    small = bpe.Encoder(e.transducer.ranks, __import__("public_tokenizers").PATTERN)
    assert [small.packed(t) for t in texts] == want and len(small) < 40 and len(small.transducer.states) < 5000


def test_op5_query(spark, sf):
    prints = {}
    for i, t in enumerate(TEXTS):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode().split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2) if w else 0)]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    parent = list(range(len(TEXTS)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in prints:
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    for i, r in got(spark, sf, "op5_simhash").items():
        assert (r["fingerprint"], r["component_id"]) == (f"{prints[i]:016x}", 3 * find(i))


def test_op7_query(spark, sf):
    low = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = [(i or "", tuple(w[k : k + 13])) for i, t in sf[1] for w in [low(t)] for k in range(max(1, len(w) - 12) if w else 0)]
    for i, r in got(spark, sf, "op7_decontamination").items():
        w, hit, items = low(TEXTS[i]), set(), set()
        for item, q in windows if len(w) < 1000 else []:
            for k in range(len(w) - len(q) + 1):
                if tuple(w[k : k + len(q)]) == q:
                    hit |= set(range(k, k + len(q)))
                    items.add(item)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (len(w), len(hit), len(items), sha(",".join(sorted(items))))
        assert r["contaminated"] == (bool(hit) and 20 * len(hit) >= len(w))


@pytest.mark.parametrize("slop", [None, 0, 2, 6])
def test_phrase_and_proximity_search(spark, slop, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_CHARS", 300)
    texts = [" ".join(RNG.choice("abcdef") for _ in range(RNG.randint(0, 30))) for _ in range(25)]
    items = [("p", "a b"), ("q", "c d e"), ("r", "a z"), ("s", "f"), ("t", "b a b")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = Counter((r["doc_id"], r["item"], r["position"]) for r in phrases.search(docs, bench, slop=slop).collect())
    want, shard, shards = Counter(), [], []
    for i, t in enumerate(texts):  # the same shards: a new one once this one holds SHARD_CHARS
        shard.append(i)
        if sum(len(texts[j]) + 8 for j in shard) >= 300:
            shards.append(shard)
            shard = []
    for own in [*shards, shard]:
        for item, q in items:
            q = q.split()
            counts = Counter(w for i in own for w in texts[i].split())
            rare = min(dict.fromkeys(q), key=lambda w: counts[w])
            for i in own:
                w = texts[i].split()
                for k in range(len(w)):
                    if slop is None:
                        want[i, item, k] += w[k : k + len(q)] == q
                    elif w[k] == rare:
                        want[i, item, k] += all(x in w[max(0, k - slop) : k + slop + 1] for x in q)
    assert found == +want


def canonical(t):
    nfkc = lambda x: unicodedata.normalize("NFKC", x)
    return re.sub(r"\s+", " ", nfkc(nfkc(t or "").casefold())).strip()


@pytest.mark.parametrize("rows", [2000, 4])
def test_op10_query(spark, sf, rows, monkeypatch):
    monkeypatch.setattr(digest, "RANGE_ROWS", rows)
    texts = [t or "" for t in TEXTS]
    all_rows = got(spark, sf, "op10_fingerprints")
    same = Counter(map(canonical, texts))
    for i, r in all_rows.items():
        t, after = texts[i], texts[i - 1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), sha(edited))
        assert r["near_edited"] == float(canonical(t) == canonical(edited)) and r["near_next"] == float(canonical(t) == canonical(after))
        assert (r["fingerprint"] == r["edited_fingerprint"]) == bool(r["near_edited"])
        assert r["group_size"] == same[canonical(t)] and r["group_id"] == 3 * [canonical(x) for x in texts].index(canonical(t))
    assert len({r["fingerprint"] for r in all_rows.values()}) == len(same)


def test_next_by_text_keys(spark, monkeypatch):
    monkeypatch.setattr(digest, "RANGE_ROWS", 2)
    keys = [f"k{i:03}é" for i in range(23)]
    rows = spark.createDataFrame([(k, f"t{k}", "x", 1) for k in keys], "doc_id string, text string, _range string, next_text int").repartition(3)
    out = digest.with_next(rows, "doc_id", ["text"])
    assert out.columns == ["doc_id", "text", "_range", "next_text", "_next_text"]
    assert {r["doc_id"]: r["_next_text"] for r in out.collect()} == {k: f"t{keys[i - 1]}" for i, k in enumerate(keys)}


def test_hash_collisions_dont_join_texts(spark, monkeypatch):
    monkeypatch.setattr(digest, "wide_hash", lambda c: F.substring(c, 1, 1))
    rows = spark.createDataFrame([(1, "ab"), (2, "ac"), (3, "AB"), (4, "x")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["group_id"], r["group_size"]) for r in digest.duplicate_groups(rows).collect()) == [(1, 1, 2), (2, 2, 1), (3, 1, 2), (4, 4, 1)]


def test_large_ids_beside_null(spark):
    rows = spark.createDataFrame([(k, f"{sentence(30)} {k}") for k in LARGE], "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(1, "the")], "item_id long, text string")
    for out in (katz.score(rows), suffixes.dedup(rows), bpe.encode_documents(rows), phrases.contamination(rows, bench), simhash.groups(simhash.fingerprints(rows))):
        assert {r["doc_id"] for r in out.collect()} == set(LARGE)
    ends = spark.createDataFrame([((1 << 63) - 1, "x"), (-(1 << 63), "y"), (None, "z")], "doc_id long, text string")
    assert {r["doc_id"] for r in suffixes.dedup(ends).collect()} == {(1 << 63) - 1, -(1 << 63), None}
    with pytest.raises(TypeError):
        suffixes.dedup(spark.createDataFrame([("a", "x")], "doc_id string, text string"))
    texts = spark.createDataFrame([("a", "x y"), (None, "x")], "doc_id string, text string")
    for out in (katz.score(texts), bpe.encode_documents(texts), phrases.contamination(texts, bench)):
        assert {r["doc_id"] for r in out.collect()} == {"a", None}


#: Names that operators use inside, and those of their results.
CLASHES = ["_key", "_keys", "_host", "_text", "_scored", "severity", "n_lines", "n_dropped", "_t", "_f0", "_m0", "_s0", "_a0", "spans", "_row", "_number", "_salt", "_range", "_to", "h", "k", "u", "v", "fp", "root", "chunk", "bucket", "items", "words"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, (TEXTS[i] or "")[:500] if i % 5 else None, f"s{i % 2}", "en", 1, *[f"{c}{i}" for c in CLASHES]) for i in range(12)]
    schema = ", ".join(["doc_id long, text string, source string, lang string, n_chars long", *[f"`{c}` string" for c in CLASHES]])
    return spark.createDataFrame(rows, schema).repartition(2).cache()


def plain(df, columns):
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


def test_clashing_columns(spark, clashing, monkeypatch):
    own = ["doc_id", "text", "source", "lang", "n_chars"]
    bare = clashing.select(*own).cache()
    labels, bench = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"), spark.createDataFrame([(1, "the")], "item_id long, text string")
    model = toxicity.fit(clashing, labels)
    ways = {
        "katz": katz.score, "suffixes": suffixes.dedup, "bpe": bpe.encode_documents, "simhash": lambda d: simhash.groups(simhash.fingerprints(d)),
        "phrases": lambda d: phrases.contamination(d, bench), "groups": digest.duplicate_groups,
    }
    for name, way in ways.items():
        a, b = way(clashing), way(bare)
        assert a.columns == b.columns and plain(a, a.columns) == plain(b, b.columns), name
    for broadcast in (100_000, -1):
        monkeypatch.setattr(lines, "BROADCAST_ROWS", broadcast)
        out = lines.drop_boilerplate(clashing, counts=True)
        assert out.columns == [*clashing.columns, "_n_lines", "_n_dropped"]
        assert plain(out, [*own, "_n_lines"]) == plain(lines.drop_boilerplate(bare, counts=True), [*own, "n_lines"])
        assert plain(out, ["doc_id", *CLASHES]) == plain(clashing, ["doc_id", *CLASHES])
    for out, more in ((toxicity.score(clashing, model), ["_severity", "severity_grade", "toxic"]), (digest.with_digest(clashing), ["fingerprint"])):
        assert out.columns == [*clashing.columns, *more] and plain(out, clashing.columns) == plain(clashing, clashing.columns)
    out = pii.find(clashing)
    assert out.columns == [*[c for c in clashing.columns if c != "text"], "_spans"]
    assert plain(out, ["doc_id", *CLASHES]) == plain(clashing, ["doc_id", *CLASHES])


def test_small_hosts_are_judged_by_the_ratio(spark):
    rows = [(i, f"menu\nbody {i}", "small") for i in range(4)] + [(10 + i, f"line {i}\n" + ("seen twice" if i < 2 else "x") + f" {i > 1 and i}", "large") for i in range(40)]
    out = {r["doc_id"]: r["text"] for r in lines.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[0] == "body 0" and out[10].startswith("line 0\nseen twice")  # 4 of 4 pages go, 2 of 40 stay
    alone = spark.createDataFrame([(1, "only page", "h")], "doc_id long, text string, source string")
    assert lines.drop_boilerplate(alone).first()["text"] == "only page"


def test_ordinal_fit_is_at_a_minimum():
    rng = np.random.default_rng(5)
    features = [tuple(np.flatnonzero(rng.random(6) < 0.4).tolist()) for _ in range(300)]
    z = np.array([sum((1.5, -1.0, 0.5, 2.0, 0.0, -0.5)[i] for i in f) for f in features]) + rng.logistic(size=300)
    grade = (z > 0.5).astype(int) + (z > 2.0)
    w, (t1, t2) = toxicity.fit_ordinal(features, grade, 6)

    def loss(w, t1, t2):
        s = np.array([sum(w[i] for i in f) for f in features])
        above = lambda t: 1 / (1 + np.exp(t - s))
        p = np.select([grade == 0, grade == 1], [1 - above(t1), above(t1) - above(t2)], above(t2))
        return -np.log(p).mean() + 0.5e-5 * (w**2).sum()

    best = loss(w, t1, t2)
    assert t1 < t2
    for _ in range(200):
        d = rng.normal(size=8) * 0.02
        assert loss(w + d[:6], t1 + d[6], t2 + d[7]) > best - 1e-7


def test_words_are_lowered_alike_in_fit_and_score(spark):
    rows = [(i, f"{sentence(20)} " + ("ÉVIL ÖDIOUS" if i % 4 == 0 else "")) for i in range(160)]
    docs = spark.createDataFrame([(i, t.replace(" ÉVIL ", " ").removeprefix("ÉVIL ") if i % 4 else t) for i, t in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)] * 2, "doc_id long, toxic int")
    out = {r["doc_id"]: r["toxic"] for r in toxicity.score(docs, toxicity.fit(docs.unionByName(docs), labels)).collect()}
    assert all(out[i] == (i % 4 == 0) for i in range(160))


def test_warc_ids(spark):
    big = "<p>" + "y" * 300
    rows = [("", "u", "short"), (None, "u", "other"), ("a", "u", big), (None, "u", big), ("", None, big)]
    back = sorted(((r["page"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read_archives(warc.write_archives(spark.createDataFrame(rows, "page_id string, url string, html string"))).collect()), key=str)
    assert back == sorted([("", 5, "response", None), (None, 5, "response", None), ("a", 303, "revisit", ""), (None, 303, "revisit", ""), ("", 303, "response", None)], key=str)


def test_loose_personal_data(spark):
    true = [
        "write to jo.doe [at] mail [dot] example [dot] com please", "contact: ann(at)site.org now", "server 10[.]0[.]0[.]7 is down", "host fe80:0:0:0:1:2:3:4 answered",
        "card 4539.1488.0343.6467 was used", "credit 5500_0000_0000_0004 ok", "call (212) 555-0187 today", "phone 020 7946 0958 for more", 'token = "592e2677e7e6567f917b8bfcceb4e5730d6f49ab"', "export api_key=sk-9f8e7d6c5b4a39281706",
    ]
    false = ["order 1234.5678.9012.3456 shipped", "invoice 2020-12-31 10-45 99", "version 123 456 789 01", "password = changeme", "isbn 978 316 148 410", "token: abcdefghijkl"]
    rows = [(i, f"{RNG.choice(['so', 'and then', 'we said'])} {t}") for i, t in enumerate((true + false) * 12)]
    base = [(10_000 + i, f"mail x{i}@y.com or +1 (212) 555-01{i:02} or 4539 1488 0343 6467 or 10.0.0.{i}") for i in range(60)]
    out = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows + base, "doc_id long, text string")).collect()}
    kept = Counter(i % 16 < len(true) for i in range(len(rows)) if any(not x["base"] for x in out[i]))
    recall, precision = kept[True] / (12 * len(true)), kept[True] / max(1, kept[True] + kept[False])
    print("loose spans", recall, precision)
    assert recall >= 0.9 and precision >= 0.9
    assert all([x["kind"] for x in out[k] if x["base"]] == ["email", "ip", "card", "phone"] for k, _ in base)


def test_op9_query(spark, sf):
    rows = got(spark, sf, "op9_pii")
    r = rows[len(TEXTS) - 1]
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 0, 1)
    assert r["base_sha256"] == sha("email:5:11,ip:28:35,phone:12:27") and r["spans"] == "email:5:11,ip:28:35,phone:12:27" and r["n_spans"] == 3
    assert all(x["base_sha256"] == sha("") for i, x in rows.items() if i < len(SENTENCES))


def test_long_texts_in_every_query(spark, sf):
    at = TEXTS.index(LONG)
    assert got(spark, sf, "op1_katz")[at]["n_tokens"] == 40_001
    assert got(spark, sf, "op2_suffix_dedup")[at + 1]["n_removed"] == 200_000
    assert got(spark, sf, "op3_line_dedup")[at]["n_lines"] == 1
    assert got(spark, sf, "op8_toxicity")[at]["severity"] >= 0


def test_pipeline_rows(spark, tmp_path):
    """run() against the five rules in plain Python; the severity model alone is taken from its operator."""
    import corpus_pipeline
    import public_tokenizers
    import tiktoken

    rng = random.Random(9)
    say = lambda n: " ".join(f"t{rng.randrange(400)}" for _ in range(n))
    bodies = [say(rng.randint(20, 90)) for _ in range(60)]
    bench = [("x1", say(20)), ("x2", say(7))]
    rows = []
    for i, body in enumerate(bodies):
        text = f"site menu {i % 3}\n{body}\n\nsite foot"
        if i % 6 == 0:
            text += f"\n{rng.choice(['vile scum', 'scum rot', 'vile rot'])}"
        if i % 9 == 1:
            text += f"\n{bench[i % 2][1]}"
        rows.append((i, text, f"s{i % 3}"))
    for i in range(60, 80):  # near copies on other sites
        words = rows[i - 60][1].split(" ")
        words[rng.randrange(5, len(words))] = "changed"
        rows.append((i, " ".join(words), f"z{i}"))
    rows += [(90, None, "s0"), (91, "", "s1"), (92, rows[3][1], "q1")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(54)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    model = toxicity.fit(docs, labels)
    assert model.words
    low = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))

    def severity(t):
        z = sum(model.words.get(w, 0.0) for w in set(low(t)))
        return sum(1 / (1 + np.exp(x - z)) for x in model.thresholds)

    now = {i: (t, s) for i, t, s in rows if severity(t or "") < toxicity.CUT}
    assert 0 < len(now) < len(rows)
    pages, total = Counter(), Counter(s for _, s in now.values())
    for t, s in now.values():
        pages.update({(s, x.strip(" ")) for x in (t or "").split("\n") if x.strip(" ")})
    bad = {k for k, n in pages.items() if n >= 2 and n > 0.1 * total[k[0]]}
    now = {i: None if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip(" ")) not in bad) for i, (t, s) in now.items()}
    sets = {i: {tuple(w[k : k + 5]) for w in [(t or "").lower().split()] for k in range(max(1, len(w) - 4) if w else 0)} for i, t in now.items()}
    group = {i: i for i in now}
    for _ in range(len(now)):
        for i in now:
            for j in now:
                if j < i and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                    group[i] = group[j] = min(group[i], group[j])
    now = {i: t for i, t in now.items() if group[i] == i}
    windows = {tuple(w[k : k + 13]) for _, t in bench for w in [low(t)] for k in range(max(1, len(w) - 12))}

    def contaminated(t):
        w, hit = low(t), set()
        for q in windows:
            for k in range(len(w) - len(q) + 1):
                if tuple(w[k : k + len(q)]) == q:
                    hit |= set(range(k, k + len(q)))
        return bool(hit) and 20 * len(hit) >= len(w)

    before = len(now)
    now = {i: t for i, t in now.items() if not contaminated(t or "")}
    assert len(now) < before
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.encoder().transducer.ranks, special_tokens={})
    want = {}
    for i, t in now.items():
        ids = plain.encode_ordinary(t or "")
        want[i] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t or ""))
    got_rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(got_rows) == len(want) and {r["doc_id"]: tuple(r)[1:] for r in got_rows} == want
