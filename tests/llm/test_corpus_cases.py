"""Nulls, repeated and null ids, ties, empty tables and clashing columns; stages against brute force."""

import collections
import hashlib
import itertools
import random
import re

import pytest

from rooftop.llm import bpe, common, exact, langid, near, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string"
BLANK = re.compile("[\x20\x09-\x0d]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", len(t or ""), "clash") for i, t in rows], DOCS).repartition(3)


def shingles(text):
    w = [x for x in BLANK.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(texts, percent):
    """Index of the first text that each text reaches by links."""
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return [find(x) for x in range(len(texts))], sets


def order(i, text):
    """The rows' order in the near stage: smallest id, null last, then the digest of the text."""
    return (i is None, i or 0, b"" if text is None else hashlib.md5(text.encode()).digest())


def near_stage(rows):
    at, sets = components([t for _, t in rows], 80)
    first = {}
    for (i, t), c in zip(rows, at, strict=True):
        first[c] = min(first.get(c, (order(i, t), i, t)), (order(i, t), i, t), key=lambda x: x[0])
    return collections.Counter([(i, t) for (i, t), s in zip(rows, sets, strict=True) if not s] + [first[c][1:] for c in {c for c, s in zip(at, sets, strict=True) if s}])


def exact_stage(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[BLANK.sub("", t or "")].append(((-len(t or ""), i is None, i or 0, b"" if t is None else hashlib.md5(t.encode()).digest()), i, t))
    return collections.Counter(min(g, key=lambda x: x[0])[1:] for g in groups.values())


SIX = [(1, "a"), (5, "a"), (5, "unique text"), (7, "zz"), (7, "zz"), (None, "a")]
LONG = " ".join(f"w{i}" for i in range(60))
ODD = [*SIX, (None, "lone"), (None, "lone"), (8, None), (8, ""), (9, " \n"), (3, LONG), (2, LONG + " more"), (2, LONG.upper()), (None, LONG.replace("w7 ", "x ")), (4, " ".join(f"v{i}" for i in range(9000))), (4, " ".join(f"v{i}" for i in range(8999)))]


@pytest.mark.parametrize("rows", [SIX, ODD], ids=["six", "odd"])
def test_dedup_stages_decide_by_row(spark, rows):
    docs = frame(spark, rows)
    for stage, want in ((exact.stage_exact_dedup, exact_stage(rows)), (near.stage_near_dedup, near_stage(rows))):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        assert collections.Counter((r.doc_id, r.text) for r in out.collect()) == want
    assert {(r.doc_id, r.text) for r in near.stage_near_dedup(spark, frame(spark, SIX), "").collect()} == {(1, "a"), (5, "unique text"), (7, "zz")}


def test_near_duplicates_of_repeated_and_null_ids(spark):
    rows = sorted(((r.doc_id is None, r.doc_id or 0, r.component_id, r.kept) for r in near.near_duplicates(frame(spark, ODD)).collect()), key=repr)
    at, sets = components([t for _, t in ODD], 80)
    want = []
    for (i, _), c, s in zip(ODD, at, sets, strict=True):
        ids = [j for (j, _), d in zip(ODD, at, strict=True) if d == c and j is not None]
        component = (min(ids) if ids else None) if s else i
        want.append((i is None, i or 0, component, component == i))
    assert rows == sorted(want, key=repr)


def test_stages_of_random_rows_equal_brute_force(spark):
    rnd, rows = random.Random(4), []
    for i in range(60):
        w = [f"u{rnd.randrange(10**6)}" for _ in range(rnd.randint(1, 80))]
        rows.append((i, " ".join(w)))
        for _ in range(rnd.randint(0, 4)):
            v = list(w)
            for _ in range(rnd.randint(0, 3)):
                v[rnd.randrange(len(v))] = "changed"
            rows.append((rnd.choice([i, 1000 + rnd.randrange(50), None]), rnd.choice([" ", "  ", "\n"]).join(v)))
    docs = frame(spark, rows)
    assert collections.Counter((r.doc_id, r.text) for r in near.stage_near_dedup(spark, docs, "").collect()) == near_stage(rows)
    assert collections.Counter((r.doc_id, r.text) for r in exact.stage_exact_dedup(spark, docs, "").collect()) == exact_stage(rows)


@pytest.mark.parametrize("stage", [langid.stage_langid, exact.stage_exact_dedup, near.stage_near_dedup, bpe.stage_bpe], ids=lambda f: f.__name__)
def test_stages_of_an_empty_table(spark, stage):
    none = spark.createDataFrame([], DOCS)
    out = stage(spark, none, "")
    assert out.count() == 0 and (stage is bpe.stage_bpe or out.columns == none.columns)


def test_stages_of_languages_and_tokens_keep_each_row(spark):
    import public_tokenizers
    import tiktoken

    rnd = random.Random(1)
    make = lambda parts: " ".join("".join(rnd.choice(parts) for _ in range(3)) for _ in range(rnd.randint(5, 40)))
    rows = [(i % 150, make(["the", "ing", "er"] if i % 2 else ["sch", "ung", "ü"]), ("aa" if i % 2 else "bb")) for i in range(300)]
    rows += [rows[0], (None, rows[1][1], None), (5, None, "aa"), (5, "", None), (6, "12 34", "bb"), (7, "the ing er " * 30_000, None)]
    docs = spark.createDataFrame([(i, t, v, "s", 1, "clash") for i, t, v in rows], DOCS).repartition(3)
    model = langid.fit(docs)
    got = collections.Counter((r.doc_id, r.text) for r in langid.stage_langid(spark, docs, "").collect())
    predicted = [(i, t, *(x[0] for x in model.predict(__import__("pyarrow").array([t], "string")))) for i, t, _ in rows]
    assert got == collections.Counter((i, t) for i, t, lang, score in predicted if lang != "und" and score >= model.least)
    clash = docs.selectExpr("*", "cast(doc_id as string) as score", "true as accepted", "n_chars as lang_pred")
    same = langid.stage_langid(spark, clash, "")
    assert same.columns == clash.columns and collections.Counter((r.doc_id, r.text) for r in same.collect()) == got
    assert same.where("not score <=> cast(doc_id as string) or not accepted").count() == 0
    assert got[(None, rows[1][1])] == 1 and got[rows[0][:2]] == 2 and got[(7, "the ing er " * 30_000)] == 1 and not {(5, None), (5, ""), (6, "12 34")} & set(got)
    content = open(public_tokenizers.path(bpe.RANKS), "rb").read()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={__import__("base64").b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}, special_tokens={})
    want = collections.Counter((i, len(ids := library.encode_ordinary(t or "")), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in rows)
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.stage_bpe(spark, docs, "").collect()) == want


def test_url_filter_equals_sql_on_odd_pages(spark):
    duckdb = pytest.importorskip("duckdb")
    rnd = random.Random(6)
    hosts = ["a.co.uk", "b.a.co.uk", "co.uk", "x.com.mx", "y.com.mx", "me.github.io", "you.github.io", "a.ck", "b.a.ck", "www.ck", "x.www.ck", "city.kobe.jp", "a.b.kobe.jp", "1.2.3.4", "u@h.org:80", "örtlich.de", "x.test", "", "..", "one"]
    pages = [(i % 380, rnd.choice([f"http://{h}/p", f"x://{h}?q", h, None]) if rnd.random() < 0.2 else f"http://{h}/{rnd.choice(['fr/', 'de/', 'en/1', ''])}") for i in range(400) for h in [rnd.choice(hosts)]] + [(None, "http://a.co.uk/")]
    labels = [(rnd.randrange(400), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(500)]
    for rows in (pages, []):
        p, q = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, rule string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        con = duckdb.connect()
        for name, df in (("pages", p), ("labels", q)):
            con.register(name, df.toArrow())
        want = collections.Counter(con.execute(f"select page_id, host, path, rule, verdict from ({urls.OP3_SQL})").fetchall())
        assert collections.Counter(map(tuple, urls.filter_urls(p, q).collect())) == want


def test_domains_by_the_whole_suffix_list(spark):
    cases = {"a.b.co.uk": ("b.co.uk", "co.uk"), "x.com.mx": ("x.com.mx", "com.mx"), "p.me.github.io": ("me.github.io", "github.io"), "b.a.ck": ("b.a.ck", "a.ck"), "x.www.ck": ("www.ck", "ck"), "s.city.kobe.jp": ("city.kobe.jp", "kobe.jp"), "u:p@h.example.org:8080": ("example.org", "org"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "a.unknown": ("a.unknown", "unknown"), "com": ("com", "com"), "": ("", "")}
    got = {r.host: (r.domain, r.suffix) for r in urls.with_domain(spark.createDataFrame([(h,) for h in cases], "host string"), urls.public_suffixes()).collect()}
    assert got == cases


def test_near_duplicates_equal_brute_force_on_sf001(spark):
    import os

    data = "/root/testdata/sf0.01"
    if not os.path.isdir(data):
        pytest.skip("no test data")
    docs = common.table(spark, data, "documents").select("doc_id", "text").collect()
    sets = {r.doc_id: shingles(r.text) for r in docs}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    both = collections.Counter(pair for ids in holders.values() for pair in itertools.combinations(sorted(ids), 2))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in both.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.op2_near_dedup(spark, data).collect()}
    assert got == {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_shards_keep_groups_of_equal_texts(spark):
    from rooftop.llm import shard

    rnd, rows = random.Random(8), []
    for i in range(600):
        rows.append((i, "x" * rnd.randint(1, 400) + " " * rnd.randint(0, 20)))
    rows += [(2000 + i, rows[i % 40][1]) for i in range(120)] + [(3000 + i, "hot text") for i in range(900)] + [(5, None), (None, None), (5, "x" * 9), (5, "x" * 9)]
    got = shard.with_slots(shard.kd_tree_shards(frame(spark, rows), 8)).collect()
    want = collections.Counter((i, len((t or "").encode()) + 1) for i, t in rows)
    assert collections.Counter((r.doc_id, r.size) for r in got) == want
    shards = collections.defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
    assert set(shards) == set(range(8)) and all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in shards.values())
    loads = [sum(r.size for r in rs) for rs in shards.values()]
    assert max(loads) - min(loads) <= 0.1 * sum(loads) / 8
    groups = collections.defaultdict(set)
    for r in got:
        groups[r.crc].add(r.shard)
    split = [c for c, s in groups.items() if len(s) > 1]
    assert len(split) <= 2  # the hot text and at most one more that a cut falls into
    again = shard.kd_tree_shards(frame(spark, list(reversed(rows))), 8).collect()
    assert collections.Counter((r.doc_id, r.crc, r.shard) for r in again) == collections.Counter((r.doc_id, r.crc, r.shard) for r in got)
    assert shard.kd_tree_shards(frame(spark, []), 8).count() == 0 and shard.kd_tree_shards(frame(spark, rows[:3]), 1).count() == 3
    assert collections.Counter(r.shard for r in shard.kd_tree_shards(frame(spark, [(i, "ab" * i) for i in range(1, 60)]), 5).collect()).keys() == set(range(5))


def test_repeated_rows_are_spread_over_chunks():
    import numpy as np

    from rooftop.llm import lm

    hashes = np.concatenate([np.full(900, 77), np.arange(100)]).astype(np.int64)
    got = np.concatenate([lm._spread(hashes, 40, at) for at in range(3)])
    assert np.bincount(got, minlength=40).max() < 0.06 * len(got) and got.min() >= 0 and got.max() < 40
    assert (lm._spread(hashes, 40, 1) == lm._spread(hashes, 40, 1)).all() and not len(lm._spread(hashes[:0], 40, 1))
    assert (lm._spread(hashes[900:], 40, 1) == np.arange(100) % 40).all()
    assert lm.chunk_size(5 * 10**8, lm.CHUNK_BYTES) == lm.CHUNK_BYTES and 200 << 20 < lm.chunk_size(10**14, lm.CHUNK_BYTES) < 300 << 20


def test_extraction_of_odd_pages(spark):
    from rooftop.llm import extract

    long = " ".join(f"word{i}" for i in range(40_000))
    good = f"<body><nav>menu</nav><article><p>{long}</p></article><div class='comments'>reader says</div></body>"
    pages = [(1, "http://h.net/a", good), (1, "http://h.net/a", good), (None, "http://h.net/b", good), (2, None, good), (3, "http://h.net/c", None), (4, "", ""), (5, "http://h.net/d", "<article>tie</article><article>tie</article>")]
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract.extract(spark.createDataFrame([(*p, 7) for p in pages], "page_id long, url string, html string, n_chars int")).collect()), key=lambda x: repr(x[:3]))
    want = [(i, u, long if h == good else "tie tie" if h and "tie" in h else "") for i, u, h in pages]
    assert [x[:3] for x in got] == sorted(want, key=repr)
    assert all(n == len(t) for *_, t, n in got)


def test_mix_of_repeated_null_and_empty_rows(spark):
    from rooftop.llm import mix

    text = lambda n, s: " ".join(f"{s}{i}" for i in range(n))
    rows = [(1, text(40, "a"), "x"), (1, text(40, "a"), "x"), (1, text(9, "b"), "x"), (None, text(30, "c"), None), (None, text(30, "c"), None), (2, None, "y"), (3, " \n", "y"), (4, text(700, "d"), "z"), (5, text(5, "é"), "é")]
    docs = spark.createDataFrame([(i, t, None, s, len(t or ""), "clash") for i, t, s in rows], DOCS).repartition(4)
    planned, _ = mix.mixed(docs, block=8)
    got = planned.collect()
    assert collections.Counter((r.doc_id, r.source, r.size) for r in got) == collections.Counter((i, s, len((t or "").split())) for i, t, s in rows)
    taken = collections.Counter()
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    assert all(abs(taken[r.source] - r.target) <= 1 for r in got)
    planned, _ = mix.mixed(docs)
    want = collections.Counter()
    for r in planned.collect():
        want[r.doc_id, r.source, r.content] += r.taken
    made, digests = collections.Counter(), {(i, s, t): b"" if t is None else hashlib.md5(t.encode()).digest() for i, t, s in rows}
    out = mix.stage_mix(spark, docs, "")
    assert out.columns == docs.columns
    for r in out.collect():
        whole = next((t for i, t, s in rows if i == r.doc_id and s == r.source and (t or "").startswith(r.text[:2]) and r.text.split()[0] in t.split()), None)
        assert r.text == whole or " ".join(whole.split()).find(r.text.split()[0]) >= 0
        made[r.doc_id, r.source, digests[r.doc_id, r.source, whole]] += len(r.text.split())
    assert made == collections.Counter({k: n for k, n in want.items() if n})
    assert mix.stage_mix(spark, docs.limit(0), "").count() == 0


def test_whole_pipeline_equals_its_parts_by_brute_force(spark, tmp_path):
    import base64

    import corpus_pipeline
    import public_tokenizers
    import pyarrow as pa
    import tiktoken

    from rooftop.llm import mix

    rnd = random.Random(12)
    make = lambda parts, n: " ".join("".join(rnd.choice(parts) for _ in range(3)) for _ in range(n))
    kinds = {"aa": ["the", "ing", "er", "on"], "bb": ["sch", "ung", "ein", "ü"]}
    rows = []
    for i in range(150):
        lang = rnd.choice([*kinds])
        t = make(kinds[lang], rnd.randint(8, 60))
        rows.append((i, t, lang, f"s{i % 3}"))
        if i % 5 == 0:
            rows.append((1000 + i, "  " + t.replace(" ", "\n", 2), None, "s1"))
        if i % 4 == 0:
            w = t.split()
            w[rnd.randrange(len(w))] = "x"
            rows.append((2000 + i, " ".join([*w, *w]) if i % 8 else " ".join(w), None, None))
    rows += [rows[0], (7, None, None, "s0"), (8, "", "aa", "s0"), (None, rows[3][1], None, "s2")]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = langid.fit(docs)
    kept = []
    for i, t, _, s in rows:
        (lang,), (score,) = model.predict(pa.array([t], "string"))
        if lang != "und" and score >= model.least:
            kept.append((i, t, s))
    def only(rows_, pairs):
        out, left = [], collections.Counter(pairs)
        for r in rows_:
            if left[r[:2]]:
                left[r[:2]] -= 1
                out.append(r)
        return out
    kept = only(kept, exact_stage([r[:2] for r in kept]))
    kept = only(kept, near_stage([r[:2] for r in kept]))
    assert 100 < len(kept) < len(rows) - 30
    frame_ = spark.createDataFrame([(i, t, None, s, len(t)) for i, t, s in kept], "doc_id long, text string, lang string, source string, n_chars long")
    mixed = [(r.doc_id, r.text) for r in mix.stage_mix(spark, frame_, "").collect()]
    content = open(public_tokenizers.path(bpe.RANKS), "rb").read()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}, special_tokens={})
    want = collections.Counter((i, len(ids := library.encode_ordinary(t)), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in mixed)
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want


def test_mix_equals_brute_force_word_by_word(spark):
    import math

    from pyspark.sql import functions as F

    from rooftop.llm import mix

    rnd, block = random.Random(21), 8
    rows = [(i if i % 17 else None, " ".join(f"w{rnd.randrange(99)}" for _ in range(rnd.choice([0, 1, 3, 40, 130]))), rnd.choice(["a", "b", "c", None])) for i in range(160)] + [(7, "tiny", "d")]
    docs = spark.createDataFrame([(i, t, None, s, len(t), "clash") for i, t, s in rows], DOCS).repartition(3)
    found, slots = mix.mixed(docs, block=block)
    got = collections.Counter((r.source, r.doc_id, r.content, r.start, r.taken) for r in found.collect())
    # the order of a source's documents: what Spark's hashes say, then by hand
    n = docs.count()
    keyed = docs.select("doc_id", "source", "text", common.content().alias("content")).withColumns({"bucket": F.pmod(F.xxhash64("doc_id", "content"), F.lit(math.isqrt(n))), "h": F.xxhash64("doc_id", F.lit(mix.SEED))}).collect()
    sources, want = collections.defaultdict(list), collections.Counter()
    for r in keyed:
        sources[r.source].append((r.bucket, r.h, (r.doc_id is not None, r.doc_id or 0), bytes(r.content), len(r.text.split()), r.doc_id))
    names = [*sorted(s for s in sources if s is not None), None]
    sizes = {s: sum(d[4] for d in sources[s]) for s in names}
    per, full = 0.0, set()
    weights = {s: 1 + i % 3 for i, s in enumerate(names)}
    while True:  # targets
        per = (sum(sizes.values()) - sum(3 * sizes[s] for s in full)) / sum(w for s, w in weights.items() if s not in full)
        more = {s for s in names if s not in full and per * weights[s] > 3 * sizes[s]}
        if not more:
            break
        full |= more
    dealt = collections.Counter(r.source if not r.none else None for r in slots.collect())
    for s in names:
        target = 3.0 * sizes[s] if s in full else per * weights[s]
        whole, number, cut, blocks, a, b = mix.plan(s, sizes[s], target, block)
        assert dealt[s] == number
        words = []  # of the source's stream: how often each is taken
        for d in sorted(sources[s]):
            words += [whole] * d[4]
        for j in range(number):
            k = (a * j + b) % blocks * block
            for i in range(k, min(k + (cut if j == number - 1 else block), len(words))):
                words[i] += 1
        assert sum(words) == round(target)
        at = 0
        for d in sorted(sources[s]):
            want[s, d[5], d[3], at, sum(words[at : at + d[4]])] += 1
            at += d[4]
    assert got == want


@pytest.mark.parametrize("leaves", [16, 7])
def test_shards_equal_a_k_d_tree_by_hand(spark, leaves):
    from rooftop.llm import shard

    rnd = random.Random(13)
    rows = [(i, "".join(rnd.choice("abcé ß" if i % 3 else "ab ") for _ in range(rnd.randint(90, 400)))) for i in range(400)]
    rows += [(900 + i, rows[i][1]) for i in range(30)] + [(2000 + i, "one text of many copies, long enough to weigh " * 3) for i in range(60)]
    docs = frame(spark, rows)
    keyed = [(r.doc_id, r["size"], r.crc, (r.k0, r.k1, r.k2)) for r in shard._located(docs, "doc_id", "text", leaves).collect()]
    widest = [max(1, max(r[3][i] for r in keyed) - min(r[3][i] for r in keyed)) for i in range(3)]
    want = collections.Counter()

    def split(part, share, first):
        if share == 1 or not part:
            want.update((r[0], r[1], r[2], first) for r in part)
            return
        ends = [(min(r[3][i] for r in part), max(r[3][i] for r in part)) for i in range(3)]
        dim = max(range(3), key=lambda i: ((ends[i][1] - ends[i][0]) / widest[i], -i))
        half = share // 2
        goal, below = sum(r[1] for r in part) * half / share, 0
        weight = collections.Counter()
        for r in part:
            weight[r[3][dim]] += r[1]
        cut = ends[dim][1]
        if ends[dim][0] < ends[dim][1]:
            for key in sorted(weight):
                if below + weight[key] >= goal:
                    cut = key if abs(below + weight[key] - goal) <= abs(below - goal) else key - 1
                    break
                below += weight[key]
        split([r for r in part if r[3][dim] <= cut], half, first)
        split([r for r in part if r[3][dim] > cut], share - half, first + half)

    split(keyed, leaves, 0)
    got = shard.kd_tree_shards(docs, leaves).collect()
    assert collections.Counter((r.doc_id, r["size"], r.crc, r.shard) for r in got) == want


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not __import__("os").path.isdir(SF), reason="no test data")
def test_extraction_equals_another_parser_on_sf001(spark):
    from html.parser import HTMLParser

    from rooftop.llm import extract

    class Article(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.inside, self.parts = 0, []

        def handle_starttag(self, tag, attrs):
            self.inside += tag == "article"
            self.parts += [" "] * (tag not in ("b", "i", "a", "em", "strong", "span"))

        def handle_endtag(self, tag):
            self.inside -= tag == "article"
            self.parts += [" "] * (tag not in ("b", "i", "a", "em", "strong", "span"))

        def handle_data(self, data):
            self.parts += [data] * (self.inside > 0)

    pages = common.table(spark, SF, "pages").collect()
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in extract.op7_extract(spark, SF).collect()}
    assert len(got) == len(pages)
    for r in pages:
        parser = Article()
        parser.feed(r.html or "")
        text = " ".join("".join(parser.parts).split())
        assert got[r.page_id] == (r.url, text, len(text))


@pytest.mark.skipif(not __import__("os").path.isdir(SF), reason="no test data")
def test_languages_of_held_out_rows_on_sf001(spark):
    import zlib

    docs = {r.doc_id: (r.text, r.lang) for r in common.table(spark, SF, "documents").collect()}
    got = langid.op9_langid(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out and docs[r.doc_id][1] is not None and r.lang_pred != "und"]
    assert len(held) > 100 and sum(r.lang_pred == docs[r.doc_id][1] for r in held) >= 0.98 * len(held)
    letters = lambda t: any(c.isalpha() for c in t or "")
    assert all((r.lang_pred == "und") == (not letters(docs[r.doc_id][0])) and 0 <= r.score <= 1 for r in got)


def test_buckets_collapse_to_components_before_they_are_joined(spark, monkeypatch):
    rows = {}
    write = common.written

    def seen(df, name):
        out = write(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(common, "written", seen)
    large = [(k, r, 9, 0) for k in range(20) for r in range(50)]
    alone = [(k, 100 + k, 9, 100 + k) for k in range(3)]
    same = [(30, 200, 9, 200), (30, 201, 9, 200), (31, 200, 9, 200)]
    placed = spark.createDataFrame(large + alone + same, "key long, rep long, n long, comp long")
    got = {(r.rep, r.comp) for r in near._apart(placed).collect()}
    assert got == {(r, 0) for r in range(50)} | {(100 + k, 100 + k) for k in range(3)}
    assert rows == {"held": 25}  # a row for each bucket and component, not for each bucket and member
