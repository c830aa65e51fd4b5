"""The operators against brute force, on small tables with nulls, empty and long texts, ties and repeated rows."""

import base64
import collections
import hashlib
import html
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from rooftop.llm import bpe, exact, extract, langid, lm, media, mix, near, shard, urls

BLANK = re.compile(rb"[\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string"


def words(text):
    return [w for w in BLANK.split((text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))) if w]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdeéßñ") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    base = [text(rnd.randint(1, 120)) for _ in range(60)]
    near_copies = []
    for b in base[:12]:
        for _ in range(3):
            w = b.split()
            w[rnd.randrange(len(w))] = "changed"
            near_copies.append(" ".join(w))
    texts = [None, "", "  \n\t", "one", "ONE", "a b c d", "A  b\nc d", "é" * 5000, text(6000), *base, *near_copies, *base[:5], base[0].upper(), " " + base[1] + "\n"]
    out = [(i, t, ("x", "y", None)[i % 3], (f"s{i % 4}", None)[i % 9 == 8], len(t or ""), "clash") for i, t in enumerate(texts)]
    return [*out, *[(1000 + i, base[3], "x", "s0", 1, "hot") for i in range(70)]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_media_round_trip(spark, docs, rows, none, tmp_path):
    root = f"file://{tmp_path}/shards"
    stored = media.store(docs, root)
    got = {r.doc_id: r for r in media.features(media.metadata(stored, root), root).collect()}
    assert got.keys() == {r[0] for r in rows}
    for i, t, *_ in rows:
        body = (t or "").encode()
        payload = body + b" " * (max(1, math.ceil(len(body) / 192)) * 192 - len(body))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(body), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert (r.media_type, r.width, r.height, r.bits) == ("image/png", 192, len(payload) // 192, 8)
        png = media.to_png(payload)
        assert media.from_png(png) == payload and r.media_bytes == len(png) and r.media_sha256 == hashlib.sha256(png).hexdigest()
    assert media.features(media.metadata(media.store(none, f"{root}0"), f"{root}0"), f"{root}0").count() == 0


def test_tar_shards_open(docs, tmp_path):
    import tarfile

    rows, names = media.store(docs, f"file://{tmp_path}/s").collect(), []
    for name in {r.shard for r in rows}:
        with tarfile.open(tmp_path / "s" / name) as tar:
            members = {m.offset_data: m for m in tar.getmembers()}
            assert all(members[r.offset].name == f"{r.digest}.png" and members[r.offset].size == r.length for r in rows if r.shard == name)
            names += [m.name for m in members.values()]
    assert len(names) == len(set(names)) == len({r.digest for r in rows})  # a digest has one member in all shards


def brute_near(rows):
    sets = {}
    for i, t, *_ in rows:
        w = words(t)
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_near_duplicates_equal_brute_force(docs, rows, none):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.near_duplicates(docs).collect()}
    assert got == brute_near(rows)
    assert near.near_duplicates(none).count() == 0


def test_near_duplicates_that_only_chain(spark):
    rnd = random.Random(2)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(40):  # each differs from its neighbours in few places, and from far ones in many
        w = list(base)
        for k in range(i):
            w[k * 5] = f"n{k}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: c for i, (_, c, _) in brute_near(rows).items()}


def test_the_near_stage_links_from_80_per_cent(spark):
    rnd, rows = random.Random(7), []
    for n in range(40, 72):  # a word changed in the middle leaves n - 9 of n + 1 shingles in common
        w = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
        rows += [(2 * n, " ".join(w), "x"), (2 * n + 1, " ".join([*w[:20], "changed", *w[21:]]), "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    links = lambda percent: {2 * n + 1 for n in range(40, 72) if 100 * (n - 9) >= percent * (n + 1)}
    out = near.stage_near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    assert {r[0] for r in rows} - {r.doc_id for r in out.collect()} == links(80)
    assert {r.doc_id for r in near.near_duplicates(docs, percent=85).collect() if not r.kept} == links(85)
    assert near.limits(85).collections == 16 and near.limits(80).collections == 22


def test_words_and_shingles_of_odd_texts():
    texts = [b"", b" ", b"A b", "É x".encode(), b"a\x0bb\x0cc", b"q" * 3000]
    from rooftop.llm.words import hashed

    h, at = hashed(texts)
    assert np.diff(at).tolist() == [len(words(t.decode())) for t in texts]
    again, _ = hashed([b"zz", b"a B"])
    assert h[at[2] : at[3]].tolist() == again[1:].tolist()


def test_host_path_and_rules(spark):
    cases = {
        None: ("", "", None), "no scheme": ("", "", None), "http://A.Example.ORG": ("a.example.org", "", None), "x://example.org/es/1?q#f": ("example.org", "/es/1", "example.org/es/"),
        "http://b.example.org/en/19": ("b.example.org", "/en/19", "example.org/en/1"), "http://notexample.org/es/": ("notexample.org", "/es/", "org/"), "https://x.com/de/?a": ("x.com", "/de/", "com/de/"),
        "http://x.com?u=/de/": ("x.com", "", None), "http://É.net/a#b://c": ("É.net", "/a", None),
    }
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(cases)], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in urls.filter_urls(pages, labels).collect()}
    for i, (host, path, rule) in enumerate(cases.values()):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == ("block" if rule in ("example.org/es/", "example.org/en/1", "com/de/") else "allow")


def test_reputation_blocks_bad_hosts_and_spares_rare_ones(spark):
    pages = [(i, f"http://{'bad' if i < 60 else 'good' if i < 120 else 'one'}.net/x") for i in range(121)]
    labels = [(i, 0 if i < 60 or i == 120 else 1, None) for i in range(121)]
    got = urls.filter_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {(r.host, r.verdict) for r in got} == {("bad.net", "block"), ("good.net", "allow"), ("one.net", "allow")}


def test_lm_scores_equal_brute_force(docs, rows, none):
    got = {r.doc_id: r for r in lm.score_documents(docs, chunk_bytes=8000).collect()}
    texts = {r[0]: words(r[1]) for r in rows}
    counts = collections.Counter(tuple(w[i : i + n]) for w in texts.values() for n in (1, 2, 3) for i in range(len(w) - n + 1))
    total = sum(map(len, texts.values()))
    for i, w in texts.items():
        score = 0.0
        for k in range(len(w)):
            for back, n in enumerate(range(min(3, k + 1), 0, -1)):
                gram = tuple(w[k - n + 1 : k + 1])
                if n == 1 or counts[gram] >= 2:
                    score += back * math.log(0.4) + math.log(counts[gram] / (counts[gram[:-1]] if n > 1 else total))
                    break
        assert got[i].n_words == len(w) and got[i].log_score == pytest.approx(score, abs=1e-6)
        assert (got[i].mean_log_score is None) == (not w)
    assert lm.score_documents(none).count() == 0


def test_shards_are_near_equal_and_slots_have_no_gaps(docs, rows, none):
    got = shard.with_slots(shard.kd_tree_shards(docs, 4)).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    assert {r.doc_id: (r.size, r.crc) for r in got} == {r[0]: (len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows}
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by.values())
    loads = [sum(r.size for r in by[k]) for k in range(4)]
    assert max(loads) - min(loads) <= 2 * max(r.size for r in got)
    assert shard.with_slots(shard.kd_tree_shards(none, 4)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_bpe_equals_the_library(seed):
    content = open(public_tokenizers.path(bpe.RANKS), "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec, rnd = bpe.Codec(content), random.Random(seed)
    parts = [*"abst'  \n\t'sredlvm019!.é漢😀\x85\u00a0\u3000\x1c\r", "'ll", " the", "  ", "<|endoftext|>"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(2000)] + ["", " ", "a" * 2000, "é" * 700, "x" * 299 + " " + "ab" * 400]
    coded = [c for group in bpe._grouped(texts) for c in codec.encode(group)]
    assert [[int(i) for i in c.split()] for c in coded] == [library.encode_ordinary(t) for t in texts]
    assert [codec.decode(c).decode() for c in coded] == texts


def test_bpe_operator(docs, rows, none):
    path = public_tokenizers.path(bpe.RANKS)
    got = {r.doc_id: r for r in bpe.digests(docs, path).collect()}
    ids = {r.doc_id: r.ids for r in bpe.encode(docs, path).collect()}
    bodies = {r.doc_id: bytes(r.body) for r in bpe.decode(bpe.encode(docs, path), path).collect()}
    for i, t, *_ in rows:
        assert bodies[i] == (t or "").encode() and got[i].n_tokens == len(ids[i])
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids[i])).encode()).hexdigest() and got[i].decoded_sha256 == hashlib.sha256(bodies[i]).hexdigest()
    assert bpe.digests(none, path).count() == 0


def test_extract(spark):
    body = "<article><h1>T &amp; u</h1><p>One  <i>t</i>wo\n three<br>four<p>five <b>six</article>"
    noise = "<nav><a href=/>menu menu menu menu</a></nav><div class='cookie-notice'>take it</div><div class=comments><p>reader says a lot, reader says a lot, reader says a lot</p></div><form>mail</form><script>x='<p>no</p>'</script><!-- <p>not</p> --><footer>end &copy;</footer>"
    pages = [(i, "http://h.net/x", f"<html><body>{noise}{body}{noise}") for i in range(5)] + [(5, None, None), (6, "", ""), (7, "http://h.net/y", "plain &lt;text&gt; &am"), (8, "http://h.net/z", "<p>" * 50 + "deep" + "<div>" * 300)]
    got = {r.page_id: r for r in extract.extract(spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, host string")).collect()}
    assert {got[i].text for i in range(5)} == {"T & u One two three four five six"}
    assert [got[i].text for i in (5, 6, 7, 8)] == ["", "", "plain <text> &am", "deep"]
    assert all(r.n_chars == len(r.text) for r in got.values()) and got[5].url is None
    assert extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_extract_prefers_the_path_that_its_host_agrees_on(spark):
    page = lambda main, side: f"<body><div class='box-{len(main)}'><p>{side}</p></div><div class='story'><p>{main}</p></div></body>"
    pages = [(i, "http://h.net/x", page("long words " * 30, "side")) for i in range(9)] + [(9, "http://h.net/y", page("short main text of the page", "a box that is somewhat longer than it"))]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[9] == "short main text of the page"


def test_entities_and_white_space():
    assert extract.main_text("<p>&nbsp; a&#x41;\u00a0b </p>", None) == "aA b" == " ".join(html.unescape("&nbsp; a&#x41;\u00a0b ").split())


def test_exact_duplicates_equal_brute_force(docs, rows, none):
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i))
    want = {i: (min(g)[1], len(g), min(g)[1] == i, hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for _, i in g}
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.exact_duplicates(docs).collect()} == want
    assert exact.exact_duplicates(none).count() == 0


def test_langid_learns_and_rejects(spark):
    rnd = random.Random(3)
    make = lambda parts, n: " ".join("".join(rnd.choice(parts) for _ in range(3)) for _ in range(n))
    kinds = {"aa": ["the", "ing", "er", "on"], "bb": ["sch", "ung", "ein", "ü"], "cc": ["ção", "os", "que", "ñ"]}
    data = [(i, make(kinds[k], rnd.randint(3, 60)), k) for i, k in enumerate(rnd.choice([*kinds]) for _ in range(600))] + [(9000, None, "aa"), (9001, "", None), (9002, "12 !!", "bb")]
    docs = spark.createDataFrame([(*d, "clash") for d in data], "doc_id long, text string, lang string, score string")
    got = langid.identify(docs, langid.fit(docs, rows=150)).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id < 9000]
    assert len(held) > 50 and sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    odd = {r.doc_id: (r.lang_pred, r.score, r.accepted) for r in got if r.doc_id >= 9000}
    assert set(odd.values()) == {("und", 0.0, False)}
    assert sum(r.accepted for r in got) >= 0.97 * 600
    empty = docs.limit(0)
    assert langid.identify(empty, langid.fit(empty)).count() == 0


def targets(sizes, weights, most=3):
    """Brute force: full sources leave one by one, the rest is shared anew."""
    left, out = dict(weights), {}
    while left:
        per = (sum(sizes.values()) - sum(out.values())) / sum(left.values())
        full = [s for s, w in left.items() if per * w > most * sizes[s]]
        if not full:
            return out | {s: per * w for s, w in left.items()}
        out[full[0]] = float(most * sizes[full[0]])
        del left[full[0]]
    return out


def test_targets_stop_at_three_times(spark):
    assert targets({"a": 100, "b": 1, "c": 100}, {"a": 1, "b": 5, "c": 1}) == {"b": 3.0, "a": 99.0, "c": 99.0}
    rnd = random.Random(9)
    for _ in range(4):
        sizes = {f"s{i}": rnd.choice([0, 1, 7, 100, 10_000]) for i in range(rnd.randint(1, 9))}
        weights = {s: rnd.choice([1, 2, 3, 50]) for s in sizes}
        got = mix.with_targets(spark.createDataFrame([(s, n, weights[s]) for s, n in sizes.items()], "source string, size long, weight long"))
        assert {r.source: r.target for r in got.collect()} == pytest.approx(targets(sizes, weights) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0))


def test_mix_meets_its_targets(docs, rows, none):
    out, slots = mix.mixed(docs, block=16)
    got, per = out.collect(), slots.collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    sizes = {r[0]: len(words(r[1])) for r in rows}
    assert all(r.size == sizes[r.doc_id] and 0 <= r.taken <= 3 * r.size for r in got)
    taken, target = collections.Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert len({(r.source, r.none, r.block) for r in per}) == len(per)  # a pass takes a block once
    again, _ = mix.mixed(docs.repartition(3), block=16)
    assert collections.Counter((r.doc_id, r.source, r.taken) for r in again.collect()) == collections.Counter((r.doc_id, r.source, r.taken) for r in got)
    names = [*sorted({r[3] for r in rows if r[3] is not None}, key=str.encode), None]
    of = {s: sum(sizes[r[0]] for r in rows if r[3] == s) for s in names}
    assert target == pytest.approx(targets(of, {s: 1 + i % 3 for i, s in enumerate(names)}))
    assert mix.mixed(none)[0].count() == 0


@pytest.mark.parametrize("size,block", [(1, 4), (7, 4), (64, 4), (1001, 16)])
def test_plan_takes_what_the_target_says(size, block):
    for words_ in range(1, 3 * size + 1, max(1, size // 9)):
        whole, slots, cut, blocks, a, b = mix.plan("s", size, float(words_), block)
        length = lambda k: min(block, size - k * block)  # noqa: B023, E731
        order = [(a * j + b) % blocks for j in range(slots)]
        assert len(set(order)) == len(order)
        got = sum(min(length(k), cut if j == slots - 1 else block) for j, k in enumerate(order))
        assert whole * size + got == words_


def test_stage_of_the_mix_holds_the_words_taken(spark, docs):
    rows, _ = mix.mixed(docs)
    want = {r.doc_id: r.taken for r in rows.collect()}
    out = mix.stage_mix(spark, docs, "")
    assert out.columns == docs.columns
    got = collections.Counter()
    for r in out.collect():
        got[r.doc_id] += len(words(r.text))
    assert {i: n for i, n in want.items() if n} == dict(got)


def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    at = docs
    for name, stage in corpus_pipeline.STAGES:
        before = at
        at = stage(spark, at, "").cache()
        assert at.count() > 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert at.columns == docs.columns
        if name in ("exact_dedup", "near_dedup", "language_id"):
            assert {r.doc_id for r in at.collect()} <= {r.doc_id for r in before.collect()}
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= {*at.columns}
