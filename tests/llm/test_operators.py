"""The corpus operators against brute force on small tables with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import bpe, components, cover_tree, decontaminate, html_text, jaccard_join, language_id, quality, sharding, toxicity, url_filter
from lexloom.llm.scratch import Scratch

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EN = "the house of the old man was near the river and the trees "
DE = "das haus von dem alten mann war bei dem fluss und den baeumen "


def docs(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)], SCHEMA)


def near_copies(n=40, seed=1):
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 400, 120)]
    out = [None, "", "   ", "one", "one two", "One TWO", "a b c d e", "a b c d e f"]
    for k in range(n):
        w = list(base)
        for at in rng.integers(0, 120, k % 7):
            w[at] = f"x{rng.integers(0, 10**6)}"
        out.append(" ".join(w))
    out += [" ".join(base)] * 5 + [" ".join(f"w{i}" for i in rng.integers(0, 400, 3000))]
    return out


def groups_by_force(texts, num=80, den=100):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    comp = list(range(len(texts)))
    find = lambda x: x if comp[x] == x else find(comp[x])
    for i, a in enumerate(sets):
        for j in range(i):
            k = len(a & sets[j])
            if a and sets[j] and den * k >= num * (len(a) + len(sets[j]) - k):
                x, y = sorted((find(i), find(j)))
                comp[y] = x
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def test_jaccard_groups(spark):
    texts = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == groups_by_force(texts)


def test_jaccard_empty_and_repeats(spark):
    assert jaccard_join.jaccard_groups(docs(spark, [])).count() == 0
    twice = docs(spark, ["a b c d e f g", "z"]).union(docs(spark, ["a b c d e f g"]))
    assert sorted((r.doc_id, r.component_id) for r in jaccard_join.jaccard_groups(twice).collect()) == [(0, 0), (0, 0), (1, 1)]


def test_one_of_each_keeps_columns(spark):
    out = jaccard_join.one_of_each(docs(spark, ["a b c d e f"] * 3 + ["q r s t u v"]))
    assert sorted(r.doc_id for r in out.collect()) == [0, 3] and sorted(out.columns) == sorted(docs(spark, []).columns)


def test_one_of_each_by_row(spark):
    a, b, c = "a b c d e f", "q r s t u v", "g h i j k l"
    rows = [(None, a), (None, a), (1, b), (1, b), (0, c), (2, c), (2, "m n o p q r"), (None, c), (None, None), (None, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    out = jaccard_join.one_of_each(df)
    assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == sorted((str(i), str(t)) for i, t in [(None, a), (1, b), (0, c), (2, "m n o p q r"), (None, None), (None, "")])
    assert out.columns == df.columns


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (7, None)], "src long, dst long")
    got = {r.node: r.component for r in components.connected_components(spark, edges, Scratch(spark, "t")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100}


@pytest.mark.parametrize("block", [16, 4096])
def test_cover_tree(spark, monkeypatch, block):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 16))
    rows = [(centres[i % 12] + rng.normal(size=16) * (0.02 * (i % 9))).astype(np.float32).tolist() for i in range(150)]
    rows += [rows[3]] * 4 + [[2 * x for x in rows[5]], None, [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [], [None] * 16]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)], "vec_id long, embedding array<float>, label int").withColumn("component_id", F.lit("x"))
    got = {r.vec_id: r for r in cover_tree.near_duplicates(df).collect()}
    good = [i for i, v in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: [] for i in range(len(rows))}
    for i in good:
        for j in good:
            a, b = np.array(rows[i], np.float32).astype(float), np.array(rows[j], np.float32).astype(float)
            if i != j and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.95:
                links[i].append(j)
    comp = {}
    for i in range(len(rows)):
        if i not in comp:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in comp:
                    comp[x] = i
                    todo += links[x]
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (len(links[i]), comp[i], comp[i] == i) for i in range(len(rows))}


def test_cover_tree_empty(spark):
    assert cover_tree.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_bpe_round_trip(spark):
    import base64

    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [None, "", " ", "a", "it's   two\n\n lines", "x" * 3000, " " * 700 + "end", "é ü 漢字 🙂 " * 90, EN * 40]
    for options in ({}, {"long": 200, "chunk": 90, "overlap": 12}):
        got = {r.doc_id: r for r in bpe.decode(bpe.encode(docs(spark, texts).withColumn("ids", F.lit(1)), path, P.PATTERN, **options), path, P.PATTERN).collect()}
        assert all(got[i].ids == enc.encode_ordinary(t or "") and bytes(got[i].decoded) == (t or "").encode() for i, t in enumerate(texts))
        again = {r.doc_id: r for r in bpe.encode(docs(spark, texts), path, P.PATTERN, check=True, **options).collect()}
        assert all(again[i].ids == got[i].ids and again[i].decoded == got[i].decoded for i in got)
    row = bpe.digests(bpe.encode(docs(spark, ["ab cd"]), path, P.PATTERN, check=True)).first()
    assert row.ids_sha256 == hashlib.sha256(",".join(map(str, enc.encode_ordinary("ab cd"))).encode()).hexdigest()
    assert bpe.encode(docs(spark, []), path, P.PATTERN).count() == 0


@pytest.mark.parametrize("options", [{}, {"long": 200, "chunk": 90, "overlap": 12}])
def test_bpe_contractions_at_chunk_ends(spark, options):
    import base64

    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}, special_tokens={})
    if options:  # a text is dealt as chunks, of which the first ends after 102 characters
        texts = ["x" * k + f"{EN}we{c} {EN * 4}" for c in ("'ll", "'re", "'ve", "'s", " \n \n ", "!'ll") for k in range(25, 50)]
    else:
        texts = ["x" * (bpe.CHUNK - 5 + k) + f" we{c} {EN}" for c in ("'ll", "'re", "'ve", "'s", " \n \n ", "!'ll") for k in range(-8, 6)]
    got = {r.doc_id: r.ids for r in bpe.encode(docs(spark, texts), path, P.PATTERN, **options).collect()}
    assert [i for i, t in enumerate(texts) if got[i] != enc.encode_ordinary(t)] == []


def test_bpe_chunks_by_force(monkeypatch):
    import tiktoken

    ranks = {bytes([i]): i for i in range(256)} | {b"ll": 256, b"'ll": 257, b"  ": 258, b" a": 259}
    whole = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    import base64

    enc = bpe.Encoder(b"\n".join(base64.b64encode(k) + b" %d" % v for k, v in ranks.items()), P.PATTERN)
    rng = np.random.default_rng(0)
    for size in (3, 7, 12):
        monkeypatch.setattr(bpe, "CHUNK", size)
        for _ in range(1500):
            text = "".join("a1'llrve  \n!é"[i] for i in rng.integers(0, 13, rng.integers(1, 60)))
            want = whole.encode_ordinary(text)
            assert np.frombuffer(enc.encode(text), np.int32).tolist() == want
            n = len(text)
            dealt = [enc.chunk(text[k : k + size + 5], k, k + size >= n) for k in range(0, n, size)]
            assert np.frombuffer(enc.stitch(dealt, text), np.int32).tolist() == want


def test_sharding(spark):
    texts = ["same"] * 60 + ["pair a", "pair a", "pair b", "pair b", None, ""] + [f"text {i}" for i in range(91)]
    rows = sharding.balanced_shards(docs(spark, texts).withColumn("shard", F.lit(9))).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    by = {s: sorted(r.slot for r in rows if r["shard"] == s) for s in range(8)}
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and all(v == list(range(len(v))) for v in by.values())
    assert all(r.size == len((texts[r.doc_id] or "").encode()) + 1 and r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in rows)
    at = {r.doc_id: r["shard"] for r in rows}
    assert at[60] == at[61] and at[62] == at[63]
    assert sum(sorted((sum(at[i] == s for i in range(60)) for s in range(8)), reverse=True)[:3]) >= 45  # three shards can hold them all
    assert sharding.balanced_shards(docs(spark, [])).count() == 0 and sharding.balanced_shards(docs(spark, ["x"])).first().slot == 0


def test_url_filter(spark):
    urls = [None, "", "no scheme", "HTTP://WWW.Bad.Example.COM/a?b", "https://good.example.com", "x://sub.bad.example.com#f", "http://notbad.example.com/", "https://a.com/en/1", "http://q.example.com/en/77", "://"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, html string").withColumn("host", F.lit("z"))
    listed = spark.createDataFrame([("bad.example.com",), ("absent.org",), (None,)], "key string")
    rules = [("block", "com/en/"), ("allow", "example.com/en/7")]
    for most in (url_filter.MAX_BYTES, 0):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, listed, rules, max_bytes=most).collect()}
        assert got[0] == got[1] == got[2] == got[9] == ("", "", None, "allow")
        assert got[3] == ("www.bad.example.com", "/a", None, "block") and got[5] == ("sub.bad.example.com", "", None, "block")
        assert got[4][3] == got[6][3] == "allow" and got[7] == ("a.com", "/en/1", "com/en/", "block") and got[8] == ("q.example.com", "/en/77", "example.com/en/7", "allow")


def test_cascade_is_exact(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = url_filter.build(keys, keys.where("substring(key, -1) = '7'"))
    rows = keys.select("key", *url_filter._hashes(F.col("key"))).toPandas()
    assert (cascade.listed(rows.h1.to_numpy(), rows.h2.to_numpy()) == rows.key.str.endswith("7").to_numpy()).all() and len(cascade.levels) > 1


def test_language_id(spark):
    rows = [(i, (EN if i % 2 else DE) * (1 + i % 5), "en" if i % 2 else "de", "s", 0) for i in range(80)] + [(100, None, "en", "s", 0), (101, "123 !?", "de", "s", 0), (102, "", None, "s", 0), (103, EN * 2000, None, "s", 0)]
    got = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(5))).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(80)) and got[103].lang_pred == "en"
    assert {got[i].lang_pred for i in (100, 101, 102)} == {"und"} and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert [r.lang_pred for r in language_id.identify(docs(spark, ["text"], None)).collect()] == ["und"] and language_id.identify(docs(spark, [])).count() == 0


def test_ppm_code_is_a_distribution():
    m = language_id.Model(["a"], [(0, (97 << 24) | (98 << 16) | (97 << 8) | 98, 7), (0, (98 << 24) | (97 << 16) | (98 << 8) | 99, 5)])
    for row in m.cost[:, :, 0]:
        assert abs((2.0 ** -row[:-1]).sum() + (256 - (m.a - 1)) * 2.0 ** -row[-1] - 1) < 1e-4


def test_toxicity(spark):
    rows = [(i, (EN + "you idiot. " + EN) if i % 4 == 0 else EN * 2, "en", "s", 0) for i in range(400)] + [(900, None, "en", "s", 0), (901, "", "en", "s", 0)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(0, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.detect(spark.createDataFrame(rows, SCHEMA).withColumn("toxic", F.lit(1)), labels).collect()}
    assert all(got[i].predicted == int(i % 4 == 0) for i in range(400)) and got[900].predicted == got[901].predicted == 0
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got[0].spans) == 1
    assert toxicity.detect(docs(spark, ["x"]), labels.limit(0)).first().score == 0.0


def test_decontamination(spark):
    words = [f"b{i}" for i in range(14)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "Short ITEM here"), (3, None), (4, "..."), (5, " ".join(words[:12]))], "item_id long, text string").withColumn("lang", F.lit("x"))
    texts = [None, "", "clean text", "start, " + " - ".join(words).upper() + "! end.", "a short item here b", " ".join(words[:9]), EN + " ".join(words[2:12]) + " " + EN]
    for most in (decontaminate.MAX_WINDOWS, 1):
        got = {r.doc_id: r for r in decontaminate.contamination(docs(spark, texts), items, max_windows=most).collect()}
        assert [(got[i].n_words, got[i].n_hit, got[i].n_items, got[i].contaminated) for i in range(7)] == [(0, 0, 0, False), (0, 0, 0, False), (2, 0, 0, False), (16, 14, 2, True), (5, 3, 1, True), (9, 0, 0, False), (len((EN + EN).split()) + 10, 10, 2, True)]
        assert got[3].items_sha256 == hashlib.sha256(b"1,5").hexdigest() and got[0].items_sha256 == hashlib.sha256(b"").hexdigest()
    cut = {r.doc_id: r.text for r in decontaminate.remove_contaminated(docs(spark, texts), items).collect()}
    assert cut[0] is None and cut[2] == "clean text" and cut[3] == "start, end." and cut[4] == "a b" and cut[6].split() == (EN + EN).split()
    assert sorted(r.doc_id for r in decontaminate.remove_contaminated(docs(spark, texts), items, whole=True).collect()) == [0, 1, 2, 5]
    assert decontaminate.contamination(docs(spark, ["x"]), items.limit(0)).first().contaminated is False


def test_html_text(spark):
    make = lambda body: f"<html><head><title>t</title><script>var x='<p>no</p>'</script></head><body><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav><div class='ad'>Buy now.</div><article><h1>Title  of it</h1>{body}</article><footer>&copy; site</footer></body></html>"
    bodies = [f"<p>Text {i} of the page &amp; more,\n with words.<p>Second {'long ' * (i % 9)}paragraph." for i in range(30)]
    pages = spark.createDataFrame([(i, "u", make(b)) for i, b in enumerate(bodies)] + [(100, None, None), (101, "u", ""), (102, "u", "<p")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    assert all(got[i].text == f"Title of it\n\nText {i} of the page & more, with words.\n\nSecond {'long ' * (i % 9)}paragraph." and got[i].n_chars == len(got[i].text) for i in range(30))
    assert got[100].text == got[101].text == "" and got[100].n_chars == 0


def test_html_vectors_see_whole_blocks():
    opening = " ".join(f"w{i}" for i in range(40))
    at = [html_text.vectors([(t, ("p",), 0)])[0] for t in (opening + " notice" * 30, opening + " article" * 30, opening + " notice" * 2000, opening + " notice" * 2000 + " article" * 500, " ".join([opening] * 3), " ".join([opening] * 6))]
    words = slice(html_text.PATH, html_text.PATH + html_text.WORDS)
    assert html_text._bucket("notice", html_text.WORDS, "w") != html_text._bucket("article", html_text.WORDS, "w")
    assert (at[0][words] != at[1][words]).any() and (at[2][words] != at[3][words]).any()  # the second pair differs after 14,000 characters
    assert np.allclose(at[4][words], at[5][words]) and at[4][-1] < at[5][-1]  # shares do not grow with the length, the measure of words does


def test_html_label_is_decided_by_late_words():
    opening = " ".join(f"w{i % 7}" for i in range(60))
    page = lambda w: [(f"{opening} {w * 40}", ("p",), 0)]
    pairs = [(html_text.vectors(page(w)), np.array([y])) for w, y in (("notice ", 0.0), ("article ", 1.0))] * 256
    low, high = html_text.Labeller().fit(pairs).label([x for x, _ in pairs[:2]])
    assert low[0] < 0.5 <= high[0]


def test_quality(spark):
    rows = [(i, EN * 3 if i % 3 else "$$ 123 !! " * 20, "en", f"s{i % 4}", 0) for i in range(300)] + [(500, None, None, None, 0)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, SCHEMA), labels, F.col("source"), F.col("lang")).collect()}
    assert all(got[i].high == (i % 3 > 0) for i in range(300)) and len(got) == 301 and all(0 <= r.score <= 1 for r in got.values())


def brute_groups(texts, width=5, num=80, den=100):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(texts))]


def test_jaccard_star_of_unlike_near_copies(spark):
    """Near copies of one text, some too far from it to be linked, some of those linked with each other; texts that share only
    a passage; copies of copies: as brute force finds them, from few candidates."""
    rng = np.random.default_rng(5)
    word = lambda: f"w{rng.integers(0, 4000)}"
    base = [word() for _ in range(150)]

    def edited(words, n):
        words = list(words)
        for at in rng.choice(len(words), n, replace=False):
            words[at] = word()
        return words

    texts = [base] + [edited(base, int(k)) for k in rng.integers(1, 8, 500)]
    for _ in range(20):  # far from the text, near each other
        far = edited(base, 9)
        texts += [far, edited(far, 1), edited(far, 2)]
    texts += [[word() for _ in range(60)] + base[:90] + [word() for _ in range(20)] for _ in range(60)]
    texts += [base[k:] for k in range(1, 60, 3)] + [base[:-k] for k in range(1, 60, 3)]
    order = rng.permutation(len(texts))
    texts = [" ".join(texts[i]) for i in order] + [" ".join(base)] * 30
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_groups(docs(spark, texts)).collect()}
    want = brute_groups(texts)
    assert [i for i in range(len(texts)) if got[i] != want[i]] == [] and len(set(want)) > 100


def test_jaccard_null_ids_and_clashing_names(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (5, "a b c d e f"), (7, None)], "doc_id long, text string")
    for name in ("cls", "sig", "component_id", "tokens", "n_shingles"):
        df = df.withColumn(name, F.lit("x"))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.jaccard_groups(df).collect()) == [("3", 2, "3"), ("5", 2, "3"), ("7", 0, "7"), ("None", 2, "None")]


def test_fingerprints_of_equal_hash_are_told_apart(spark, monkeypatch):
    real = jaccard_join.fingerprints

    def poor(row, s, n, salt=0):
        size, a, b = real(row, s, n, salt)
        return size, a if salt else a % np.uint64(3) + np.uint64(1), b

    monkeypatch.setattr(jaccard_join, "fingerprints", poor)
    df = docs(spark, [f"a{i} b{i} c{i} d{i} e{i} f{i}" for i in range(12)])
    sizes = jaccard_join._sizes(df.select("doc_id", "text"), 5)
    if sizes.select("cls").distinct().count() == 3:  # (where workers see the patch)
        assert sorted(r.component_id for r in jaccard_join.jaccard_groups(df).collect()) == list(range(12))


def test_cover_tree_block_where_nothing_prunes():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(700, 32)).astype(np.float32), rng.normal(size=(900, 32)).astype(np.float32)
    hub = rng.normal(size=32)
    x[:200], y[:300] = hub + rng.normal(size=(200, 32)) * 0.22, hub + rng.normal(size=(300, 32)) * 0.22
    y[300:340] = x[200:240]
    wx, wy = rng.integers(1, 4, 700), rng.integers(1, 4, 900)
    u, v = (a.astype(float) / np.sqrt((a.astype(float) ** 2).sum(1, keepdims=True)) for a in (x, y))
    for b, ib, wb, hit in ((y, np.arange(900) + 1000, wy, u @ v.T >= 0.95), (None, np.arange(700), wx, u @ u.T >= 0.95)):
        na, nb, edges = cover_tree.block_links(x, np.arange(700), wx, b, ib, wb, 0.95)
        assert (na == hit @ wb).all() and (b is None or (nb == wx @ hit).all())
        find = {}

        def top(i, find=find):
            while find.get(i, i) != i:
                i = find[i]
            return i

        def roots(pairs, find=find):
            find.clear()
            for p, q in pairs:
                find[top(max(top(p), top(q)))] = min(top(p), top(q))
            return {int(i): int(top(i)) for pair in pairs for i in pair}

        p, q = np.nonzero(hit)
        want = roots(np.column_stack([p, ib[q]]).tolist())
        got = roots(np.concatenate(edges).tolist())
        assert {k: v for k, v in got.items() if k in want} == want


def test_cascade_ends_and_is_exact_for_any_split(spark):
    """The hashes of a level are those of no other, so small levels of unlucky keys end too."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(2, 400))
        h1, h2 = (rng.integers(-(2**63), 2**63, n) for _ in range(2))
        on = rng.random(n) < rng.random()
        sides, side, cascade = {True: np.flatnonzero(on), False: np.flatnonzero(~on)}, True, url_filter.Cascade([])
        while len(sides[side]):
            level, words = len(cascade.levels), -(-max(url_filter.LEAST_BITS, len(sides[side]) * url_filter.BITS) // 64)
            filled = np.zeros(words, np.uint64)
            at = url_filter.Cascade.positions(h1[sides[side]], h2[sides[side]], level, words * 64).ravel()
            np.bitwise_or.at(filled, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
            cascade.levels.append(filled)
            other = sides[not side]
            sides[not side] = other[cascade.passes(h1[other], h2[other], level)]
            side = not side
            assert len(cascade.levels) < 20
        assert (cascade.listed(h1, h2) == on).all()


def test_url_filter_with_thousands_of_listed_hosts(spark):
    pages = spark.range(9000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://a.h"), F.col("id"), F.lit(".net/x")).alias("url"))
    pages = pages.union(pages.limit(3)).withColumn("key", F.lit(1)).withColumn("h1", F.lit(2))
    listed = spark.range(0, 20000, 3).select(F.concat(F.lit("h"), F.col("id"), F.lit(".net")).alias("key"))
    got = url_filter.judge(pages, listed, []).groupBy("page_id", "verdict").count().collect()
    assert sum(r["count"] for r in got) == 9003 and all((r.verdict == "block") == (r.page_id % 3 == 0) for r in got)
    assert url_filter.judge(pages.limit(0), listed, []).count() == 0


def test_toxicity_long_clean_texts_and_sparse_words(spark):
    """Toxic words that stand alone in their sentences; a clean text of thousands of sentences stays clean."""
    rows = [(i, EN + ("Some slurword here. " + EN + "A slurword there. " if i % 5 == 0 else EN), "en", "s", 0) for i in range(500)] + [(900, EN * 3000, "en", "s", 0), (None, "slurword", "en", "s", 0)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(500) if i % 7] + [(None, 1)], "doc_id long, toxic int")
    df = spark.createDataFrame(rows, SCHEMA).withColumn("k", F.lit("x")).withColumn("y", F.lit("x"))
    got = {r.doc_id: r for r in toxicity.detect(df, labels).collect()}
    assert [i for i in range(500) if got[i].predicted != int(i % 5 == 0)] == [] and got[900].score < 0.1
    assert toxicity.detect(docs(spark, []), labels).count() == 0


def test_toxicity_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(0)
    doc = np.sort(rng.integers(0, 6, 30))
    sentence = np.cumsum(np.r_[False, (doc[1:] != doc[:-1]) | (rng.random(29) < 0.5)])
    ids = np.where(rng.random((toxicity.KINDS, 30)) < 0.7, rng.integers(0, 5, (toxicity.KINDS, 30)), -1)
    hits = toxicity.Hits(doc, sentence, ids, np.full(6, 40))
    labels = np.array([1, 0, 1, 0, 1, 0])

    def loss(m):
        z = np.bincount(hits.of, weights=np.where(hits.ids >= 0, m.weights[hits.ids], 0).sum(0), minlength=len(hits.doc)) + m.facts @ hits.facts + m.bias
        p = 1 - np.exp(np.bincount(hits.doc, weights=np.log(1 - toxicity._logistic(z)), minlength=6))
        some = np.bincount(hits.doc, minlength=6) > 0
        return -np.log(np.where(labels == 1, p, 1 - p))[some].sum()

    trained = [loss(toxicity.fit(hits, labels, epochs=e, decay=0.0)) for e in (1, 30, 300)]
    assert trained[0] > trained[1] > trained[2]
