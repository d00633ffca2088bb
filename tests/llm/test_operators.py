"""Each operator against brute force on small tables with nulls, empty texts, ties, repeats and odd columns."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from flowtide.llm import (
    common, decontamination, exact_dedup, language_id, lm, pieces, quality, secret_scan, sharding, simhash, url_filter,
)
from flowtide.llm.components import components
from flowtide.llm.queries import PIECES, URL_RULES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, fp string, ids string"
R = random.Random(5)
WORDS = ["the", "of", "Émile", "Rain", "x" * 30, "a", "q\u00a0z", "7up", "it's", "end."]


def prose(n):
    return " ".join(R.choice(WORDS) for _ in range(n))


COPY = prose(80)
TEXTS = ["", None, "", " \n\t", "one", "Two words", COPY, COPY, COPY, COPY + " more", prose(3000), prose(40)] + [prose(R.randint(1, 60)) for _ in range(30)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, R.choice(["en", "fr", None]), "src0", 1, 7, "x", "y") for i, t in enumerate(TEXTS)]
    rows += [(None, "no id", None, None, None, None, None, None), (None, COPY, "en", None, None, None, None, None), rows[6], rows[6]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", low(text))


# ---- exact dedup -----------------------------------------------------------------------------

def test_exact_classes(docs):
    rows = exact_dedup.classes(docs, keep="largest").collect()
    groups = collections.defaultdict(list)
    for r in docs.collect():
        groups[r.text or ""].append(r.doc_id)
    assert len(rows) == docs.count()
    for r in rows:
        ids = [i for i in groups[r.text or ""] if i is not None]
        assert r.keep_id == max(ids, default=None) and r.group_size == len(groups[r.text or ""])
        assert r.kept == (r.doc_id == r.keep_id)


def test_exact_dedup_leaves_one_of_each_text(docs, empty):
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for t in TEXTS} | {"no id"})
    assert exact_dedup.deduplicate(empty).count() == 0


def test_equal_hashes_of_different_texts_stay_apart(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "content_hash", lambda text: F.lit(b"same"))
    sizes = {(r.text or ""): r.group_size for r in exact_dedup.classes(docs).collect()}
    counts = collections.Counter(r.text or "" for r in docs.collect())
    assert sizes == dict(counts)


# ---- sharding --------------------------------------------------------------------------------

@pytest.mark.parametrize("bucket_bytes", [200, 1 << 20])
def test_sharding_is_an_even_permutation(docs, bucket_bytes):
    out = sharding.shard(docs, 8, bucket_bytes=bucket_bytes)
    rows = out.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in rows) == sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs.collect())
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[i]) for i in range(8)]
    assert max(sizes) - min(sizes) <= 1
    again = sharding.shard(docs.repartition(3), 8, bucket_bytes=bucket_bytes).collect()
    place = lambda x: sorted((r.doc_id, r.shard, r.slot) for r in x if r.doc_id is not None and r.doc_id != 6)
    assert place(rows) == place(again)


def test_sharding_of_nothing_and_written_files(empty, docs, tmp_path):
    assert sharding.shard(empty, 8).count() == 0
    sharding.write(sharding.shard(docs, 4), str(tmp_path / "s"))
    assert docs.sparkSession.read.parquet(str(tmp_path / "s")).groupBy("shard").count().count() == 4


# ---- SimHash ---------------------------------------------------------------------------------

def fingerprint(text, width=3):
    w = words(text)
    parts = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fps, radius=3):
    """Smallest index of each component, by brute force."""
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_simhash_classes(docs):
    named = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    rows = {r.doc_id: r for r in simhash.classes(named).collect()}
    fps = [fingerprint(t) for t in TEXTS]
    assert [rows[i].fp & (2**64 - 1) for i in range(len(TEXTS))] == fps
    assert [rows[i].component for i in range(len(TEXTS))] == linked(fps)


def test_links_find_all_within_the_radius(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT", 40)
    seeds = [R.getrandbits(64) for _ in range(25)]
    fps = sorted({s ^ sum({1 << R.randrange(64) for _ in range(R.randrange(5))}) for s in seeds for _ in range(8)} | {0, 2**64 - 1, 2**63})
    fps += [f for f in {(1 << a) | (1 << b) for a in range(20) for b in range(12)} if f not in fps]
    fps = sorted(set(fps), key=lambda f: f - (1 << 64) if f >> 63 else f)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for blocks in (4, 5):
        got = {r.node: r.root for r in components(simhash.links(df, 3, blocks)).collect()}
        want = linked(fps)
        signed = [f - (1 << 64) if f >> 63 else f for f in fps]
        assert [got.get(s, s) for s in signed] == [signed[w] for w in want]


def test_near_dedup_keeps_one(docs, empty):
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    texts = collections.Counter(r.text or "" for r in kept.collect())
    assert sum(texts[t] for t in (COPY, COPY + " more")) <= 2
    assert simhash.deduplicate(empty).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components(edges).collect()} == {0}
    assert components(edges).count() == 61


# ---- decontamination -------------------------------------------------------------------------

def phrase_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(text))


def brute_hits(texts, items, window):
    out = []
    for t in texts:
        w, hit, found = phrase_words(t), set(), set()
        for item, text in items:
            v = phrase_words(text)
            n = min(window, len(v))
            for i in range(max(len(v) - window, 0) + 1 if v else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[i : i + n]:
                        hit |= set(range(j, j + n))
                        found.add(str(item))
        out.append((len(w), len(hit), sorted(found)))
    return out


def test_decontamination(spark, docs):
    long = TEXTS[10].split()
    items = [(1, " ".join(long[100:125])), (2, "Two-words"), (3, None), (4, "..."), (5, " ".join(long[300:310]).upper()), (6, "never seen here"), (1, "one")]
    tests = decontamination.phrases(spark.createDataFrame(items, "item_id long, text string"), 6)
    index, terms = decontamination.build(docs, tests)
    got = decontamination.report(index, decontamination.search(index, terms, tests)).collect()
    rows = sorted((r.key is None, r.key or 0, r.n_words, r.n_hit, r.items) for r in got)
    source = docs.collect()
    want = brute_hits([r.text for r in source], items, 6)
    assert rows == sorted((r.doc_id is None, r.doc_id or 0, *w) for r, w in zip(source, want, strict=True))
    kept = decontamination.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), 6)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not w[1] for w in want)


def test_proximity_and_empty_tables(spark, docs, empty):
    items = spark.createDataFrame([("a", "red fox runs home")], "item_id string, text string")
    near = spark.createDataFrame([(1, "the red old fox runs home"), (2, "fox red home"), (3, "red fox runs home")], "doc_id long, text string")
    tests = decontamination.phrases(items)
    index, terms = decontamination.build(near, tests)
    found = lambda slack: {r.key for r in decontamination.report(index, decontamination.search(index, terms, tests, slack)).filter("contaminated").collect()}
    assert found(0) == {3} and found(1) == {1, 3}
    assert decontamination.decontaminate(empty, items).count() == 0
    assert decontamination.decontaminate(docs, items.limit(0)).count() == docs.count()


# ---- language models -------------------------------------------------------------------------

def kneser_ney(train, texts):
    """(tokens, known, base, score) of each text, with plain dictionaries."""
    end, start = object(), object()
    uni, pair = collections.Counter(), collections.Counter()
    for t in train:
        w = [*words(t), end]
        uni.update(w)
        pair.update(zip([start, *w[:-1]], w, strict=True))
    cont = collections.Counter(w for _, w in pair)
    after = collections.defaultdict(list)
    for (c, _), n in pair.items():
        after[c].append(n)

    def held(counts):
        a, b, c, d = (sum(n == i for n in counts) for i in (1, 2, 3, 4))
        if not min(a, b, c, d):
            return [0, 0.25, 0.5, 0.75]
        y = a / (a + 2 * b)
        return [0, *(min(max(x, 0), i) for i, x in ((1, 1 - 2 * y * b / a), (2, 2 - 3 * y * c / b), (3, 3 - 4 * y * d / c)))]

    dp, dw, total, v, types = held(pair.values()), held(cont.values()), sum(uni.values()), len(uni), sum(cont.values())
    rest = sum(dw[min(n, 3)] for n in cont.values())
    out = []
    for t in texts:
        w, base, score = [*words(t), end], 0.0, 0.0
        for c, x in zip([start, *w[:-1]], w, strict=True):
            base += np.log10((uni[x] + 0.1) / (total + 0.1 * (v + 1)))
            p = (max(cont[x] - dw[min(cont[x], 3)], 0) + rest / (v + 1)) / types if types else 1.0
            if after[c]:
                n = pair[c, x]
                p = (n - dp[min(n, 3)] + sum(dp[min(k, 3)] for k in after[c]) * p) / sum(after[c])
            score += np.log10(p)
        out.append((len(w), sum(uni[x] > 0 for x in w), base, score))
    return out


def test_lm_scores(spark, docs):
    train = docs.filter("doc_id % 3 != 0 or doc_id is null")
    model = lm.fit(train, shards=5)
    source = docs.collect()
    want = kneser_ney([r.text for r in train.collect()], [r.text for r in source])
    got = lm.score(docs, model, keep=["doc_id"]).collect()
    pairs = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in got))
    assert pairs == sorted((r.doc_id is None, r.doc_id or 0, n, k, round(b, 6), round(s, 6)) for r, (n, k, b, s) in zip(source, want, strict=True))
    assert model.n_tokens == sum(len(words(r.text)) + 1 for r in train.collect())


def test_lm_without_training_rows(docs, empty):
    model = lm.fit(empty)
    assert {(r.n_known, r.score) for r in lm.score(docs, model).collect()} == {(0, 0.0)}
    assert lm.score(empty, model).count() == 0


def test_a_very_long_word_and_parts():
    texts = ["a" * 10000 + " b", "b " + "a" * 10000, "é" * 5000]
    hashes = []
    for most in (10, 1 << 20):
        from flowtide.llm import tokens
        hashes.append([h for _, _, d, o in common.utf8_parts(pa.array(texts), most) for h in tokens.sentences(d, o)[0].tolist()])
    assert hashes[0] == hashes[1] and hashes[0][0] == hashes[0][4]


def test_quality_scores_and_filter(spark, docs, empty):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(4, 40)] + [(None, 1, 0), (2, 0, 0), (7, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality.judge(docs, labels, margin=0.0).collect()
    pool = [r for r in docs.collect() if r.doc_id is not None and 4 <= r.doc_id < 40 and r.doc_id != 7
            and hashlib.md5(str(r.doc_id).encode()).hexdigest() < "8"]
    pool += [r for r in docs.collect() if r.doc_id == 7 and hashlib.md5(b"7").hexdigest() < "8"]
    want = kneser_ney([r.text for r in pool], TEXTS)
    got = {r.key: r for r in rows if r.key is not None}
    for i in range(len(TEXTS)):
        assert got[i].tokens == want[i][0] and got[i].log10_perplexity == pytest.approx(-want[i][3] / want[i][0], abs=6e-5)
    good = quality.keep_good(docs, labels)
    assert good.columns == docs.columns and good.count() <= docs.count()
    clash = quality.keep_good(docs.withColumns({c: F.lit("own") for c in ("__key", "own", "kept", "threshold")}), labels)
    assert clash.filter("__key = 'own' and own = 'own' and kept = 'own'").count() == good.count() == clash.count()
    assert quality.keep_good(docs, labels.limit(0)).count() == docs.count()
    assert quality.keep_good(empty, labels).count() == 0


def test_quality_learns_from_long_texts_and_keeps_rare_languages(spark):
    words = ["the", "house", "of", "rain", "and", "hash", "one", "tree"]
    text = lambda: " ".join(R.choice(words) for _ in range(1500))
    rows = [(i, text(), "en") for i in range(150)]
    junk = [(1000, "zq xw vk jj " * 400, "en"), (1001, "zq xw vk jj " * 400, "xx"), (1002, "zq xw vk jj " * 400, None)]
    docs = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string")
    assert min(len(t) for _, t, _ in rows) > 5000
    labels = spark.createDataFrame([(i, 1, 0) for i in range(150)], "doc_id long, quality int, toxic int")
    got = {r.key: r for r in quality.judge(docs, labels).collect()}
    assert all(r.log10_perplexity is not None for r in got.values())
    assert all(got[i].kept for i in range(150)) and not got[1000].kept and not got[1002].kept
    assert got[1001].kept and got[1001].threshold is None
    # A small bound takes some of the documents only, whole ones.
    few = quality._taught(docs.withColumnRenamed("doc_id", "key").filter("key < 150"), 100_000)
    assert 5 < few.count() < 40 and few.filter("length(text) > 5000").count() == few.count()
    with pytest.warns(UserWarning, match="all documents are kept"):
        quality.judge(docs, labels.limit(0))


def test_quality_counts_all_trusted_texts_of_its_half(spark):
    """Many languages, so that an equal share of a bound would be less than the large one's texts."""
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(R.choice(words) for _ in range(900)), "en") for i in range(60)]
    rows += [(100 + i, f"rare{i} word", f"l{i}") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in rows], "doc_id long, quality int, toxic int")
    pool = [t for i, t, _ in rows if hashlib.md5(str(i).encode()).hexdigest() < "8"]
    want = kneser_ney(pool, [t for _, t, _ in rows])
    got = {r.key: r.log10_perplexity for r in quality.judge(docs, labels).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == pytest.approx(-s / n, abs=6e-5) for (i, _, _), (n, _, _, s) in zip(rows, want, strict=True))


# ---- language ID -----------------------------------------------------------------------------

def test_language_id(spark, empty):
    kinds = {"aa": ["bada", "daba", "abad"], "bb": ["milo", "limo", "olim"]}
    rows = [(i, " ".join(R.choice(kinds[k]) for _ in range(20)), k) for i in range(60) for k in kinds]
    rows += [(1000, None, "aa"), (1001, "12 !!", "bb"), (1002, "bada daba", None), (1003, "milo " * 40000, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(table)
    got = {(r.doc_id, r.lang): r for r in language_id.predict(table, model).collect()}
    assert all(r.lang_pred == lang and 0.5 < r.score <= 1 for (i, lang), r in got.items() if i < 60)
    assert [(got[i, lang].lang_pred, got[i, lang].score) for i, lang in ((1000, "aa"), (1001, "bb"))] == [("und", 0.0)] * 2
    assert got[1002, None].lang_pred == "aa" and got[1003, None].lang_pred == "bb"
    assert language_id.fit(empty) is None
    assert {r.lang_pred for r in language_id.predict(table, None).collect()} == {"und"}


def test_long_texts_count_as_one(monkeypatch):
    text = "straße und wasser " * 50
    whole = language_id.counts(text)
    monkeypatch.setattr(language_id, "PIECE", 7)
    assert all(np.array_equal(a, b) for a, b in zip(whole, language_id.counts(text), strict=True))


# ---- pieces ----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def content():
    with open(PIECES, "rb") as source:
        return source.read()


def test_pieces_equal_the_library_and_decode_back(content):
    codec, library = pieces.Codec(content), sentencepiece.SentencePieceProcessor(model_proto=content)
    for k in range(400):
        text = "".join(R.choice("abcdetheing  \n\t.,é梦x🙂") for _ in range(R.randint(0, 400 if k % 20 == 0 else 40)))
        ids = np.frombuffer(codec.encode(text), "<i4").tolist()
        assert ids == library.encode(text) and codec.decode(ids) == text
    long = "wordwithoutanyblank" * 500
    assert codec.search(" " + long) == library.encode(long)
    assert codec.decode(np.frombuffer(codec.encode("▁ ▁x"), "<i4").tolist()) == "▁ ▁x"


def test_scored_pieces_equal_brute_force(content):
    codec = pieces.Codec(content, merges=False)
    for _ in range(60):
        text = " " + "".join(R.choice("abcdetheing .é梦") for _ in range(R.randint(1, 120)))
        best = [(0.0, 0)] + [None] * len(text)
        for j in range(1, len(text) + 1):
            for i in range(max(0, j - codec.longest), j):
                found = codec.score.get(text[i:j])
                step = found[0] if found else codec.unknown if j - i == 1 else None
                if step is not None and (best[j] is None or best[i][0] + step > best[j][0]):
                    best[j] = best[i][0] + step, i
        cuts = [len(text)]
        while cuts[-1]:
            cuts.append(best[cuts[-1]][1])
        want = [x for b, a in zip(cuts[-2::-1], cuts[:0:-1], strict=True) for x in ([codec.score[text[a:b]][1]] if text[a:b] in codec.score else [codec.byte_id[y] for y in text[a:b].encode()])]
        assert codec.search(text) == want


def test_pieces_of_a_table(spark, docs, empty):
    model = pieces.load(spark, PIECES)
    rows = pieces.decode(pieces.encode(docs, model), model).collect()
    assert all(r.decoded == r.text and (r.ids is None) == (r.text is None) for r in rows) and len(rows) == docs.count()
    assert pieces.encode(empty, model).count() == 0
    at_once = pieces.encode(docs, model, decoded="decoded").collect()
    assert sorted(map(repr, at_once)) == sorted(map(repr, rows))


def test_searches_of_many_cuts_equal_those_of_one(content):
    for merges in (True, False):
        codec = pieces.Codec(content, merges)
        texts = list({" " + "".join(R.choice("abcdetheing.é梦🙂") for _ in range(R.randint(1, 40))) for _ in range(400)})
        found = [np.frombuffer(ids, "<i4").tolist() for ids in codec.search_many(texts)]
        assert found == [codec.search(text) for text in texts]


def test_every_cut_is_searched_by_windows(content, monkeypatch):
    codec, seen = pieces.Codec(content), []
    many, one = codec.search_many, codec.search
    monkeypatch.setattr(codec, "search_many", lambda texts: (seen.extend(texts), many(texts))[1])
    monkeypatch.setattr(codec, "search", lambda text: (seen.append(text), one(text))[1])
    codec.encode("some words and " + "x" * 90 + " words")
    assert sorted(seen) == sorted([" some", " words", " and", " " + "x" * 90])


def test_ids_that_are_no_text(content):
    codec = pieces.Codec(content)
    bad = codec.byte_id[0xC3]
    assert codec.decode([bad]) == "\ufffd" and codec.decode([-5, 10**6]) == ""
    rows = codec.decode_many(pa.array([[bad], None, [], [codec.byte_id[0xA9]], [codec.byte_id[0xC3], codec.byte_id[0xA9]]], pa.list_(pa.int32())))
    assert rows.to_pylist() == ["\ufffd", None, "", "\ufffd", "é"]
    split = codec.decode_many(pa.array([[codec.byte_id[0xC3]], [codec.byte_id[0xA9]]], pa.list_(pa.int32())))
    assert split.to_pylist() == ["\ufffd", "\ufffd"]


# ---- URLs and secrets ------------------------------------------------------------------------

def brute_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (low(m[1]), m[2]) if m else ("", "")
    fits = [r for r in URL_RULES if (host == (h := r.text.partition("/")[0]) or host.endswith("." + h)) and path.startswith("/" + r.text.partition("/")[2])]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_url_rules_and_trees(spark):
    urls = [None, "", "no scheme", "http://", "http://COM", "http://com/", "ftp://X.example.com/en/1?q#f", "http://www.example.com/en/", "http://m.www.example.com/en/x",
            "http://example.com/enx", "http://a.net/es/", "http://a.net/fr/1", "http://a.net/de/", "http://b.org/en/a://c/d", "x://notexample.com/en/"]
    urls += [f"https://site{i}.example.{'com' if i % 2 else 'net'}/{'en' if i % 3 else 'fr'}/{i}" for i in range(80)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rows = {r.page_id: r for r in url_filter.judge(pages, URL_RULES).collect()}
    assert len(rows) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule, verdict = brute_rule(url)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule)
        assert rows[i].verdict == verdict if verdict else rows[i].verdict in ("allow", "block")
    none = url_filter.judge(pages, []).collect()
    assert {r.verdict for r in none} == {"allow"}
    assert url_filter.judge(pages.limit(0), URL_RULES).count() == 0


def test_secrets(spark, empty):
    secret = lambda: "".join(R.choice("0123456789abcdef") for _ in range(39)) + "a"
    rows = [(i, f'some words token = "{secret()}" follow', "a/b.py") for i in range(40)] + [(100 + i, f"call {R.randrange(10**16, 10**17)} now", "a/b.py") for i in range(40)]
    rows += [(200, None, None), (201, "", "x"), (202, f'token = "{secret()}"', None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secret_scan.features(secret_scan.candidates(table), table)
    labelled = found.filter("key % 2 = 0").withColumn("label", secret_scan.assigned_name().cast("int"))
    got = {r.key: r.is_secret for r in secret_scan.scan(found, labelled).collect()}
    assert got == {i: i < 100 or i == 202 for i in [*range(40), *range(100, 140), 202]}
    alone = secret_scan.scan(found, labelled.limit(0)).collect()
    assert len(alone) == 81 and all(r.is_secret and r.probability is None for r in alone)
    assert secret_scan.candidates(empty).count() == 0


