"""Each operator against a brute-force version, a public library or a held-out set, and on odd input."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import models

from meshwright.llm import (
    byte_pairs,
    decontaminate,
    language_model,
    line_chunks,
    near_duplicates,
    quality_rules,
    queries,
    substrings,
    subword_classifier,
    token_counts,
    url_filters,
)
from meshwright.session import cut

WORDS = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id bigint, text string, n_words string, score int, __x double"
ODD = [
    (1, None, "x", 1, 0.5), (2, "", None, None, None), (3, " \n\t ", "y", 2, 1.0), (4, "one", "", 0, 0.0),
    (5, "İ Éa K ß " * 30, "a", 3, 2.0), (6, "same words here " * 2000, "b", 4, 3.0), (6, "same words here " * 2000, "b", 4, 3.0),
    (None, "no id " * 30, "c", 5, 4.0), (7, "x" * 50_000, "d", 6, 5.0), (8, "a\nb\n\nc\n" * 40, "e", 7, 6.0), (9, "a\nb\n\nc\n" * 40, "e", 7, 6.0),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(WORDS, text or "")


def prose(rng, n, names):
    return " ".join(rng.choice(names) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Texts with copies, near copies, shared passages and repeats inside a text."""
    rng = random.Random(5)
    names = [f"w{k}" for k in range(400)]
    base = [prose(rng, rng.randint(30, 120), names) for _ in range(40)]
    passage = prose(rng, 60, names)
    texts = list(base)
    texts += [base[0]] * 6 + [f"{base[1]} tail{k}" for k in range(12)] + [f"{prose(rng, 9, names)} {passage} {prose(rng, k, names)}" for k in range(12)]
    texts += [f"{passage} {passage}", f"{base[2]} {base[2]}", "", "only four words here", "only four words here", None]
    return list(enumerate(texts))


# Token counts

@pytest.mark.parametrize("seed", range(8))
def test_piece_counts_equal_a_public_word_piece_model(seed):
    rng = random.Random(seed)
    letters = "abcd"[:rng.randint(2, 4)]
    make = lambda n: {"".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(n)}
    for _ in range(10):
        first, rest = make(rng.randint(1, 12)), make(rng.randint(0, 12))
        vocabulary = {t: k for k, t in enumerate(["[UNK]", *first, *(f"##{x}" for x in rest)])}
        public = models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=1000)
        mine = token_counts.Automaton([x.encode() for x in first], [x.encode() for x in rest])
        for _ in range(60):
            word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 25)))
            assert mine.pieces(word.encode()) == len(public.tokenize(word)), (first, rest, word)


def test_token_counts_of_odd_rows(odd, none):
    got = token_counts.count_tokens(odd, queries.BYTE_RANKS).collect()
    assert len(got) == len(ODD) and [r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 3)] == [0, 0, 0]
    assert all(r["n_words"] == len(words(r["text"])) <= r["n_tokens"] for r in got)
    assert token_counts.count_tokens(none, queries.BYTE_RANKS).collect() == []


# Byte pairs

def test_encoding_equals_the_public_library():
    data = Path(queries.BYTE_RANKS).read_bytes()
    ranks = byte_pairs.read_ranks(data)
    assert ranks == {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    mine = byte_pairs.Encoder(ranks, public_tokenizers.PATTERN)
    rng = random.Random(3)
    letters = [chr(c) for c in [*range(0x180), 0x1680, 0x2003, 0x3000, 0x4E2D, 0x1F600, 0x301, 0x660, 0xFEFF]]
    texts = ["".join(rng.choice(letters) if rng.random() < 0.5 else rng.choice("ab ethn\n'") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    for text in [*texts, "ab" * 3000, "a" * 700, " " * 900, "的" * 400, "".join(rng.choice("abcé") for _ in range(20_000))]:
        assert mine.encode(text) == public.encode_ordinary(text)


def test_encoding_round_trips_and_refuses_foreign_ids(spark, odd, none):
    encoded = byte_pairs.encode(odd, queries.BYTE_RANKS, public_tokenizers.PATTERN)
    for r in byte_pairs.decode(encoded, queries.BYTE_RANKS).collect():
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    assert byte_pairs.decode(byte_pairs.encode(none, queries.BYTE_RANKS, public_tokenizers.PATTERN), queries.BYTE_RANKS).collect() == []
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_pairs.decode(spark.createDataFrame([([1, 10**6],)], "ids array<int>"), queries.BYTE_RANKS).collect()


# Quality classifier

def test_classifier_ranks_held_out_texts(spark):
    sf_dir = "/root/testdata/sf0.01"  # sf0.001 has 19 held-out labels
    rows = queries.op3_quality_classifier(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) >= 0.95


def test_classifier_on_odd_rows(spark, odd, none):
    shape = subword_classifier.Shape(bits=10)
    labels = spark.createDataFrame([(5, 1), (6, 0), (7, None), (8, 3)], "doc_id bigint, quality int")
    from pyspark.sql import functions as F
    model = subword_classifier.fit(odd, labels, F.lit(True), shape=shape)
    got = {(r["doc_id"], r["score"]) for r in subword_classifier.score(odd, model, shape=shape).collect()}
    assert len(got) == len(ODD) - 1 and all(0 <= s <= 1 for _, s in got)
    assert subword_classifier.score(none, model, shape=shape).collect() == []
    flat = subword_classifier.fit(odd, labels.where("quality = 1"), F.lit(True), shape=shape)
    assert {r["score"] for r in subword_classifier.score(odd, flat, shape=shape).collect()} == {0.5}


def test_word_features_equal_a_plain_loop():
    shape = subword_classifier.Shape(bits=12)
    both = subword_classifier.WordFeatures(["ab", "éü", "", "abab"], shape)
    for k, word in enumerate(["ab", "éü", "", "abab"]):
        alone = subword_classifier.WordFeatures([word], shape)
        assert sorted(both.buckets[both.owners == k]) == sorted(alone.buckets)
        assert len(alone.buckets) == 1 + sum(max(len(word) + 3 - n, 0) for n in (3, 4, 5))


# URL filters

URLS = [
    (1, "http://A.Example.NET/en/x?q#f", "example.net/en/", "allow"), (2, "http://example.net/fr/", "net/", "block"),
    (3, "http://a.example.com/de/x", "example.com/de/", "block"), (4, "http://my-example.com/de/", None, "allow"),
    (5, "https://x.org/fr/a", "org/fr/", "allow"), (6, "http://x.org/FR/a", None, "allow"), (7, None, None, "allow"),
    (8, "no scheme net/", None, "allow"), (9, "http://a.net?x/", None, "allow"), (10, "http://x.info/wp-login.php", None, "block"),
    (11, "http://10.0.0.1/a", None, "block"), (12, "", None, "allow"), (13, "http://casino.x.info/", None, "block"), (13, "http://casino.x.info/", None, "block"),
]


def test_url_filters(spark):
    pages = spark.createDataFrame([(a, b, "z") for a, b, _, _ in URLS], "page_id int, url string, verdict string")
    got = url_filters.judge_urls(pages).collect()
    assert sorted((r["page_id"], r["url"] or "", r["rule"] or "", r["verdict"]) for r in got) == sorted((a, b or "", c or "", d) for a, b, c, d in URLS)
    first = next(r for r in got if r["page_id"] == 1)
    assert (first["host"], first["path"]) == ("a.example.net", "/en/x")
    assert url_filters.judge_urls(pages.limit(0)).collect() == []
    assert {r["verdict"] for r in url_filters.judge_urls(pages, []).collect()} == {"allow"}


# Quality rules

def plain_statistics(text):
    w = words(text)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = {p for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_statistics_equal_plain_python(spark, odd, none, corpus):
    frame = spark.createDataFrame(corpus, "doc_id bigint, text string").unionByName(odd.select("doc_id", "text"))
    for r in quality_rules.text_statistics(frame).collect():
        assert tuple(r[c] for c in quality_rules.BASE_COLUMNS) == plain_statistics(r["text"])
    assert quality_rules.text_statistics(none).collect() == []


def test_rules_are_learned_and_ordered(spark, odd):
    good, bad = "plain words of prose follow one another here " , "sym### bols$$$ every%%% where&&& "
    rows = [(k, " ".join(f"{w}{k * j}" for j, w in enumerate((bad if k % 4 == 0 else good).split() * 6)), 0 if k % 4 == 0 else 1) for k in range(400)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    statistics = quality_rules.text_statistics(frame)
    rules = quality_rules.learn_rules(statistics)
    assert rules
    judged = quality_rules.apply_rules(statistics, rules).collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in judged]) > 0.99
    assert quality_rules.learn_rules(statistics.where("quality = 1")) == [] == quality_rules.learn_rules(statistics.limit(0))
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.apply_rules(quality_rules.text_statistics(odd, keep=["doc_id"]), []).collect()}
    assert not kept[1] and not kept[2] and kept[5] is False and len(kept) == len(ODD) - 1


# Language model

def test_language_model_counts_and_gain(spark, sf_dir):
    rows = queries.op6_language_model(spark, sf_dir).collect()
    docs = {r["doc_id"]: (r["text"] or "").encode().lower().split() + [b""] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in docs}
    counts = Counter(w for k, ws in docs.items() if not held[k] for w in ws)
    tokens, distinct = sum(counts.values()), len(counts)
    for r in rows:
        ws = docs[r["doc_id"]]
        base = sum(np.log10((counts[w] + 0.1) / (tokens + 0.1 * (distinct + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), sum(counts[w] > 0 for w in ws), tokens)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    unseen = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_language_model_is_a_distribution(spark):
    rng = random.Random(1)
    texts = [prose(rng, 30, [f"w{k * k % 90}" for k in range(90)]) for _ in range(200)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    model, counts = language_model.fit(frame, head=20)
    every = [bytes(r["token"]) for r in counts.collect()] + [b"never seen"]
    follow = {word: " ".join(w.decode() for w in (b"w1", b"w4", word) if w) for word in every}
    scored = language_model.score(spark.createDataFrame([(k, v) for k, v in enumerate(follow.values())], "doc_id int, text string"), model, counts)
    assert scored.count() == len(every)
    # The chance of each next word after the same two words sums to one.
    ids_starts = [language_model.read_ids(model, [v]) for v in follow.values()]
    total, seen = 0.0, {bytes(r["token"]): r["c"] for r in counts.collect()}
    for (word, _), (_, ids, starts) in zip(follow.items(), ids_starts, strict=True):
        at = 2
        features = language_model.context(ids, starts)
        kind, leaf = model.kind[ids], model.leaf[ids]
        (_, first, _), (_, second, _, which) = language_model.layers(model, features, kind, leaf)
        told = first[at] + (second[list(which).index(at)] if at in which else 0.0)
        share = 10 ** model.share[ids[at]] if word in model.vocabulary else (seen.get(word, 0) + 0.1) / (model.rare_tokens + 0.1 * (model.rare_distinct + 1))
        total += np.exp(told) * share
    assert total == pytest.approx(1, abs=1e-4)


def test_language_model_on_odd_rows(spark, odd, none):
    model, counts = language_model.fit(odd.select("text"), head=5, rounds=1)
    got = language_model.score(odd, model, counts).collect()
    assert len(got) == len(ODD) and all(r["n_tokens"] == len((r_text or "").encode().lower().split()) + 1 for r, r_text in
                                        zip(sorted(got, key=lambda r: (r["doc_id"] or 99, r["n_tokens"])), [x[1] for x in sorted(ODD, key=lambda x: (x[0] or 99, len(x[1] or "")))], strict=True))
    twins = [r for r in got if r["doc_id"] == 6]
    assert twins[0]["score"] == twins[1]["score"]
    empty, no_counts = language_model.fit(none.select("text"))
    assert {r["n_known"] for r in language_model.score(odd, empty, no_counts).collect()} == {0}


def test_language_model_sends_one_number_with_each_rare_word(spark):
    rng = random.Random(3)
    texts = [prose(rng, 40, [f"w{k}" for k in range(3000)]) for _ in range(60)]
    rows = [(k // 2 if k % 5 else None, t) for k, t in enumerate([*texts, *texts])]  # ids repeat with other texts, or are null
    frame = spark.createDataFrame(rows, "doc_id int, text string").repartition(7)
    model, counts = language_model.fit(frame.select("text"), head=5, rounds=1)
    scored = language_model.score(frame, model, counts)
    held = Counter(w for _, t in rows for w in [*t.encode().split(), b""])
    base = {t: sum(np.log10((held[w] + 0.1) / (model.tokens + 0.1 * (model.distinct + 1))) for w in [*t.encode().split(), b""]) for t in texts}
    want, got = Counter(k for k, _ in rows), scored.collect()
    assert Counter(r["doc_id"] for r in got) == want and all(r["n_known"] == 41 for r in got)
    assert np.allclose(sorted(r["base_score"] for r in got), sorted(base[t] for _, t in rows), rtol=1e-10, atol=0)
    assert len({r["score"] for r in got}) <= len(texts)  # equal texts score alike to the last bit
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    sums = re.findall(r"Aggregate \[(row#\d+L?)\], \[row#\d+L?, sum[^\n]* AS seen#\d+L, sum[^\n]* AS logs#\d+\]", plan)
    assert len(sums) == 1, plan


# Near duplicates

def test_near_duplicate_classes_equal_all_pairs(spark, corpus):
    frame = spark.createDataFrame(corpus, "doc_id bigint, text string")
    held = Counter()
    distinct = {t for _, t in corpus if words(t)}
    for t in distinct:
        held.update(set(near_duplicates.slots(near_duplicates.shingles(t, 5)[0]).tolist()))
    factors = np.ones(1 << near_duplicates.SLOT_BITS)
    for slot, n in held.items():
        factors[slot] = np.log1p(len(distinct) / n)
    weights = near_duplicates.Weights(factors)
    signed = {k: (lambda f: (f[0], weights.of(*f)))(near_duplicates.shingles(t, 5)) for k, t in corpus}
    parent = {k: k for k, _ in corpus}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for a, s in corpus:
        for b, t in corpus[:a]:
            if s is not None and (s == t or near_duplicates.weighted_jaccard(signed[a], signed[b]) >= 0.8):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates.near_duplicate_classes(frame).collect()}
    assert got == {k: find(k) for k, _ in corpus}
    assert {r["doc_id"] for r in near_duplicates.keep_one(frame).collect()} == {k for k, _ in corpus if find(k) == k}


def test_large_buckets_test_every_pair_of_different_classes(spark):
    """A hot bucket: one large class, and pairs of near copies that share nothing but the band."""
    rng = random.Random(8)
    names = [f"w{k}" for k in range(5000)]
    bases = [prose(rng, 60, names) for _ in range(9)]
    texts = [f"{bases[0]} tail{k}" for k in range(40)] + [f"{b} end{k}" for b in bases[1:] for k in range(2)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").withColumn("content", F.unhex(F.md5("text")))
    weights = spark.sparkContext.broadcast(near_duplicates.Weights({}))
    sizes = [float(near_duplicates.shingles(t, 5)[1].sum()) for t in texts]
    weight = spark.createDataFrame(list(enumerate(sizes)), "id bigint, weight double")
    buckets = cut(frame.join(weight, "id").select(F.lit(1).cast("bigint").alias("band"), "content", "id", "weight"))
    links, roots = near_duplicates._link(spark, buckets, frame.select("content", "text"), weights, 5, 0.8, 8)
    classes = {}
    for r in roots.join(frame, F.col("node") == F.col("content")).collect():
        classes.setdefault(bytes(r["root"]), set()).add(r["id"])
    assert sorted(map(sorted, classes.values())) == [list(range(40)), *[[40 + 2 * k, 41 + 2 * k] for k in range(8)]]


def test_boilerplate_below_a_quarter_of_the_documents_weighs_less(spark):
    """Both families agree alike word by word, but a passage in a tenth of all documents says less than one in two of them."""
    def numbered(name, n):
        return " ".join(f"{name}{k}" for k in range(n))

    passage = numbered("b", 60)
    rows = [*[f"{passage} " + numbered(f"own{k}x", 5) for k in range(10)],
            *[f"{numbered('near', 60)} " + numbered(f"end{k}x", 5) for k in range(2)], *[numbered(f"other{k}x", 65) for k in range(88)]]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(8)
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates.near_duplicate_classes(frame).collect()}
    assert got == {**{k: k for k in range(100)}, 11: 10}


def test_document_frequencies_count_equal_texts_once(spark):
    rows = [*[(k, "a b c d e") for k in range(6)], (None, "a b c d e"), (7, "a b c d e f"), (8, ""), (9, "v w x y z")]
    frame = spark.createDataFrame(rows, "id bigint, text string").repartition(4).withColumn("content", F.unhex(F.md5("text")))
    found = near_duplicates.inverse_frequencies(near_duplicates.shingle_sets(near_duplicates.one_of_equal(frame), 5))
    for text, n in (("a b c d e", 2), ("b c d e f", 1), ("v w x y z", 1)):
        assert found[near_duplicates.slots(near_duplicates.shingles(text, 5)[0])] == pytest.approx(np.log1p(3 / n))


def test_sampling_collides_like_weighted_jaccard():
    rng = np.random.default_rng(2)
    draw = near_duplicates.Sampler(4096)
    for _ in range(3):
        keys = np.sort(rng.integers(1, 1 << 62, 300).astype(np.uint64))
        a, b = rng.integers(0, 4, 300) * rng.choice([1.0, 0.4], 300), rng.integers(0, 4, 300) * 1.0
        one, two = (draw.samples(keys[w > 0], w[w > 0]) for w in (a, b))
        assert (one == two).mean() == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.04)


def test_near_duplicates_of_odd_rows(odd, none):
    got = near_duplicates.near_duplicate_classes(odd).collect()
    assert len(got) == len(ODD) and {r["class_id"] for r in got if r["doc_id"] in (8, 9)} == {8}
    assert len(near_duplicates.keep_one(odd).collect()) == len(ODD) - 2
    assert near_duplicates.near_duplicate_classes(none).collect() == []


# Benchmark decontamination

def test_decontamination_equals_brute_force(spark, odd, none):
    rng = random.Random(9)
    names = ["the", "of", *[f"W{k}" for k in range(60)], "Éa", "ée"]
    items = [(str(k), prose(rng, rng.choice([3, 12, 13, 14, 40]), names)) for k in range(12)] + [("12", None), ("13", " - "), ("14", "same words here")]
    docs = []
    for k in range(80):
        part = (items[k % 12][1] or "").split()
        a = rng.randint(0, max(0, len(part) - 13))
        docs.append((k, f"{prose(rng, rng.randint(0, 60), names)}. {' - '.join(part[a:a + rng.randint(10, 20)])} {prose(rng, rng.randint(0, 300), names)}"))
    fold = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)
    split = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (x or "").translate(fold))
    windows = {}
    for name, text in items:
        w = split(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add(name)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").unionByName(odd.select("doc_id", "text"))
    got = decontaminate.decontaminate(frame, spark.createDataFrame(items, "item_id string, text string")).collect()
    assert len(got) == len(docs) + len(ODD)
    for r in got:
        w, hit, found = split(r["text"]), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[k]
        assert (r["n_words"], r["n_hit"], r["item_ids"]) == (len(w), len(hit), sorted(found))
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(w))
    nothing = decontaminate.decontaminate(odd, spark.createDataFrame([], "item_id string, text string")).collect()
    assert len(nothing) == len(ODD) and not any(r["contaminated"] for r in nothing)
    assert decontaminate.decontaminate(none, spark.createDataFrame(items, "item_id string, text string")).collect() == []


def test_decontamination_finds_capital_sigma_beside_separators(spark):
    common = " ".join(f"w{k}" for k in range(12))
    docs = spark.createDataFrame([(1, f"{common} ΟΔΟΣ.gr"), (2, f"{common} Α.Σ.Β"), (3, common)], "doc_id int, text string")
    items = spark.createDataFrame([("a", f"{common} ΟΔΟΣ"), ("b", f"{common[3:]} Α Σ")], "item_id string, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.decontaminate(docs, items).collect()}
    assert got[1] == ["a"] and got[2] == ["b"] and not got[3]


def test_rows_without_ids_keep_their_own_places(spark):
    """Places are gathered by id and text: the lists of a thousand rows without an id stay as short as each text."""
    text = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(None, f"{text} own{k % 500}") for k in range(1000)] + [(7, text), (7, "other words")], "doc_id int, text string")
    items = spark.createDataFrame([("a", text)], "item_id string, text string")
    index = decontaminate.indexed_windows(docs, decontaminate.item_windows(items))
    found = decontaminate.find_windows(docs, index).select(F.size("places").alias("n")).collect()
    assert len(found) == 501 and {r["n"] for r in found} == {8}
    got = [(r["doc_id"], r["n_hit"]) for r in decontaminate.decontaminate(docs, items).collect()]
    assert Counter(got) == {(None, 20): 1000, (7, 20): 1, (7, 0): 1}


CLASHING = ["places", "key", "version", "w", "at", "word", "spans", "repeats", "content", "class_key", "__words", "__lines", "__ord", "__o", "__k", "__v",
            "__version", "__id", "__chunks", "__hits", "__text", "__kept_0", "hash", "root", "band"]


@pytest.mark.parametrize("work", [
    lambda d, items: decontaminate.decontaminate(d, items), lambda d, items: quality_rules.text_statistics(d),
    lambda d, items: substrings.drop_repeats(d), lambda d, items: line_chunks.drop_repeated_chunks(d)],
    ids=["decontaminate", "text_statistics", "drop_repeats", "drop_repeated_chunks"])
def test_columns_named_like_inner_ones_pass(spark, work):
    text = " ".join(f"w{k}" for k in range(30))
    rows = spark.createDataFrame([(1, f"{text}\nmore"), (1, f"{text}\nmore too"), (2, f"{text}\nmore"), (None, None)], "doc_id int, text string")
    wide = rows.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)])
    items = spark.createDataFrame([("a", text)], "item_id string, text string")
    plain, got = work(rows, items), work(wide, items)
    assert got.columns[:2 + len(CLASHING)] == wide.columns
    assert all(r[c] == k for r in got.collect() for k, c in enumerate(CLASHING))
    same = lambda frame: sorted(map(str, frame.select(*plain.columns).collect()))
    assert same(got) == same(plain)


# Substring dedup

def plain_substrings(rows):
    seen, found = set(), {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        covered = [False] * len(w)
        for k in range(len(w) - 19):
            if (t := tuple(w[k:k + 20])) in seen:
                covered[k:k + 20] = [True] * 20
            seen.add(t)
        found[key] = (len(w), sum(covered), " ".join(x for x, c in zip(w, covered, strict=True) if not c))
    return found


def test_substrings_equal_brute_force(spark, corpus):
    rng = random.Random(4)
    names = ["a", "b"]
    rows = [*corpus, *[(100 + k, prose(rng, 120, names)) for k in range(40)]]  # few words: every anchor is shared
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in substrings.drop_repeats(frame).collect()}
    assert got == plain_substrings(rows)


def test_substrings_of_odd_rows(spark, odd, none):
    got = substrings.drop_repeats(odd).collect()
    assert len(got) == len(ODD) and {r["text"] for r in got if r["doc_id"] in (1, 2, 3)} == {""}
    assert len({r["text"] for r in got if r["doc_id"] == 6}) == 1
    assert substrings.drop_repeats(none).collect() == []
    long = " ".join(f"w{k}" for k in range(40))
    shared = spark.createDataFrame([(1, long), (1, f"{long} x"), (2, long)], "doc_id int, text string")
    assert sorted(r["n_removed"] for r in substrings.drop_repeats(shared).collect()) == [0, 40, 40]


def test_repeated_rows_that_copy_an_earlier_document_stay_as_many(spark):
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(1, long), *[(2, f"{long} more")] * 3, *[(3, long)] * 2]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    got = sorted((r["doc_id"], r["n_removed"], r["text"]) for r in substrings.drop_repeats(frame).collect())
    assert got == [(1, 0, long), *[(2, 40, "more")] * 3, *[(3, 40, "")] * 2]


# Line dedup

def plain_pieces(lines, hash_of, span=2, spacing=8, most=16):
    """All runs of worded lines of which one end is a boundary and none inside."""
    worded = [k for k, line in enumerate(lines) if line.strip()]
    edge, last = set(), 0
    for i in range(len(worded)):
        rolled = 0
        for k in worded[max(0, i - span + 1):i + 1]:
            rolled = (rolled * line_chunks.ODD + hash_of(lines[k].encode())) % 2**64
        if (rolled // 2**40) % spacing or i in (0, len(worded) - 1) or i - last >= most:
            edge.add(i)
            last = i
    return [(worded[i], worded[j] + 1) for i in range(len(worded)) for j in range(i + 1, min(len(worded), i + most + 1))
            if (i in edge or j in edge) and not edge & set(range(i + 1, j))]


def plain_lines(rows, hash_of=line_chunks.line_hash):
    seen, found = set(), {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        lines, gone = (text or "").split("\n"), set()
        for a, b in plain_pieces(lines, hash_of):
            chunk = "\n".join(lines[a:b])
            if chunk in seen:
                gone.update(range(a, b))
            seen.add(chunk)
        if gone and not any(x.strip() for k, x in enumerate(lines) if k not in gone):
            gone = set(range(len(lines)))
        found[key] = (len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone) if text is not None else None)
    return found


@pytest.mark.parametrize("weak", [False, True])
def test_line_chunks_equal_brute_force(spark, weak):
    rng = random.Random(6)
    lines = [prose(rng, 4, [f"w{k}" for k in range(50)]) for _ in range(60)] + ["", " "]
    block = [lines[k] for k in range(20)]
    rows = [(k, "\n".join([rng.choice(lines) for _ in range(k % 7)] + (block if k % 3 else []) + [rng.choice(lines) for _ in range(k % 5)])) for k in range(60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    # With a hash that always collides, the comparison of bytes must keep different chunks.
    chunk_hash_of = (lambda chunk: b"same") if weak else line_chunks.chunk_hash
    got = {r["doc_id"]: (r["n_removed"], r["text"]) for r in line_chunks.drop_repeated_chunks(frame, chunk_hash_of=chunk_hash_of).collect()}
    assert got == plain_lines(rows)
    assert sum(g[0] for g in got.values()) > 200


def test_chunks_resist_shifts():
    lines = [hashlib.md5(str(k).encode()).hexdigest() for k in range(400)]
    whole = {tuple(lines[a:b]) for a, b in line_chunks.chunk_lines(lines)}
    moved = ["x", "y", *lines[:200], "z", *lines[200:]]
    assert len(whole & {tuple(moved[a:b]) for a, b in line_chunks.chunk_lines(moved)}) > 0.9 * len(whole)


def test_line_chunks_of_odd_rows(odd, none):
    got = line_chunks.drop_repeated_chunks(odd).collect()
    assert len(got) == len(ODD) and [r["text"] for r in got if r["doc_id"] in (1, 2)] in ([None, ""], ["", None])
    assert len({r["n_removed"] for r in got if r["doc_id"] == 6}) == 1
    assert sum(r["n_removed"] for r in got if r["doc_id"] == 9) > sum(r["n_removed"] for r in got if r["doc_id"] == 8)
    assert line_chunks.drop_repeated_chunks(none).collect() == []


def test_chunks_match_to_the_line_where_texts_part():
    lines = [hashlib.md5(str(k).encode()).hexdigest() for k in range(300)]
    found, wanted = 0, 0
    for start in range(0, 290, 7):
        for length in (2, 3, 5):
            run = lines[start:start + length]
            one, other = (["u1", "v1", "w1", *run, "x1", "y1"], ["u2", *run, "x2", "y2", "z2"])
            pieces = {"\n".join(one[a:b]) for a, b in line_chunks.chunk_lines(one)}
            same = [(a, b) for a, b in line_chunks.chunk_lines(other) if "\n".join(other[a:b]) in pieces]
            covered = {k for a, b in same for k in range(a, b)}
            assert covered <= set(range(1, 1 + length))
            found += covered == set(range(1, 1 + length))
            wanted += 1
    assert found >= 0.95 * wanted


def test_long_texts_without_boundaries_have_few_pieces():
    pieces = line_chunks.chunk_lines(["same"] * 20_000, hash_of=lambda line: 0)
    assert len(pieces) < 40_000 and max(b - a for a, b in pieces) <= 17


def test_chunks_find_nearly_all_repeated_lines(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    runs, chunks = ({r["doc_id"]: r["n_removed"] for r in drop(docs).collect()} for drop in (line_chunks.drop_repeated_runs, line_chunks.drop_repeated_chunks))
    assert all(n <= runs[key] for key, n in chunks.items())
    assert sum(chunks.values()) >= 0.98 * sum(runs.values())


def plain_runs(rows):
    """Grows every run of lines that also starts earlier to its full length; one of two worded lines or more goes."""
    earlier, found = [], {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        lines = (text or "").split("\n")
        earlier.append(lines)
        gone = set()
        for a in range(len(lines)):
            for other in earlier:
                for b in range(a if other is lines else len(other)):
                    n = 0
                    while a + n < len(lines) and b + n < len(other) and lines[a + n] == other[b + n]:
                        n += 1
                    worded = [k for k in range(a, a + n) if lines[k].strip()]
                    if len(worded) > 1:
                        gone.update(range(worded[0], worded[-1] + 1))
        if gone and not any(x.strip() for k, x in enumerate(lines) if k not in gone):
            gone = set(range(len(lines)))
        found[key] = (len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone) if text is not None else None)
    return found


@pytest.mark.parametrize("weak", [False, True])
def test_line_runs_equal_brute_force(spark, weak):
    """The query's operator finds short runs too, whatever their neighbours are."""
    rng = random.Random(7)
    lines = [prose(rng, 4, [f"w{k}" for k in range(50)]) for _ in range(40)] + ["", " "]
    rows = [(k, "\n".join([f"only {k}", *(rng.choice(lines) for _ in range(k % 9)), f"end {k}"])) for k in range(60)]
    rows += [(60 + k, "\n".join([f"before {k}", *lines[10:10 + 2 + k % 3], f"after {k}"])) for k in range(12)]
    rows += [(80, None), (81, ""), (82, "a\na\na"), (83, "\n".join(lines[10:14]) + "\n\n")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    options = {"pair_hash": lambda pair: b"same"} if weak else {}
    got = {r["doc_id"]: (r["n_removed"], r["text"]) for r in line_chunks.drop_repeated_runs(frame, **options).collect()}
    assert got == plain_runs(rows)


def test_line_query_removes_runs_of_two_lines(spark, tmp_path):
    rows = [(k, f"before {k}\none two\nthree four\nafter {k}") for k in range(20)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["n_removed"] for r in queries.op10_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {k: 2 if k else 0 for k in range(20)}
