"""Phrase collocations, centroid clusters and Hamming components against plain versions, and on odd input."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from meshwright.llm import collocations, hadamard_centroids, hamming_trees

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Phrase collocations

def plain_phrases(rows, longest=3, least=10, top=2000, inside=50):
    """The contract, word for word, on (lang, text) rows."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(AZ)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            totals[lang] += len(w)
            for size in range(1, longest + 1):
                counts.update((lang, tuple(w[i:i + size])) for i in range(len(w) - size + 1))
    found = {}
    for (lang, w), a in counts.items():
        if len(w) >= 2 and a >= least:
            cuts = [(10**6 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found[lang, w] = (a, counts[lang, w[:k]], counts[lang, w[k:]], score)
    kept = {}
    for (lang, w), values in found.items():
        covered = any(100 * v[0] >= inside * values[0] and any(x[i:i + len(w)] == w for i in range(len(x) - len(w) + 1))
                      for (other, x), v in found.items() if other == lang and len(x) > len(w))
        if not covered:
            kept.setdefault(lang, []).append((-values[3], -values[0], " ".join(w).encode(), values))
    out = []
    for lang, rows in kept.items():
        for rank, (_, _, phrase, (a, left, right, score)) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, totals[lang], score))
    return sorted(out)


def mined(spark, rows, top=2000, longest=3, **options):
    frame = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)], "doc_id bigint, text string, lang string").repartition(3)
    got = collocations.collocations(*collocations.mine_phrases(frame, longest=longest, **options), top=top)
    return sorted(tuple(r) for r in got.collect())


@pytest.fixture(scope="module")
def chatter():
    rng = random.Random(11)
    names = [f"w{k}" for k in range(25)] + ["É", "Ab", "ab", "\x01", "的"]
    ends = [".", ",", " ! ", "\n", "\t", " ", "  ", "\x0b", ";"]
    make = lambda: "".join(rng.choice(names) + (rng.choice(ends) if rng.random() < 0.3 else " ") for _ in range(rng.randint(0, 60)))
    rows = [(rng.choice(["en", "fr", None, "und", ""]), make()) for _ in range(120)]
    return rows + [("en", "New York City rocks. " * 30), ("en", "new york ends, " * 4), ("en", None), ("en", ""), (None, "?!."), ("fr", "a a a a a a a a a a a a")]


@pytest.mark.parametrize(("share", "longest"), [(0.125, 3), (1.0, 3), (0.0, 3), (0.02, 4), (0.5, 2)])
def test_phrases_equal_a_plain_version_whatever_the_sample(spark, chatter, share, longest):
    assert mined(spark, chatter, share=share, longest=longest) == plain_phrases(chatter, longest=longest)


def test_phrases_keep_the_first_of_each_language(spark, chatter):
    assert mined(spark, chatter, top=7) == plain_phrases(chatter, top=7)


def test_texts_cut_in_pieces_and_blocks_keep_their_phrases(monkeypatch, spark):
    rng = random.Random(2)
    text = " ".join(rng.choice(["a", "bb", "ccc", "d,", "e\n"]) for _ in range(3000))
    body = [text.encode(), b"x" * 500, b"a bb", None, b""]
    whole = [w for words in collocations.text_words(body) for w in words]
    want = plain_phrases([("en", t.decode() if t else None) for t in body])
    monkeypatch.setattr(collocations, "PIECE", 64)
    assert [w for words in collocations.text_words(body) for w in words] == whole
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 50)
    counts = Counter()

    class Frame:  # runs the task function here, with the small limits
        sparkSession = spark

        def mapInArrow(self, function, schema):
            import pyarrow as pa
            batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(body)), pa.array(body, pa.binary())], names=["lang", "body"])
            for part in function(iter([batch])):
                for r in part.to_pylist():
                    counts[r["phrase"]] += r["n"]
            return spark.createDataFrame([], schema)

    collocations.count_phrases(Frame(), 3)
    for _, _, phrase, a, *_ in want:
        assert counts[phrase] == a


def test_failed_borders_are_counted_in_an_expansion(spark):
    rows = [("en", "rare pair here")] * 12 + [("en", "other words")] * 3
    frame = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)], "doc_id bigint, text string, lang string")
    found, totals = collocations.mine_phrases(frame, share=0.0)
    assert {(r["phrase"], r["n"]) for r in found.collect()} == {
        (p, 12) for p in ("rare", "pair", "here", "rare pair", "pair here", "rare pair here")}
    assert [tuple(r) for r in totals.collect()] == [("en", 42)]


def test_phrase_maps_hold_what_was_put_in(spark):
    phrases = [("en", "a"), ("en", "a b"), ("fr", "a b"), ("en", "b a c")] + [("de", f"x{k} y{k}") for k in range(300)]
    made = collocations.bit_map(spark.createDataFrame(phrases, "lang string, phrase string"), len(phrases))
    import pyarrow as pa
    assert made.has(collocations.phrase_hashes([p[0] for p in phrases], pa.array([p[1] for p in phrases]))).all()
    other = collocations.phrase_hashes(["en"] * 1000, pa.array([f"q{k} r" for k in range(1000)]))
    assert made.has(other).mean() < 0.01


def test_phrases_of_odd_tables(spark):
    schema = "doc_id bigint, text string, lang string, phrase string, n int, a double, score string, rank int, l int"
    assert collocations.collocations(*collocations.mine_phrases(spark.createDataFrame([], schema))).collect() == []
    rows = [(None, "No Id! " * 12, None, "x", 1, 1.0, "s", 1, 2), (None, "No Id! " * 12, None, "x", 1, 1.0, "s", 1, 2), (1, None, "en", None, None, None, None, None, None)]
    got = collocations.collocations(*collocations.mine_phrases(spark.createDataFrame(rows, schema))).collect()
    assert [tuple(r) for r in got] == [("und", 1, "no id", 24, 24, 24, 48, 10**6)]


def test_scores_pass_64_bits_exactly(spark):
    a, left, right = 3 * 10**9 + 7, 5 * 10**9 + 1, 4 * 10**9 + 3
    frequent = spark.createDataFrame([("en", 1, "x", left), ("en", 1, "y", right), ("en", 2, "x y", a)], "lang string, size int, phrase string, n bigint")
    totals = spark.createDataFrame([("en", 10**11)], "lang string, n bigint")
    got = collocations.collocations(frequent, totals).collect()
    assert [r["score"] for r in got] == [10**6 * a * a // (left * right)]


# Centroid clusters

def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, tuple(math.floor(64 * float(x)) for x in v)) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cents = [list(v) for _, v in first]
    gap = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min((gap(v, c), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        owners = [near(v)[1] for _, v in kept]
        for n in range(len(cents)):
            own = [v for (_, v), o in zip(kept, owners, strict=True) if o == n]
            if own:
                cents[n] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return sorted((-1 if i is None else i, near(v)[1], near(v)[0]) for i, v in kept), cents


def test_transform_is_exact_and_keeps_distances():
    rng = np.random.default_rng(1)
    v = rng.integers(-1000, 1000, (20, 64))
    moved = hadamard_centroids.walsh_hadamard(v)
    signs = np.array([[(-1) ** int(a & b).bit_count() for b in range(64)] for a in range(64)])
    assert (moved == (v @ signs)[:, hadamard_centroids.sequency_order()]).all()
    assert (((moved[:10] - moved[10:]) ** 2).sum(1) == 64 * ((v[:10] - v[10:]) ** 2).sum(1)).all()
    changes = (np.diff(signs[hadamard_centroids.sequency_order()], axis=1) != 0).sum(1)
    assert changes.tolist() == list(range(64))


@pytest.mark.parametrize("kind", [np.int64, object])
def test_search_equals_all_comparisons_and_eliminates(kind):
    rng = np.random.default_rng(2)
    cents = rng.integers(-300, 300, (16, 64))
    cents[5] = cents[3]  # a tie
    points = np.concatenate([cents[rng.integers(0, 16, 300)] + rng.integers(-20, 20, (300, 64)), rng.integers(-5, 5, (50, 64)), cents])
    all_gaps = ((points[:, None, :] - cents[None]) ** 2).sum(2)
    near, gap, finished = hadamard_centroids.search(points.astype(kind), cents.astype(kind))
    assert (near == all_gaps.argmin(1)).all() and (gap == all_gaps.min(1)).all()
    assert finished < len(points) * 16 // 2
    flat = hadamard_centroids.search(np.zeros((4, 64), kind), np.zeros((3, 64), kind))
    assert flat[0].tolist() == [0] * 4 and len(hadamard_centroids.search(np.zeros((0, 64), kind), cents.astype(kind))[0]) == 0


@pytest.mark.parametrize("size", [0, 3, 200])
def test_clusters_equal_a_plain_version(spark, size):
    rng = random.Random(size)
    middle = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    rows = [(k, [x + rng.gauss(0, 0.3) for x in rng.choice(middle)]) for k in range(size)]
    rows += [rows[0], rows[0]] if rows else []
    rows += [(None, [0.5] * 64)] if rows else []
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 63 + [None]), (904, [math.nan] * 64), (905, [math.inf] + [0.0] * 63), (906, [1.0] * 65)]
    frame = spark.createDataFrame([(i, v, 7, 8) for i, v in rows], "vec_id bigint, embedding array<double>, cluster int, distance int").repartition(3)
    assigned, cents = hadamard_centroids.cluster(frame)
    got = hadamard_centroids.with_inertia(assigned).collect()
    want, plain = plain_clusters(rows)
    assert cents == plain
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"]) for r in got) == want
    for r in got:
        assert r["inertia"] == sum(w[2] for w in want)
        assert r["cluster_inertia"] == sum(w[2] for w in want if w[1] == r["cluster"])


def test_clusters_of_huge_components_and_of_rows_without_ids(spark):
    rows = [(k, [float(s * 10**9 * (k + 1))] * 64) for k, s in enumerate([1, -1, 1, -1])] + [(9, [1e300] * 64), (10, [-1e300] * 64)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: (r["cluster"], r["distance"]) for r in hadamard_centroids.cluster(frame, k=2)[0].collect()}
    assert len(got) == 6 and all(d is not None and d >= 0 for _, d in got.values())
    lost = hadamard_centroids.with_inertia(hadamard_centroids.cluster(spark.createDataFrame([(None, [1.0] * 64)], "vec_id bigint, embedding array<double>"))[0])
    assert [tuple(r) for r in lost.collect()] == [(None, None, None, None, None)]


# Hamming components

def plain_fingerprint(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(AZ)) if x]
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(points, radius=4):
    """Smallest reachable index of each 64-bit point, over all pairs."""
    parent = list(range(len(points)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    array = np.array(points, np.uint64)
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= radius):
            a, b = top(i), top(int(j))
            parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(points))]


def test_fingerprints_equal_a_plain_version(monkeypatch):
    rng = random.Random(3)
    names = ["A", "b", "É", "的", "\x1c", "word", "X" * 40]
    texts = [None, "", " \t\n", "One", "one TWO three", "a b c d"] + ["".join(rng.choice(names) + rng.choice(" \t\n\x0b\x0c\r") for _ in range(rng.randint(1, 200))) for _ in range(40)]
    for text in texts:
        assert hamming_trees.fingerprint(text) == plain_fingerprint(text)
    monkeypatch.setattr(hamming_trees, "PIECE", 37)
    for text in texts:
        assert hamming_trees.fingerprint(text) == plain_fingerprint(text)


def families(rng, groups, size, flips):
    """Random points, and families that wander away from a centre step by step."""
    points = [rng.getrandbits(64) for _ in range(400)]
    for _ in range(groups):
        at = rng.getrandbits(64)
        for _ in range(size):
            for _ in range(flips):
                at ^= 1 << rng.randrange(64)
            points.append(at)
    return points


@pytest.mark.parametrize(("groups", "size", "flips", "fanout"), [(20, 30, 4, 3), (1, 2500, 1, 2), (3, 500, 3, 5), (40, 10, 6, 3)])
def test_components_over_many_shards_equal_all_pairs(spark, groups, size, flips, fanout):
    points = sorted(set(families(random.Random(size), groups, size, flips)))
    want = plain_components(points)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in points], "fp bigint").repartition(3)
    got = {r["fp"] % (1 << 64): r["component"] for r in hamming_trees.components(frame, shards=24, visits=700, fanout=fanout).collect()}
    assert set(got) == set(points)
    groups_of = lambda labels: {frozenset(p for p, x in zip(points, labels, strict=True) if x == y) for y in set(labels)}
    assert groups_of([got[p] for p in points]) == groups_of(want)


def test_a_tree_keeps_every_neighbour_and_prunes_others():
    rng = random.Random(4)
    points = np.array(families(rng, 10, 100, 2), np.uint64)
    tree = hamming_trees.Tree(points, 50)
    homes = {int(i): leaf for leaf, index in tree.visits(points, 0) for i in index}
    asked = {}
    for leaf, index in tree.visits(points, 4):
        for i in index:
            asked.setdefault(int(i), set()).add(leaf)
    assert sorted(homes) == list(range(len(points))) and tree.size > 8
    for i in range(len(points)):
        assert {homes[int(j)] for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 4)} <= asked[i]
    assert sum(map(len, asked.values())) < 0.9 * len(points) * tree.size
    alike = hamming_trees.Tree(np.array([1 << k for k in range(64)], np.uint64), 4)  # all at the same distance
    assert alike.size > 1


def test_documents_get_the_smallest_reachable_id(spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(30)]
    texts = [*base, *base[:5], *(f"{t} tail" for t in base[5:15]), "", None, "", "one", "ONE"]
    rows = [(1000 - k, t, "x", 1) for k, t in enumerate(texts)] + [(None, base[0], "y", 2), (7, base[1], "z", 3), (7, base[1], "z", 3)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, fp string, component int").repartition(3)
    got = hamming_trees.near_duplicates(frame).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "fp", "component", "fingerprint", "component_id"}
    points = [plain_fingerprint(r["text"]) for r in got]
    assert [r["fingerprint"] for r in got] == [f"{p:016x}" for p in points]
    labels = plain_components(points)
    least = {}
    for r, label in zip(got, labels, strict=True):
        if r["doc_id"] is not None:
            least[label] = min(least.get(label, 1 << 60), r["doc_id"])
    assert [r["component_id"] for r in got] == [least[x] for x in labels]
    none = hamming_trees.near_duplicates(frame.where(F.lit(False)))
    assert none.collect() == []
