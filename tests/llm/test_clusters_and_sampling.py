"""Centroid clusters, spot signatures, radix ranks and importance resampling against brute force and SQL, with edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import re

from footfall.llm import importance, radix_rank
from footfall.llm.centroid_clusters import VantageTree, centroid_clusters, squares
from footfall.llm.queries import oracle_sql, queries
from footfall.llm.spot_signatures import (
    ANCHORS,
    CHAIN,
    codes_of,
    edited,
    fingerprint,
    fingerprints_after_edit,
    followed,
    likeness,
    signatures,
)
from tests.comparing import difference, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "benchmark")


@pytest.mark.parametrize("name", ["op11_centroid_clusters", "op12_spot_signatures", "op13_importance_resampling"])
def test_queries_equal_their_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    rows = queries()[name](spark, FOLDER)
    columns, wanted = sql_rows(connection, oracle_sql()[name])
    assert columns == sorted(rows.columns) and wanted
    assert difference(spark_rows(rows), wanted) == ""


# Centroid clusters


@pytest.mark.parametrize("most", [2, 300, 2**24, 2**40, 2**62])
def test_tree_finds_the_nearest_and_of_equals_the_smallest_number(most):
    draw = np.random.default_rng(most)
    for count in (1, 2, 5, 40, 150):
        centroids = draw.integers(-most, most, (count, 3))
        centroids[count // 2 :: 3] = centroids[0]  # equal centroids
        vectors = np.concatenate([draw.integers(-most, most, (60, 3)), centroids])
        labels, away = VantageTree(centroids).nearest(vectors)
        for vector, label, distance in zip(vectors.tolist(), labels, away, strict=True):
            exact = [sum((x - c) ** 2 for x, c in zip(vector, one)) for one in centroids.tolist()]
            assert (int(distance), int(label)) == min((d, i) for i, d in enumerate(exact))


def test_tree_leaves_nodes_unopened(monkeypatch):
    """Well parted centroids: most distances are never computed."""
    looked = []
    monkeypatch.setattr("footfall.llm.centroid_clusters.squares", lambda x, c: (looked.append(len(x) * len(c)), squares(x, c))[1])
    centroids = np.array([[1000 * i, 1000 * j] for i in range(12) for j in range(12)])
    tree = VantageTree(centroids)
    looked.clear()
    tree.nearest(np.repeat(centroids, 5, axis=0) + 3)
    assert sum(looked) < 720 * 144 / 3


def brute_clusters(rows, clusters, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted(((hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "~", v) for i, v in kept))
    centroids = [list(v) for _, v in named[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, members in groups.items():
            centroids[n] = [sum(column) // len(members) for column in zip(*members)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, n, d in found:
        inertia[n] += d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, n, d, inertia[n], sum(inertia.values()), digests[n]) for i, n, d in found)


def test_clusters_against_brute_force(spark):
    draw = random.Random(5)
    rows = [(i, [draw.gauss(i % 4, 0.3) for _ in range(6)]) for i in range(200)]
    rows += [(i, rows[0][1]) for i in range(200, 290)]  # a third of all rows the same
    rows += [(None, rows[3][1]), (None, [9.0] * 6), (7, rows[8][1]), rows[5], rows[5]]
    rows += [(400, None), (401, [1.0, None] * 3), (402, [math.nan] * 6), (403, [math.inf] * 6), (404, [1.0]), (405, [])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, v int")
    got = centroid_clusters(table, clusters=9, rounds=3, dims=6)
    assert Counter(tuple(r) for r in got.collect()) == brute_clusters(rows, 9, 3, 6)
    # Fewer vectors than clusters; nothing at all; nothing that takes part.
    few = rows[:4] + rows[290:292]
    got = centroid_clusters(spark.createDataFrame(few, "vec_id long, embedding array<double>"), dims=6)
    assert Counter(tuple(r) for r in got.collect()) == brute_clusters(few, 40, 5, 6)
    assert centroid_clusters(table.limit(0), dims=6).count() == 0
    assert centroid_clusters(table.filter("vec_id >= 400"), dims=6).count() == 0


def test_distances_beyond_64_bits_are_null_and_still_exact(spark):
    rows = [(1, [0.0, 0.0]), (2, [3e15, 0.0]), (3, [3e15, 1.0]), (4, [1e300, 0.0]), (5, [-3e15, 2e15])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    wanted = brute_clusters(rows[:3] + rows[4:], 2, 2, 2)
    got = centroid_clusters(table, clusters=2, rounds=2, dims=2).collect()
    small = lambda x: x if x < 2**63 else None
    assert Counter(tuple(r) for r in got) == Counter((i, n, small(d), small(c), small(w), s) for i, n, d, c, w, s in wanted.elements())
    assert any(r["distance"] is None for r in got)


# Spot signatures


def plain_signatures(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    found = set()
    for at, word in enumerate(words):
        after = [w for w in words[at + 1 :] if w not in ANCHORS][:CHAIN]
        if word in ANCHORS and len(after) == CHAIN:
            found.add(" ".join([word, *after]))
    if not found:
        found = {" ".join(words)} if words else {" " + text} if text else set()
    return {hashlib.md5(each.encode()).digest()[:6] for each in found}


TEXTS = ["", " ", "!?", "The", "the one", "THE one two three", "the of one two three four", "für Ä b c", "日本語 の テキスト", "x" * 5000, "a1 the 2 3 4 5 \x00 the\tq"]


def test_signatures():
    draw = random.Random(6)
    texts = TEXTS + [" ".join(draw.choices([*ANCHORS[:6], "One,", "two", "drei-vier", "É", "9"], k=draw.randint(1, 60))) for _ in range(200)]
    for text in texts:
        found = signatures(text)
        assert found == plain_signatures(text), text
        assert codes_of(fingerprint(found)) == found
    assert signatures("Of the cat, dog and bird") == signatures("of THE cat dog AND bird")


def test_likeness_is_pruned_by_lengths_only_below_the_least():
    draw = random.Random(7)
    for _ in range(300):
        left, right = ({bytes([draw.randint(0, 30)]) for _ in range(draw.randint(0, 25))} for _ in range(2))
        exact = len(left & right) / len(left | right) if left | right else 1.0
        assert likeness(left, right) == exact
        pruned = likeness(left, right, 0.8)
        assert pruned == exact or exact < 0.8 and pruned == 0.0
    assert likeness({b"a"}, {b"a", b"b", b"c"}, 0.8) == 0.0


def neighbours(rows):
    """Rows with a later one that follows them: by id, without id first, equal ids by text in an order that any hash may give."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_fingerprints_after_edit_against_brute_force(spark):
    draw = random.Random(8)
    words = [*ANCHORS[:8], *(f"w{i}" for i in range(40))]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(0, 90)))) for i in draw.sample(range(-500, 500), 150)]
    rows += [(1000 + i, text) for i, text in enumerate(TEXTS)] + [(2000, None), (2001, "the " + "a b c " * 40000), (None, "no id")]
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, number string, extra int")
    order = neighbours(rows)
    expected = []
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        own, new, following = plain_signatures(text) if len(text) < 9999 else signatures(text), signatures(changed), signatures(after)
        jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        expected.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprint(own), fingerprint(new), jaccard(own, new), jaccard(own, following)))
    for ranges in (1, 5, 40):
        got = fingerprints_after_edit(table.repartition(6), ranges)
        assert Counter(tuple(r) for r in got.collect()) == Counter(expected)
    assert fingerprints_after_edit(table.limit(0)).count() == 0
    alone = fingerprints_after_edit(table.filter("doc_id = 1005")).first()
    assert alone["near_next"] == 1.0 and alone["n_chars"] == 17


def test_rows_of_one_id_are_spread_and_each_follows_another(spark):
    """An id, and one text of it, in most rows: the ranges stay even, and every row has one that follows it."""
    rows = [(7, "same text")] * 300 + [(7, f"text {i}") for i in range(100)] + [(None, f"none {i}") for i in range(100)] + [(9, "last")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()
    parts = followed(table, 10).rdd.mapPartitions(lambda part: [[(r["doc_id"], r["text"], r["extra"]) for r in part]]).collect()
    assert max(len(part) for part in parts) < 150
    assert all(not r[2] for part in parts for r in part[:-1]) and all(part[-1][2] for part in parts)
    ordered = [r[:2] for part in parts for r in part[:-1]]
    assert Counter(ordered) == Counter(rows) and ordered == sorted(ordered, key=lambda r: r[0] or 0)
    assert [part[-1][:2] for part in parts] == [part[0][:2] for part in parts[1:] + parts[:1]]
    got = fingerprints_after_edit(table, 10)
    assert got.count() == 501 and got.filter("doc_id = 7 AND near_next = 1.0").count() >= 299


def test_edited():
    assert edited("abcde", "XYZ") == "abcXY" and edited("abcd", "X") == "abX" and edited("a", "X") == "a" and edited("", "X") == ""


# Importance resampling


def test_feature_buckets_are_checksums():
    texts = ["", "One two", "é日 x" * 3, "a" * 100 + " b " + "c" * 5000, "...", "THE end.", "12-ab"]
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)])
    got = importance.Features(b"".join(data), bounds, buckets=997, longest=3)
    for number, text in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        assert got.words[number] == len(words)
        assert Counter(got.buckets[got.owners == number].tolist()) == Counter(zlib.crc32(r.encode()) % 997 for r in runs)


def brute_sample(rows, target, percent=25):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return words, [zlib.crc32(f.encode()) % 10000 for f in [*words, *map(" ".join, zip(words, words[1:]))]]

    source, wanted = Counter(), Counter()
    for _, text in rows:
        source.update(features(text)[1])
    for text in target:
        wanted.update(features(text)[1])
    total, goal = sum(source.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (total + 10000) / ((source[b] + 1) * (goal + 10000))))
    found = []
    for doc_id, text in rows:
        words, buckets = features(text)
        weight = sum(map(gain, buckets)) // len(buckets) if buckets else 0
        if doc_id is None:
            found.append((doc_id, len(buckets), weight, None, False))
            continue
        h = int(hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()[:8], 16)
        found.append((doc_id, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= 20))
    order = sorted((r for r in found if r[4]), key=lambda r: (-r[3], r[0], r[1]))
    drawn = len(order) * percent // 100
    return Counter([(*r[:4], n + 1 if n < drawn else None) for n, r in enumerate(order)] + [(*r[:4], None) for r in found if not r[4]])


def test_resampling_against_brute_force(spark):
    draw = random.Random(9)
    words = ["The", "cat", "É", "sat-on", "mat", "9", *(f"w{i}" for i in range(30))]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(0, 60)))) for i in range(-40, 120)]
    rows += [(500, None), (501, ""), (None, "no id " * 20), (502, "x" * 9000 + " y" * 30), (503, "日本" * 2000), rows[80], (3, rows[90][1] + " more")]
    target = ["the cat sat on the mat", "cat sat", "", None]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, score string, rank int").repartition(7)
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    assert Counter(tuple(r) for r in importance.resampled(docs, wanted).collect()) == brute_sample(rows, target)
    assert Counter(tuple(r) for r in importance.resampled(docs, wanted.limit(0), percent=60).collect()) == brute_sample(rows, [], 60)
    assert importance.resampled(docs.limit(0), wanted).count() == 0
    assert importance.resampled(docs.filter("doc_id = 500"), wanted).first()["weight"] == 0


@pytest.mark.parametrize("bits, block_bits", [(3, 2), (10, 14), (7, 5)])
def test_radix_ranks(spark, bits, block_bits, tmp_path):
    draw = random.Random(bits)
    rows = [(draw.choice([-5, 7, 7, 7]), draw.randint(-(10**6), 10**6), draw.randint(0, 3), f"t{i}") for i in range(300)]
    rows += [(7, 0, 0, "same")] * 150  # a third of all rows alike
    spark.createDataFrame(rows, "a int, b long, c int, name string").repartition(4).write.parquet(f"{tmp_path}/rows")
    got = radix_rank.ranked(spark.read.parquet(f"{tmp_path}/rows"), ["a", "b", "c"], "place", bits, block_bits).collect()
    ordered = [tuple(r)[:4] for r in sorted(got, key=lambda r: r["place"])]
    assert [r["place"] for r in sorted(got, key=lambda r: r["place"])] == list(range(1, 451))
    assert [r[:3] for r in ordered] == sorted(r[:3] for r in rows) and Counter(ordered) == Counter(rows)
    table = spark.read.parquet(f"{tmp_path}/rows")
    assert radix_rank.ranked(table.limit(0), ["a"]).count() == 0
    assert [r["rank"] for r in radix_rank.ranked(table.filter("name = 't5'"), ["a", "b"]).collect()] == [1]


def test_texts_are_taken_together_in_bounded_stretches(monkeypatch):
    monkeypatch.setattr(importance, "BYTES_TOGETHER", 10)
    texts = ["abc", None, "défg", "x" * 50, "", "yz"]
    parts = [(at, data, bounds.tolist()) for at, data, bounds in importance._together(pa.array(texts))]
    assert b"".join(data for _, data, _ in parts) == "".join(t or "" for t in texts).encode()
    assert sum(len(bounds) - 1 for _, _, bounds in parts) == 6
    assert all(len(data) <= 10 or len(bounds) == 2 for _, data, bounds in parts)
