"""Vector search, exact copies, near lines and Jaccard components against brute force, with edge cases."""

from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from footfall.llm.components import components
from footfall.llm.exact_dedup import MOST_CHUNK, chunks, exact_duplicates
from footfall.llm.jaccard_join import bitmap, differing_bits, jaccard_components, shingle_hashes
from footfall.llm.line_dedup import CHARS_PER_EDIT, EDITS, near_lines
from footfall.llm.vector_search import exact_top_k

DOCS = "text string, doc_id long, kept boolean"


def found(rows, *columns):
    return sorted(rows.select(*columns).collect(), key=str)


def check_top_k(table, whole):
    """`whole` has a row (id, integers) for every row that takes part; each is a query and a candidate of its own."""
    expected = []
    for n, (q, own) in enumerate(whole):
        if q % 20 == 0:
            others = [(i, v) for m, (i, v) in enumerate(whole) if m != n and len(v) == len(own)]
            scores = [(-sum(a * b for a, b in zip(own, v)), i) for i, v in others]
            expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:20])]
    got = [tuple(r) for r in exact_top_k(table, F.col("vec_id") % 20 == 0).select("query_id", "rank", "vec_id", "score").collect()]
    assert sorted(got) == sorted(expected)


def test_top_k_of_large_components(spark):
    """Components beyond 32 bits, and scores beyond 53, between small ones; ties and neighbours there."""
    rows = [(0, [1.0, 0.0]), (1, [5e8, 0.0]), (2, [6e8, 0.0]), (3, [6e8, 1.0])]
    check_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), [(i, [math.floor(64 * x) for x in v]) for i, v in rows])
    draw = random.Random(8)
    rows += [(i, [draw.choice([1e4, 3.1e5, 1.0]) * draw.gauss(0, 1), draw.gauss(0, 9)]) for i in range(4, 120)]
    rows += [(i, [2e5, i / 64]) for i in range(120, 200)]
    check_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), [(i, [math.floor(64 * x) for x in v]) for i, v in rows])
    # Beyond 64 bits both components and scores are held at the ends.
    ends = spark.createDataFrame([(0, [1e300]), (1, [1e300]), (2, [-1e300]), (3, [0.0])], "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in exact_top_k(ends, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(1, 2**63 - 1), (3, 0), (2, 1 - 2**63)]


def test_top_k_against_brute_force(spark):
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 0.4) for _ in range(7)], "x") for i in range(150)]
    rows += [(i, rows[0][1], "same") for i in range(150, 190)]
    rows += [(200, None, "null"), (220, [1.0, None] * 3 + [1.0], "hole"), (240, [math.nan] * 7, "nan"), (260, [math.inf] * 7, "inf")]
    rows += [(None, [0.1] * 7, "no id"), (280, [0.5, 0.5], "short"), (300, [], "empty"), rows[5], rows[20], (20, rows[7][1], "another")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in [*rows[:190], *rows[-5:]]]
    check_top_k(table, whole)
    assert exact_top_k(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("weak", [False, True])
def test_copies(spark, weak):
    long = "A sentence of words. " * 4000
    texts = {1: "a", 2: "a", 3: None, 4: "", 5: long, 6: long + ".", 7: long, 8: "b", 9: "a " * 400 + "x", 10: "a " * 400 + "y"}
    table = spark.createDataFrame([(t, i, True) for i, t in texts.items()] + [("a", 2, True)], DOCS)
    # A weak fingerprint makes different chunks share it: the variants must tell them apart.
    more = {"fingerprint": lambda chunk: F.length(chunk).cast("long") % 2} if weak else {}
    got = exact_duplicates(table, **more).collect()
    assert len(got) == 11
    for row in got:
        own = texts[row["doc_id"]] or ""
        same = [i for i, t in texts.items() if (t or "") == own]
        assert row["keep_id"] == max(same)
        assert row["group_size"] == len(same) + (own == "a")
        assert row["text_sha256"] == hashlib.sha256(own.encode()).hexdigest()
    assert sorted(r["doc_id"] for r in got if r["kept"]) == [2, 4, 6, 7, 8, 9, 10]
    assert exact_duplicates(table.limit(0)).count() == 0


def test_chunks_end_in_every_script(spark):
    draw = random.Random(9)
    texts = ["a" * 200_000, "".join(chr(draw.randint(0x3041, 0x3096)) for _ in range(140_000)), "x" * 5000 + ". tail", "", "short", "𝒳" * 9000]
    for row in spark.createDataFrame([(t,) for t in texts], "text string").select("text", chunks(F.col("text")).alias("c")).collect():
        assert "".join(row["c"]) == row["text"]
        assert all(len(chunk) <= MOST_CHUNK + 1 for chunk in row["c"])
    # What stands before a text in such a script does not change the chunks behind.
    kana = texts[1]
    two = spark.createDataFrame([(kana,), ("あ" * 77 + kana,)], "text string").select(chunks(F.col("text")).alias("c")).collect()
    assert len(set(two[0]["c"]) & set(two[1]["c"])) > 0.9 * len(two[0]["c"])


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_near_lines_against_brute_force(spark):
    draw = random.Random(4)
    lines = []
    for _ in range(12):
        line = "".join(draw.choices("abcde é", k=draw.randint(10, 60)))
        lines.append(line)
        for _ in range(4):
            other = list(line)
            for _ in range(draw.randint(1, 3)):
                at = draw.randrange(len(other))
                other[at : at + draw.randint(0, 1)] = draw.choices("xyz", k=draw.randint(0, 1))
            lines.append("".join(other))
    texts = ["\n".join(lines[i : i + 5]) for i in range(0, len(lines), 5)] + [None, "", lines[0]]
    table = spark.createDataFrame([(t, i, True) for i, t in enumerate(texts)], DOCS)
    distinct = sorted({line for t in texts for line in (t or "").split("\n")})

    def near(a, b):
        return distance(a, b) <= min(EDITS, min(len(a), len(b)) // CHARS_PER_EDIT)

    got = {r["line_id"]: r for r in near_lines(table).collect()}
    assert len(got) == len(distinct)
    for line in distinct:
        row = got[hashlib.sha256(line.encode()).hexdigest()]
        assert row["links"] == sum(near(line, other) for other in distinct if other != line)
        assert row["copies"] == sum((t or "").split("\n").count(line) for t in texts)
        if row["links"] == 0:
            assert (row["keep_doc_id"], row["keep_line_no"]) == (row["doc_id"], row["line_no"])
    assert near_lines(table.limit(0)).count() == 0


def test_near_lines_of_odd_rows_and_joined_by_shuffles(spark, monkeypatch):
    """Null and repeated ids, a very long line, many versions of one line, and no table small enough to be broadcast."""
    from footfall.llm import line_dedup

    base = "The quick brown fox jumps over the lazy dog at noon."
    versions = [base[:at] + "#" + base[at + 1 :] for at in range(0, 50, 2)]
    long = "word and another " * 6000
    rows = [(base, None), (base, 7), (base, 7), ("\n".join(versions), 3), (long, 5), (long[:-9] + long[-8:], None), (None, None)]
    table = spark.createDataFrame([(t, i, "x") for t, i in rows], "text string, doc_id long, line string")
    lines = sorted({line for t, _ in rows for line in (t or "").split("\n")})

    def results():
        return sorted(map(tuple, near_lines(table).collect()), key=str)

    got = results()
    by_id = {row[0]: row for row in got}
    assert len(got) == len(lines)
    for line in [base, *versions]:
        row = by_id[hashlib.sha256(line.encode()).hexdigest()]
        # One version is the base with one edit, two versions are two edits apart.
        assert row[4] == len(versions) and row[5:] == (3, 0)
    first, second = (by_id[hashlib.sha256(t.encode()).hexdigest()] for t in (long, rows[5][0]))
    assert first[4] == second[4] == 1 and first[5:] == second[5:] == (5, 0)
    assert by_id[hashlib.sha256(base.encode()).hexdigest()][1:4] == (7, 0, 3)
    monkeypatch.setattr(line_dedup, "BROADCAST_CANDIDATES", -1)
    monkeypatch.setattr(line_dedup.counted, "__defaults__", (-1,))
    assert results() == got


def test_jaccard_components_against_brute_force(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = {}
    for group in range(6):
        base = draw.choices(words, k=draw.choice([30, 80, 200]))
        for _ in range(7):
            own = list(base)
            for _ in range(draw.randint(0, 3)):
                own[draw.randrange(len(own))] = draw.choice(words)
            texts[len(texts)] = " ".join(own)
    texts |= {100: None, 101: "", 102: " \t\n", 103: "One two", 104: "one\x0btwo", 105: "one two", 106: texts[0].upper(), 107: "w " * 3000, 108: "w " * 5}
    table = spark.createDataFrame([(t, i, True) for i, t in texts.items()] + [(texts[0], 0, True), ("w1", None, True)], DOCS)
    sets = {}
    for i, t in texts.items():
        parts = (t or "").encode().lower().split()
        sets[i] = {tuple(parts[k : k + 5]) for k in range(max(1, len(parts) - 4))} if parts else set()
    reach = {i: {i} for i in sets}
    for a in sets:
        for b in sets:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                joined = reach[a] | reach[b]
                for i in joined:
                    reach[i] = joined
    got = jaccard_components(table).collect()
    assert len(got) == len(texts) + 2
    for row in got:
        if row["doc_id"] is None:
            assert row["component_id"] is None
        else:
            assert row["n_shingles"] == len(sets[row["doc_id"]])
            assert row["component_id"] == min(reach[row["doc_id"]]), row
    assert jaccard_components(table.limit(0)).count() == 0


def test_bitmaps_bound_the_difference():
    draw = random.Random(6)
    for _ in range(50):
        a = shingle_hashes(" ".join(draw.choices("abcdefgh", k=draw.randint(5, 900))))
        b = shingle_hashes(" ".join(draw.choices("abcdefgh", k=draw.randint(5, 900))))
        assert differing_bits(bitmap(a), bitmap(b)) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(300, 300), (501, 500), (500, 501)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 40)} | {500: 500, 501: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tiles_of_several_blocks_lose_no_link(spark, monkeypatch):
    """A base text, copies that are near it but not each other, and a chain: small blocks, every tile a large one."""
    from footfall.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "SIDE", 3)
    monkeypatch.setattr(jaccard_join, "SMALL_TILE", 1)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base)]
    for i in range(24):
        changed = list(base)
        for at in (5 * i % 110, (5 * i + 40) % 110):
            changed[at] = f"x{i}-{at}"
        texts.append(" ".join(changed))
    texts += [" ".join(f"c{j}" for j in range(6 * i, 6 * i + 90)) for i in range(12)]
    sets = [set(shingle_hashes(text).tolist()) for text in texts]
    least = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 80 * len(a | b):
                    least[i] = min(least[i], least[j])
    got = jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((row.doc_id, row.component_id) for row in got) == list(enumerate(least))
    assert len(set(least)) < len(texts)
