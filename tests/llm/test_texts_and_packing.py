"""HTML, BPE, WARC, packing, language, rollups and the pipeline: exact round trips, brute force and edge cases."""

from __future__ import annotations

import hashlib
import html
import json
import random
import re
import time
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from footfall.llm import language_id, warc
from footfall.llm.byte_bpe import Encoder, decoded, encoded, round_trip_digests
from footfall.llm.html_labels import LAYOUTS, drawn_pages
from footfall.llm.html_text import extract, labelled_blocks, main_blocks, main_texts, trained_tree
from footfall.llm.queries import queries
from footfall.llm.packing import WordTokenizer, packed_documents, plan
from footfall.llm.token_rollups import Rollup, deletes, inserts, revisions, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a  b", "x \n\ny\t z ", "don't WE'LL", "日本語、です。　全角", "é  x", "👩‍👧 ok", "a" * 3000, "ab" * 900, "\x1cq\x0bz", "<|endoftext|> x", "İstanbul, Σ."]


def test_tree_and_extraction(spark):
    rows, labels = labelled_blocks()
    assert (main_blocks(trained_tree(), rows) == labels).mean() > 0.99
    page = (
        "<html><body><header>Top</header><nav><a href=/>Home</a></nav><div class='ad'>Buy now</div><article><h1>A &amp; B</h1>"
        "<p>One  two\nthree<p><b>Four<br>five</b><script>var x='<p>';</script><p>&eacute;&#33;</article>"
        "<div class='comments'><p>I do not think so at all.</div><form><p>Name</form><footer>Imprint</footer>"
    )
    assert extract(page, trained_tree()) == "A & B\nOne two three\nFour\nfive\né!"
    table = spark.createDataFrame([(1, "u", page, "x"), (2, None, None, "x"), (None, "u", "", "x"), (1, "u", page, "x")], "page_id long, url string, html string, text string")
    got = main_texts(table).collect()
    assert len(got) == 4 and {(r["page_id"], r["n_chars"]) for r in got} == {(1, 32), (2, 0), (None, 0)}
    assert main_texts(table.limit(0)).count() == 0


def test_pages_of_the_table_give_the_blocks_of_their_articles(spark):
    """The given pages hold one `article`, of paragraphs and lines: taken apart by hand it is the text that the query finds."""
    found = {row["page_id"]: row for row in queries()["op3_main_text"](spark, "/root/testdata/sf0.001").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    assert len(found) == len(pages) > 0
    for page in pages:
        inner = page["html"].partition("<article>")[2].partition("</article>")[0]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", part)).split()) for part in re.split(r"</?(?:p|br|h1)>", inner))
        wanted = "\n".join(block for block in blocks if block)
        assert (found[page["page_id"]]["text"], found[page["page_id"]]["n_chars"], found[page["page_id"]]["url"]) == (wanted, len(wanted), page["url"])


def _splits(node):
    return [] if node.feature < 0 else [node.feature, *_splits(node.left), *_splits(node.right)]


def test_the_tree_asks_for_neighbours():
    """Words and link density of the block, of both neighbours, and the one feature of names and elements."""
    assert {0, 1, 6} < set(_splits(trained_tree())) and {2, 3, 4, 5} & set(_splits(trained_tree()))
    long, short = "<p>" + "word " * 40 + "</p>", "<p>Not now.</p>"
    link = "<p><a href=/>One word</a></p>"
    # The same short line is text among paragraphs, and is none among links.
    assert "Not now." in extract(link + long + long + short + long + long + link, trained_tree())
    assert "Not now." not in extract(link + link + short + link + long + long + link, trained_tree())


def test_containers_bound_what_lengths_suggest():
    """An article's text is main text whatever its lengths, other content never is; for any neighbours."""
    draw = np.random.default_rng(1)
    around = [draw.integers(0, 120, 5000), draw.random(5000).round() * draw.random(5000)]
    words = draw.integers(1, 120, 5000)
    rows = np.column_stack([words, np.zeros(5000), *around, *(draw.permutation(one) for one in around), np.full(5000, 2.0)])
    assert main_blocks(trained_tree(), rows).mean() > 0.99
    rows[:, 6], rows[:, 1] = 0, draw.random(5000)
    assert not main_blocks(trained_tree(), rows).any()


LONG = "Words of a sentence that goes on for quite some time, " * 4
ARTICLE = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
ARTICLE_TEXT = f"Title\n{LONG.strip()}\nShort.\n{LONG.strip()}"


@pytest.mark.parametrize(
    "page",
    [
        f"<head><title>T</title><body><article>{ARTICLE}</article>",
        f"<head><title>T</title><p class=advert>Buy now<div><article>{ARTICLE}</article></div>",
        f"<table><tr><td class=sidebar>Side<td><article>{ARTICLE}</article></table>",
        f"<dl><dt class=menu>Side<dd>{ARTICLE}</dl>",
        f"<ul><li class=menu>Side<li>{ARTICLE}</ul>",
        f"<table><thead class=banner><tr><th>Side<tbody><tr><td>{ARTICLE}</table>",
        f"<div class='has-sidebar content with-comments'>{ARTICLE}</div>",
        f"<div class='layout header-fixed side left'>{ARTICLE}</div>",
        f"<div class='post-tags-page header-image'>{ARTICLE}</div>",
        f"<form><main>{ARTICLE}</main><p>Send</p></form>".replace("<p>Send</p>", "<button>Send</button>"),
        f"<div class=newsletter-page id=sidebarTheme><nav><a href=/>x</a></nav><article class=entry>{ARTICLE}</article><div class=comment-list><article><p>{LONG}</p></article></div></div>",
        f"<article><div class=post-header><h1>Title</h1></div>{ARTICLE.removeprefix('<h1>Title</h1>')}<div class=relatedPosts><article><p>{LONG}</p></article></div></article>",
        f"<article>{ARTICLE}</article><!-- cut off --><div class='",
        f"<article>{ARTICLE}</article><!-- never closed <p>{LONG}</p>",
        f"<!--><article><!-- a > b -->{ARTICLE}<!---></article>",
        f"<script><!-- never closed </script><article>{ARTICLE}</article>",
        f"<b><article><i>{ARTICLE}</b></article></i><footer>Imprint",
    ],
)
def test_pages_that_close_nothing_or_name_everything(page):
    assert extract(page, trained_tree()) == ARTICLE_TEXT


def test_a_paragraph_that_is_one_link_is_kept():
    assert extract(f"<article>{ARTICLE}<p><a href=/>All of it a link</a></p><p>{LONG}</p></article>", trained_tree()) == f"{ARTICLE_TEXT}\nAll of it a link\n{LONG.strip()}"


def test_long_and_broken_markup_takes_time_by_its_length():
    started = time.monotonic()
    for markup in ("<i>" * 50_000 + "</b>" * 50_000, "<p>x" * 50_000, "<div class=ad>x" * 20_000, "<td><a>x" * 20_000, "<a " * 100_000, "word " * 500_000):
        extract(markup, trained_tree())
    assert time.monotonic() - started < 30
    assert extract("word " * 500_000, trained_tree()) == ("word " * 500_000).strip()


# Pages of layouts that the tree has not seen, without helpful names or elements. Marked as the labelled table is.
HELD_OUT = (
    f"""
    <html><body><center>
-<font size=5>The Valley Post</font><br>
-<a href=/1>Front page</a> - <a href=/2>Weather</a> - <a href=/3>Letters</a><hr>
    </center><table><tr><td width=150>
-<a href=/4>Mill to close</a><br>
-<a href=/5>Bridge opens</a><br>
-<a href=/6>Late frost harms orchards</a></td><td>
+<h1>Bakers keep the old oven</h1>
+{LONG}<br>
+{LONG}<a href=/7>the guild</a>, {LONG}<p>
+They will vote in May.<p>
+{LONG}
    </td></tr></table><center>
-<a href=/8>Imprint</a> <a href=/9>Top</a><br>
-The Valley Post
    </center></body></html>
    """,
    f"""
    <html><body><div class="x1"><div class="x2">
-<span>kite.example</span>
    </div><div class="x3">
-<a href=/1>Kites</a>
    </div><div class="x3">
-<a href=/2>Lines and reels</a>
    </div></div><div class="x4"><div class="x5">
+<h1>Which line for which wind</h1>
+<div>{LONG}</div>
+<h2>Light wind</h2>
+<div>{LONG}{LONG}</div>
+<div>Thin lines sing.</div>
+<div>{LONG}</div>
    </div><div class="x6">
-<div>More</div>
-<div><a href=/3>How to mend a torn sail at home</a></div>
-<div><a href=/4>Ten beaches with steady wind</a></div>
    </div></div><div class="x7">
-<span>Made by friends of the wind</span> <a href=/5>Contact us</a> <a href=/6>Privacy</a>
    </div></body></html>
    """,
    f"""
    <html><body><section>
-<ul><li><a href=/a>A</a></li>
-<li><a href=/b>B</a></li>
-<li><a href=/c>C</a></li></ul></section><section>
+<h1>Notes on moss</h1>
+<blockquote>{LONG}</blockquote>
+<ul><li>{LONG}</li>
+<li>On stone it grows slowly.</li>
+<li>{LONG}</li></ul>
+<p>{LONG}</p></section><section>
-<p><a href=/d>Notes on lichen</a></p>
-<p><a href=/e>Notes on ferns, part one</a></p>
-<p>Mail us</p></section></body></html>
    """,
)


def test_held_out_pages_without_helpful_names():
    rows, labels = labelled_blocks(HELD_OUT)
    got = main_blocks(trained_tree(), rows)
    precision, recall = (got & labels).sum() / got.sum(), (got & labels).sum() / labels.sum()
    print(f"held-out blocks {len(labels)}: precision {precision:.3f}, recall {recall:.3f}")
    assert precision >= 0.9 and recall >= 0.9
    rows, labels = labelled_blocks(drawn_pages(LAYOUTS, 99, 50))
    assert (main_blocks(trained_tree(), rows) == labels).mean() > 0.98


def test_bpe_equals_tiktoken(spark):
    own = Encoder(RANKS, public_tokenizers.PATTERN)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    draw = random.Random(1)
    texts = ODD + ["".join(draw.choices("ab '\n\t\x1cé日1.-sSlL\r​", k=draw.randint(0, 40))) for _ in range(3000)]
    for text in texts:
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text), repr(text)
        assert own.decode(ids) == text.encode()
    table = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(99, None, "x")], "doc_id long, text string, ids string")
    for row in round_trip_digests(table, RANKS, public_tokenizers.PATTERN).collect():
        text = ODD[row["doc_id"]] if row["doc_id"] < 99 else ""
        assert row["n_tokens"] == len(other.encode_ordinary(text))
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    back = decoded(encoded(table, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in back.collect()} == dict(enumerate(ODD)) | {99: ""}


def test_warc_round_trip(spark, tmp_path):
    big = "é" * 600
    pages = [(1, "http://a/\n1", big, "x"), (2, None, big, "x"), (3, "u", "short", "x"), (4, "u", "short", "x"), (5, "u", None, "x"), (6, "u", big, "x")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, refers_to string")
    got = {r["page_id"]: r for r in warc.archived(table).collect()}
    assert len(got) == 6
    for page_id, _, html, _ in pages:
        payload, row = (html or "").encode(), got[page_id]
        assert (row["payload_bytes"], row["payload_digest"]) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert (row["record_type"], row["refers_to"]) == (("revisit", 6) if page_id in (1, 2) else ("response", None))
    archive = warc.bundles(warc.with_revisits(table)).cache()
    wanted = spark.createDataFrame([(warc.record_id(6),), (warc.record_id(3),)], "record_id string")
    found = {r["record_id"]: bytes(r["record"]) for r in warc.look_up(archive, wanted).collect()}
    assert found[warc.record_id(6)].endswith(big.encode() + b"\r\n\r\n") and len(found) == 2
    warc.export(archive, f"file://{tmp_path}")
    warc.export(archive, f"file://{tmp_path}")
    files = sorted(tmp_path.glob("*.warc.zst"))
    assert len(files) == archive.count()
    raw = files[0].read_bytes()
    assert warc.parse(warc.frame(raw, 0))[0]["WARC-Type"] in ("response", "revisit")
    assert warc.archived(table.limit(0)).count() == 0


def test_word_tokenizer_equals_the_library():
    own, other = WordTokenizer(WORDS), Tokenizer.from_file(WORDS)
    assert own.wordwise and own.ends is not None
    draw = random.Random(12)
    parts = [*"abzABZéÉßΣςσİıñ日本ー1²½_'-.,!?<|>\u0301\u00a0\u200b", " ", "  ", "\n", "<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "don't", "WE'LL", "endoftext", "the ", "ſ", "K"]
    texts = ODD + ["".join(draw.choices(parts, k=draw.randint(0, 25))) for _ in range(6000)]
    texts += ["<|ENDOFTEXT|>", "<|STARTOFTEXT|>", "x<|endoftext|>y", "x<|EndOfText|>y", " ".join(["word"] * 700 + ["Σ", "ΑΣ", "ΑΣΑ"])]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == other.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_tokenizers_see_whole_texts(tmp_path):
    told = json.loads(Path(WORDS).read_text())
    told["normalizer"] = {"type": "NFC"}
    (tmp_path / "other.json").write_text(json.dumps(told))
    own, other = WordTokenizer(str(tmp_path / "other.json")), Tokenizer.from_file(str(tmp_path / "other.json"))
    assert not own.wordwise
    for text in ("Some Text, here.", "ABC abc"):
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == other.encode(text, add_special_tokens=False).ids


def test_packing(spark):
    texts = {i: t for i, t in enumerate(ODD)} | {50: "word " * 5000, 51: None, 52: "one two"}
    table = spark.createDataFrame([(i, t, 1) for i, t in texts.items()] + [(52, "one two", 1)], "doc_id long, text string, offset int")
    own = Tokenizer.from_file(WORDS)
    rows = packed_documents(table, WORDS, size=64).collect()
    used, total = defaultdict(list), 0
    for row in rows:
        ids = np.array(own.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids + [0], "<u4")
        part = ids[row["start"] : row["start"] + row["length"]]
        assert zlib.crc32(part.tobytes()) == row["ids_crc32"] and row["start"] == 64 * row["piece"]
        assert row["length"] == min(64, len(ids) - row["start"])
        used[row["sequence_id"]].append((row["offset"], row["length"]))
        total += row["length"]
    assert total == sum(len(own.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts.values()) + 3
    for places in used.values():
        ends = [a + b for a, b in sorted(places)]
        assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 64
    assert packed_documents(table.limit(0), WORDS).count() == 0


@pytest.mark.parametrize("most", [3, 40, 64])
def test_plan_gives_every_rank_one_slot(most):
    draw = random.Random(most)
    counts = {n: draw.randint(1, 500) for n in draw.sample(range(1, most + 1), min(most, 30))}
    used, ranks = defaultdict(int), defaultdict(list)
    for length, first, last, sequence, _ in plan(counts, 64):
        ranks[length] += range(first, last + 1)
        for rank in range(first, last + 1):
            used[sequence + rank - first] += length
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    assert max(used.values()) <= 64
    # Piece by piece, best-fit decreasing opens as many.
    rooms: list[int] = []
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        at = bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else 64
        insort(rooms, room - length)
    assert len(used) == len(rooms)


def test_language(spark):
    draw = random.Random(2)
    vocabulary = {"xx": ["aba", "bab", "abba"], "yy": ["ünö", "öün", "nüö"]}
    rows = [(i, " ".join(draw.choices(vocabulary[lang], k=60)), lang) for i, lang in enumerate(["xx", "yy"] * 60)]
    rows += [(500, None, "xx"), (501, "12 3 ...", "yy"), (502, "", None), (503, "aba bab " * 9000, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = {r["doc_id"]: r for r in language_id.predicted(table, training=F.col("doc_id") % 4 != 2).collect()}
    held = [i for i, _, _ in rows[:120] if i % 4 == 2]
    assert sum(got[i]["lang_pred"] == rows[i][2] for i in held) >= 0.95 * len(held)
    assert [got[i]["lang_pred"] for i in (500, 501, 502, 503)] == ["und", "und", "und", "xx"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert {r["lang_pred"] for r in language_id.predicted(table, training=F.lit(False)).collect()} == {"und"}
    assert language_id.predicted(table.limit(0)).count() == 0


def test_only_letters_make_a_language(spark):
    rows = [(i, "aba bab abba " * 5, "xx") for i in range(20)] + [(100, "½ ² ① Ⅳ", None), (101, "½ a", None), (102, "_ 12", None), (None, "日", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language_id.predicted(table, training=F.col("doc_id") < 50).collect()}
    assert [got[i]["lang_pred"] for i in (100, 101, 102, None)] == ["und", "xx", "und", "xx"]
    assert [got[i]["letters"] for i in (100, 101, 102, None)] == [False, True, False, True]


def test_a_corpus_without_labels_keeps_its_documents(spark):
    rows = [(i, f"some words {i}", None, "s", 1) for i in range(5)] + [(5, "1 2", None, "s", 1), (6, None, None, "s", 1), (None, "no id", None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").collect()} == {0, 1, 2, 3, 4, None}


def test_gradients():
    random_numbers = np.random.default_rng(1)
    model = language_id.train([("a", "abc" * 9), ("b", "xyz" * 9)])
    windows = random_numbers.integers(0, 257, (3, 6))
    targets, weights = np.array([0, 1, 1]), np.ones(3, np.float32)

    def loss() -> float:
        chances = model.positions(windows)
        real = windows.T < 256
        return float(-np.log(chances[:, np.arange(3), targets])[real].sum() / real.sum())

    for array, slope in zip(model.arrays(), language_id._slopes(model, windows, targets, weights), strict=True):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        kept = array[at]
        array[at] = kept + 1e-2
        up = loss()
        array[at] = kept - 1e-2
        down = loss()
        array[at] = kept
        assert (up - down) / 2e-2 == pytest.approx(slope[at], rel=0.05, abs=1e-4)


def test_rollups_against_a_recount(spark, tmp_path, monkeypatch):
    """Random batches of inserts, deletes and revisions, repeated, revised, emptied and crashed."""
    draw = random.Random(12)
    kinds = [("s", "en", "v"), ("s", None, "v"), (None, "de", "w")]
    rollup, batches = Rollup(spark, str(tmp_path / "rollup")), {}
    deltas = "source string, lang string, tokenizer_version string, documents long, tokens long"

    def commit(name, rows):
        rollup.commit(name, spark.createDataFrame(rows, deltas))

    def recount():
        sums = defaultdict(lambda: [0, 0])
        for rows in batches.values():
            for *key, documents, tokens in rows:
                sums[tuple(key)][0] += documents
                sums[tuple(key)][1] += tokens or 0
        return {key: tuple(n) for key, n in sums.items() if any(n)}

    def totals():
        return {tuple(r[:3]): tuple(r[3:]) for r in rollup.totals().collect()}

    for step in range(7):
        name = f"b{draw.randint(0, 3)}"
        rows = [(*draw.choice(kinds), draw.choice([-1, 0, 1]), draw.choice([None, -7, 5, 40])) for _ in range(draw.choice([0, 3, 20]))]
        for _ in range(draw.choice([1, 2])):
            commit(name, rows)
        batches[name] = rows
        assert totals() == recount(), step
    # A commit that ends before its last step changes nothing; its retry does.
    class Broken(Exception):
        pass

    def broken(*_, **__):
        raise Broken

    before = totals()
    with monkeypatch.context() as patch:
        patch.setattr(rollup, "_mark", broken)
        with pytest.raises(Broken):
            commit("b9", [("s", "en", "v", 1, 100)])
    assert totals() == before
    commit("b9", [("s", "en", "v", 1, 100)])
    batches["b9"] = [("s", "en", "v", 1, 100)]
    assert totals() == recount()


def test_old_batches_are_folded_away(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "rollup"), open_batches=2)
    row = [("s", "en", "v", 1, 10)]
    deltas = "source string, lang string, tokenizer_version string, documents long, tokens long"
    for n in range(4):
        rollup.commit(f"b{n}", spark.createDataFrame(row, deltas))
    assert {r["batch"] for r in rollup._current()[1].filter("kind = 'batch'").collect()} == {"b2", "b3"}
    # One that is folded into the totals stays what it is, one still open can be replaced.
    rollup.commit("b0", spark.createDataFrame(row * 5, deltas))
    rollup.commit("b3", spark.createDataFrame([], deltas))
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "v", 3, 30)]


def test_rollups(spark, tmp_path):
    rows = [(1, "one two three", "s", "en"), (2, None, None, "en"), (3, "four", "s", None), (4, "x", "s", "en")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("tokenizer_version", F.lit("v"))
    counted = token_counts(table, RANKS, public_tokenizers.PATTERN, keep=("source", "lang", "tokenizer_version"))
    rollup = Rollup(spark, str(tmp_path / "rollup"))
    rollup.commit("empty", inserts(counted.limit(0)))
    assert rollup.totals().count() == 0
    for _ in range(2):
        rollup.commit("1", inserts(counted))
        rollup.commit("2", deletes(counted.filter("doc_id = 4")))
        rollup.commit("3", revisions(counted.filter("doc_id = 1").withColumn("new", F.lit(10)), "tokens", "new"))
    got = {(r["source"], r["lang"]): (r["documents"], r["tokens"]) for r in rollup.totals().collect()}
    four = len(np.frombuffer(Encoder(RANKS, public_tokenizers.PATTERN).encode("four"), "<u4"))
    assert got == {("s", "en"): (1, 10), (None, "en"): (1, 0), ("s", None): (1, four)}


def test_pipeline_stages(spark, tmp_path):
    draw = random.Random(9)
    texts = [" ".join(draw.choices(["der", "die", "und", "ist"] + [f"w{i}x{j}" for j in range(50)], k=80)) for i in range(30)]
    rows = [(i, t, "de", "s", len(t)) for i, t in enumerate(texts)]
    near = texts[3].rsplit(" ", 1)[0] + " anders"
    rows += [(100, texts[0], "de", "s", 1), (101, near, "de", "s", 1), (102, "123 456", "de", "s", 7), (103, None, "de", "s", None), rows[5]]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    expected = [set(range(30)) | {100, 101}, set(range(1, 30)) | {100, 101}, set(range(1, 30)) | {100}, set(range(1, 30)) | {100}]
    for (name, stage), ids in zip(corpus_pipeline.STAGES, expected, strict=True):
        before, docs = docs.columns, stage(spark, docs, str(tmp_path))
        assert {r["doc_id"] for r in docs.collect()} == ids, name
        if name != "packing":
            assert docs.columns == before
            docs.write.parquet(f"{tmp_path}/{name}")
            docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert spark.read.parquet(f"{tmp_path}/n-gram jaccard").count() == 30
    assert docs.count() == 30
