"""Every query as it is registered, over the given tables: against its SQL, or against the same counted plainly."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe
from tokenizers import Tokenizer

import corpus_pipeline
from footfall.llm.byte_bpe import round_trip_digests
from footfall.llm.packing import SIZE
from footfall.llm.queries import TOKENIZER_VERSION, oracle_sql, queries
from tests.comparing import difference, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


def documents(spark, folder=FOLDER):
    return spark.read.parquet(f"{folder}/documents.parquet").collect()


def encoder(name):
    ranks = load_tiktoken_bpe(public_tokenizers.path(name))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", ["op1_exact_top_k", "op2_exact_dedup", "op5_warc", "op9_ngram_jaccard"])
def test_queries_equal_their_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    rows = queries()[name](spark, FOLDER)
    columns, wanted = sql_rows(connection, oracle_sql()[name])
    assert columns == sorted(rows.columns) and wanted
    assert difference(spark_rows(rows), wanted) == ""


def test_encoding_equals_tiktoken(spark):
    other = encoder("byte_bpe_multi_50k.tiktoken")
    wanted = set()
    for row in documents(spark):
        text = row["text"] or ""
        ids = other.encode_ordinary(text)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        wanted.add((row["doc_id"], len(ids), digest, hashlib.sha256(text.encode()).hexdigest()))
    rows = queries()["op4_byte_bpe"](spark, FOLDER).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert len(rows) == len(documents(spark)) and {tuple(row) for row in rows} == wanted


def test_encoding_of_odd_rows(spark):
    """Null ids and repeated rows come out as they came in, an empty table gives none; one word of 200,000 characters."""
    path, other = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), encoder("byte_bpe_multi_50k.tiktoken")
    long = "abcde" * 40_000
    table = spark.createDataFrame([(None, "x y"), (1, "same"), (1, "same"), (2, long), (3, "")], "doc_id long, text string")
    found = Counter((row["doc_id"], row["n_tokens"]) for row in round_trip_digests(table, path, public_tokenizers.PATTERN).collect())
    assert found == Counter({(None, 2): 1, (1, len(other.encode_ordinary("same"))): 2, (2, len(other.encode_ordinary(long))): 1, (3, 0): 1})
    assert round_trip_digests(table.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_packing_equals_the_library(spark):
    other = Tokenizer.from_file(WORDS)
    wanted = set()
    for row in documents(spark):
        ids = [*other.encode(row["text"] or "", add_special_tokens=False).ids, 0]
        for start in range(0, len(ids), SIZE):
            part = ids[start : start + SIZE]
            wanted.add((row["doc_id"], start // SIZE, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    rows = queries()["op7_best_fit_packing"](spark, FOLDER).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == wanted and len(rows) == len(wanted)
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    free: list[int] = []
    for length in sorted((row["length"] for row in rows), reverse=True):
        fitting = [(room, at) for at, room in enumerate(free) if room >= length]
        if fitting:
            free[min(fitting)[1]] -= length
        else:
            free.append(SIZE - length)
    assert len(sequences) == len(free)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= SIZE


def test_languages_of_held_out_rows(spark):
    told = {row["doc_id"]: row for row in documents(spark, "/root/testdata/sf0.01")}
    rows = queries()["op8_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(told) and {row["doc_id"] for row in rows} == set(told)
    right = total = 0
    for row in rows:
        text, lang = told[row["doc_id"]]["text"], told[row["doc_id"]]["lang"]
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2) and 0 <= row["score"] <= 1
        assert (row["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        if row["held_out"] and lang is not None:
            right, total = right + (row["lang_pred"] == lang), total + 1
    assert total > 100 and right / total > 0.97


def kept_of_copies(rows):
    """Of equal texts the row of the largest id."""
    last = {}
    for row in sorted(rows, key=lambda row: row["doc_id"]):
        last[row["text"] or ""] = row
    return list(last.values())


def test_rollups_equal_a_recount(spark):
    other = encoder(f"{TOKENIZER_VERSION}.tiktoken")
    wanted = defaultdict(lambda: [0, 0])
    for row in kept_of_copies(documents(spark)):
        total = wanted[row["source"], row["lang"]]
        total[0] += 1
        total[1] += len(other.encode_ordinary(row["text"] or ""))
    rows = queries()["op10_token_rollups"](spark, FOLDER).collect()
    assert {(r["source"], r["lang"]): [r["documents"], r["tokens"]] for r in rows if r["documents"]} == dict(wanted)


def test_pipeline_keeps_what_a_plain_loop_keeps(spark):
    rows = [row for row in documents(spark) if any(c.isalpha() for c in row["text"] or "")]
    sets = {}
    for row in kept_of_copies(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", row["text"].translate({c: c + 32 for c in range(65, 91)}))
        sets[row["doc_id"]] = {tuple(words[at : at + 5]) for at in range(max(1, len(words) - 4))} if words else set()
    ids = sorted(sets)
    least = {one: one for one in ids}

    def root(one):
        while least[one] != one:
            one = least[one]
        return one

    for at, one in enumerate(ids):
        for two in ids[at + 1 :]:
            both = len(sets[one] & sets[two])
            if both and 100 * both >= 80 * (len(sets[one]) + len(sets[two]) - both):
                low, high = sorted((root(one), root(two)))
                least[high] = low
    assert {row["doc_id"] for row in corpus_pipeline.run(spark, FOLDER).collect()} == {one for one in ids if root(one) == one}


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
