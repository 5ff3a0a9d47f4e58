"""Words that fool weak hashes, rows without or with shared ids, and the pipeline on odd input."""

import os
import time
from collections import Counter

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from test_operators import cut_plainly
from tokenizers import Tokenizer

from quillframe.llm import common, mixing, nearcopies, substring
from quillframe.session import shared_dir


def thue_morse(n: int) -> tuple[str, str]:
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_of_equal_polynomials_are_told_apart(spark):
    for n in (16, 32, 1024, 4096):
        one, two = thue_morse(n)
        for family in (0, 1):
            h, _ = common.hashed([f"{one} {two} {one.upper()}"], family=family)
            assert len(set(h.tolist())) == 3
            h, _ = common.hashed([f"{one} {one.upper()}"], lower=True, family=family)
            assert len(set(h.tolist())) == 1
    one, two = thue_morse(1024)
    head = " ".join(f"w{i}" for i in range(34))
    docs = spark.createDataFrame([(1, f"{head} {one}"), (2, f"{head} {two}"), (3, one), (4, two)], "doc_id bigint, text string")
    assert substring.digest(docs).agg(F.sum("n_removed")).first()[0] == 0
    assert all(r["kept"] for r in nearcopies.link(docs).where("doc_id > 2").collect())


def test_many_rows_of_one_id_and_text(spark):
    text = " ".join(f"w{i}" for i in range(400))
    docs = spark.createDataFrame([(None, text, i % 3) for i in range(6000)], "doc_id bigint, text string, extra int").repartition(8)
    start = time.time()
    assert substring.digest(docs).agg(F.count("*"), F.min("n_removed")).first() == (6000, 400)
    assert time.time() - start < 60
    left = substring.without_repeats(docs)
    assert left.columns == docs.columns and left.where("text != ''").count() == 0


def test_cut_texts_keep_all_other_columns(spark):
    shared = " ".join(f"s{i}" for i in range(50))
    rows = [(1, f"{shared} end", "x", 1, 9), (2, f"start {shared}", None, 2, 9), (None, None, "y", 3, 9), (None, "  spaced  out ", "z", 4, 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string, spans int, n_chars int")
    got = sorted((tuple(r) for r in substring.without_repeats(docs).collect()), key=lambda r: r[3])
    assert got == [(1, "end", "x", 1, 3), (2, "start", None, 2, 5), (None, None, "y", 3, None), (None, "  spaced  out ", "z", 4, 14)]


def shares_of(frame):
    words = Counter()
    for r in frame.select("source", "text").collect():
        words[r["source"]] += len((r["text"] or "").split())
    total = sum(words.values())
    return {k: round(v / total, 2) for k, v in words.items()}


def test_mixing_decides_row_by_row(spark):
    text = [" ".join(f"t{i}x{j}" for j in range(40 + i % 30)) for i in range(1800)]
    schema = "doc_id bigint, text string, source string, block int, _rows string"
    for name, ids in (("unique", range(1800)), ("null", [None] * 1800), ("shared", [i % 5 for i in range(1800)])):
        docs = spark.createDataFrame([(i, t, "abc"[k % 3], k, "r") for k, (i, t) in enumerate(zip(ids, text))], schema)
        out = mixing.copies(docs)
        assert out.columns == docs.columns
        got = shares_of(out)
        assert abs(got["a"] - 0.62) <= 0.03 and abs(got["b"] - 0.25) <= 0.03 and abs(got["c"] - 0.13) <= 0.03, (name, got)
        assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, mixing.copies(docs.repartition(3)).collect()), key=str)


def test_mixing_counts_equal_rows(spark):
    rows = [(None, "one two three four", "abc"[i % 3]) for i in range(3000)] + [(None, None, "a")] * 7 + [(1, "", None)]
    out = mixing.copies(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6))
    got = Counter(r["source"] for r in out.where("text = 'one two three four'").collect())
    assert abs(got["a"] - 1875) < 40 and abs(got["b"] - 750) < 40 and abs(got["c"] - 375) < 40
    assert out.where("text is null").count() == 7 and out.where("text = ''").count() == 1


def test_saved_tables_go(spark, tmp_path):
    frame = common.saved(spark.range(10))
    folder = frame.saved_at
    assert folder.startswith(shared_dir(spark)) and os.path.isdir(folder)
    common.dropped(frame, None)
    assert not os.path.exists(folder)


ODD = [(1, "the quick brown fox and the dog were in the house of the king", "en", "a", 1), (1, "the other text of the same id is here for all of the people", "en", "b", 1),
       (None, "a text that has no id but some words of the language", "en", "a", 1), (None, None, None, None, None), (None, "", "en", "a", 0), (2, " \t", "de", None, 2),
       (3, "der Hund und die Katze sind in dem Haus von der Frau und dem Mann", "de", "b", 1), (3, "der Hund und die Katze sind in dem Haus von der Frau und dem Mann", "de", "b", 1),
       (4, "the word " * 30_000, "en", "c", 1)]


def test_pipeline_on_odd_rows(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, start int, edges int"
    path = public_tokenizers.path("word_bpe_49k.json")
    for name, rows in (("odd", ODD), ("none", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame([(*r, "n", 1, 2) for r in rows], schema).write.parquet(f"{folder}/documents.parquet")
        docs, seen = common.table(spark, folder, "documents"), []
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            seen.append(docs)
        counts = [d.count() for d in seen]
        if not rows:
            assert counts == [0] * 5
            continue
        named, single, cut, mixed, encoded = seen
        assert counts[0] == 6 and named.where("text is null or trim(text) = ''").count() == 0
        assert counts[1] == 5 == single.select("doc_id", "text").distinct().count()
        before = {(r["doc_id"], r["source"]): r["text"] for r in single.collect()}
        after = {(r["doc_id"], r["source"]): r["text"] for r in cut.collect()}
        for (key, text), (_, gone, plain) in zip(before.items(), cut_plainly(before.values())):
            assert after[key] == (plain.decode() if gone else text)
        real = Tokenizer.from_file(path)
        texts = Counter((r["doc_id"], tuple(real.encode(r["text"] or "", add_special_tokens=False).ids)) for r in mixed.collect())
        assert texts == Counter((r["doc_id"], tuple(r["ids"])) for r in encoded.collect())
        assert all(r["n_tokens"] == len(r["ids"]) for r in encoded.collect())
        assert corpus_pipeline.run(spark, folder).count() == counts[-1]
