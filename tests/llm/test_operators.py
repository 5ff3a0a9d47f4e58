"""The operators beside SQL, brute force or the library whose results they match; odd rows included."""

import collections
import hashlib
import math
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillframe.llm import bpe, chat, langid, lm, mixing, nearcopies, neighbours, pages, queries, substring, topk

PATH = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, text_hash int, node string, block int, chunk int"
LONG = " ".join(f"w{i}" for i in range(60))
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "one", None, "b", 3),
    (5, "x " + LONG, "en", "b", 1), (6, LONG + " y", "en", None, 1), (7, LONG.upper(), "de", "a", 1), (8, LONG, "en", "a", 1),
    (8, LONG, "en", "a", 1), (9, "a " * 50_000, "fr", "b", 1), (None, "no id here", "en", "c", 1), (10, "<|endoftext|>é́ ΣΣ it's 12", "fr", "c", 1),
]


@pytest.fixture(scope="module")
def con():
    return connect(PATH)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, "n", 2, 3) for r in ODD], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", [n for n in queries.ORACLES])
def test_sql(spark, con, name):
    assert compare(queries.QUERIES[name](spark, PATH), con, queries.ORACLES[name]) == ""


def cut_plainly(texts, span=35):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + span]) for w in words for i in range(len(w) - span + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - span + 1):
            if seen[tuple(w[i:i + span])] > 1:
                gone |= set(range(i, i + span))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_substring(odd, empty):
    got = sorted(map(tuple, substring.digest(odd).collect()), key=str)
    want = sorted(((r[0], n, g, hashlib.sha256(k).hexdigest()) for r, (n, g, k) in zip(ODD, cut_plainly([r[1] for r in ODD]))), key=str)
    assert got == want
    assert substring.digest(empty).count() == 0
    assert substring.without_repeats(odd).columns == odd.columns


def test_language(spark, odd, empty):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    r = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = r.where("held_out")
    assert held.where("lang_pred = lang").count() >= 0.95 * held.count()
    assert r.where("not score between 0 and 1").count() == 0
    got = {x["doc_id"]: x for x in langid.identify(odd).collect()}
    assert len(got) == 11 and all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1, 2, 3))
    assert langid.identify(empty).count() == 0
    assert {x["lang_pred"] for x in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_bpe(spark, odd, empty):
    path = queries.tokenizer_file()
    real = Tokenizer.from_file(path)
    texts = [r[1] or "" for r in ODD] + [r["text"] for r in spark.read.parquet(f"{PATH}/documents.parquet").select("text").collect()]
    texts += ["İstanbul ﬁ ǅ", "x\x1cy\x85z w", "''''s 'RE !!!?? a1b2", "\U0001f600‍\U0001f525 中文 한국", "ab" * 3000]
    tables = bpe.Vocabulary(path)
    for text, e in zip(texts, real.encode_batch(texts, add_special_tokens=False)):
        ids = tables.encode(text)
        assert ids.tolist() == e.ids
        assert tables.decode(ids).decode() == real.decode(e.ids, skip_special_tokens=False)
    one = bpe.encode(odd.where("doc_id = 10"), path)
    assert bpe.decode(one, path).first()["text"] == real.decode(one.first()["ids"], skip_special_tokens=False)
    got = bpe.digest(odd, path)
    assert got.count() == len(ODD) and got.where("doc_id = 1").first()["n_tokens"] == 0
    assert bpe.digest(empty, path).count() == 0


def test_near_copies(odd, empty):
    got = sorted([tuple(r) for r in nearcopies.link(odd).select("doc_id", "n_shingles", "component_id", "kept").collect()], key=str)
    want = {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (57, 5), 6: (57, 5), 7: (56, 5), 8: (56, 5), 9: (1, 9), 10: (1, 10)}
    for i, n, c, kept in got:
        if i is not None:
            assert (n, c) == want[i] and kept == (i == c)
    assert len(got) == len(ODD)
    left = nearcopies.without_copies(odd)
    assert left.columns == odd.columns and sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 9, 10]
    assert nearcopies.link(empty).count() == 0
    a, b = set(range(900)), set(range(60, 960))
    scaled = [nearcopies.sketch(np.array(sorted(zlib.crc32(b"%d" % i) * 2654435761 % (1 << 64) for i in s), np.uint64)).tobytes() for s in (a, b)]
    assert abs(nearcopies.estimate(*scaled, 900, 900) - len(a & b) / len(a | b)) < 0.12


def test_near_copies_are_decided_row_by_row(spark):
    text = {k: " ".join(f"{k}{i}" for i in range(80)) for k in "abcdef"}
    rows = [(1, text["a"], "x"), (1, text["b"], "x"), (2, text["b"] + " more", "x"), (3, text["c"], "x"), (3, text["a"] + " too", "x"),
            (None, text["d"], "x"), (None, text["e"], "x"), (None, text["c"] + " end", "x"), (4, text["f"], "z"), (4, text["f"], "y"), (None, None, "x"), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    want = sorted([(1, text["a"], "x"), (1, text["b"], "x"), (3, text["c"], "x"), (None, text["d"], "x"), (None, text["e"], "x"), (4, text["f"], "y"), (None, None, "x")], key=str)
    for frame in (docs, docs.repartition(5)):
        assert sorted(map(tuple, nearcopies.without_copies(frame).collect()), key=str) == want


def test_near_copy_families(spark):
    """Chains and separate components that share bands: every component is that of brute force."""
    rng = np.random.default_rng(5)
    rows, base = [], [f"v{i}" for i in rng.integers(0, 10 ** 6, 150)]
    for i in range(160):
        words = list(base if i % 4 else rows[rng.integers(0, len(rows))] if rows else base)
        for at in rng.integers(0, 150, rng.integers(1, 5)):
            words[at] = f"n{rng.integers(0, 10 ** 9)}"
        rows.append(words)
    sets = [{tuple(w[i:i + 5]) for i in range(146)} for w in rows]
    root = list(range(160))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(160):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id bigint, text string")
    assert {r["doc_id"]: r["component_id"] for r in nearcopies.link(df).collect()} == {i: find(i) for i in range(160)}


def test_mixing(odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD) and mixing.mix(empty).count() == 0
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(odd.repartition(5)).collect()), key=str)
    targets = {r["source"]: r["target"] for r in rows}
    assert math.isclose(sum(targets.values()), sum(r["size"] for r in rows))
    for source, target in targets.items():
        assert abs(sum(r["taken"] for r in rows if r["source"] == source) - target) <= 64 + 0.02 * target
    assert mixing.copies(odd).columns == odd.columns


def test_chat(spark):
    rows = [(1, 2, "assistant", "a<|im_end|>\n[INST]\\<"), (1, 1, "user", None), (1, 1, "user", None), (None, 0, None, "x"), (2, None, "assistant", ""), (3, 0, "us\ner\\n", "deep " * 40_000)]
    table = spark.createDataFrame([(*r, 7) for r in rows], "conv_id bigint, turn bigint, role string, text string, tree int")
    done = {r["conv_id"]: r for r in chat.conversations_of(chat.chains(table)).collect()}
    assert chat.read_back(done[1]["text"]) == [("user", ""), ("user", ""), ("assistant", rows[0][3])]
    assert chat.read_back(done[3]["text"]) == [(rows[5][2], rows[5][3])] and chat.read_back(done[None]["text"]) == [("", "x")]
    assert [chat.unescaped(done[1]["text"][m["start"]:m["stop"]]) for m in done[1]["mask"]] == [rows[0][3]]
    assert chat.digest(chat.conversations_of(chat.chains(table.limit(0)))).count() == 0
    tree = spark.createDataFrame([(1, 1, None, 0.0, "user", "q"), (1, 2, 1, 1.0, "assistant", "bad"), (1, 3, 1, 2.0, "assistant", "good"), (1, 4, 3, 0.5, "user", "more"), (1, 5, 2, 9.0, "user", "best")],
                                 "tree bigint, node bigint, parent bigint, score double, role string, text string")
    assert [t for _, t in chat.read_back(chat.conversations_of(tree).first()["text"])] == ["q", "bad", "best"]


VECTORS = "vec_id bigint, embedding array<double>, label int, node string, kind string"


def test_top_k(spark):
    rng = np.random.default_rng(3)
    x = {i: rng.standard_normal(8) for i in range(300)}
    x[51] = x[52] = x[50]
    rows = [(i, v.tolist(), 0, "", "") for i, v in x.items()] + [(400, None, 0, "", ""), (401, [1.0, None] + [0.0] * 6, 0, "", ""), (402, [float("nan")] * 8, 0, "", ""), (403, [1.0] * 3, 0, "", ""), (404, [], 0, "", "")]
    got = [tuple(r) for r in topk.search(spark.createDataFrame(rows, VECTORS)).collect()]
    q = {i: np.floor(256 * v).astype(int) for i, v in x.items()}
    want = []
    for i in range(0, 300, 50):
        top = sorted((-int(q[i] @ q[j]), j) for j in q if j != i)[:5]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(top)]
    assert sorted(got) == sorted(want)
    assert topk.search(spark.createDataFrame([], VECTORS)).count() == 0


def test_top_k_takes_every_finite_vector(spark):
    rng = np.random.default_rng(6)
    x = {i: rng.standard_normal(8) * [1.0, 1e4, 1e6, 1e9, 1e17, 1e60, 1e308 / 9][i % 7] for i in range(210)}
    x[7] = x[0].copy()
    x[7][0] = 1e40  # large only where others are zero
    x[14][0] = x[50][0] = 0.0
    got = topk.search(spark.createDataFrame([(i, v.tolist(), 0, "", "") for i, v in x.items()], VECTORS)).collect()
    q = {i: [math.floor(Fraction(a) * 256) for a in v.tolist()] for i, v in x.items()}
    want = []
    for i in range(0, 210, 50):
        top = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i)[:5]
        want += [(i, r + 1, j, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, j) in enumerate(top)]
    assert sorted(map(tuple, got)) == sorted(want)
    plain = {i: rng.standard_normal(8) * 9000 for i in range(120)}
    got = topk.search(spark.createDataFrame([(i, v.tolist(), 0, "", "") for i, v in plain.items()], VECTORS)).collect()
    q = {i: np.floor(256 * v).astype(int) for i, v in plain.items()}
    want = [(i, r + 1, j, -s) for i in (0, 50, 100) for r, (s, j) in enumerate(sorted((-int(q[i] @ q[j]), j) for j in q if j != i)[:5])]
    assert sorted(map(tuple, got)) == sorted(want)


def test_near_vectors(spark):
    rng = np.random.default_rng(4)
    rows, centre = [], rng.standard_normal((30, 16))
    for i in range(700):
        v = centre[i % 30] + rng.standard_normal(16) * 0.05 if i % 3 else rng.standard_normal(16)
        rows.append((i, v.tolist(), i % 2 if i % 50 else None, "", ""))
    rows += [(800, None, 0, "", ""), (801, [0.0] * 16, 0, "", ""), (802, rows[2][1], rows[2][2], "", ""), (803, [float("inf")] * 16, 1, "", ""), (804, [None] * 16, 1, "", "")]
    got = {r["vec_id"]: r for r in neighbours.link(spark.createDataFrame(rows, VECTORS)).collect()}
    ok = [r for r in rows if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    m = np.array([r[1] for r in ok])
    m /= np.linalg.norm(m, axis=1)[:, None]
    near = (m @ m.T >= 0.98) & (np.array([r[2] for r in ok])[:, None] == np.array([r[2] for r in ok])[None, :])
    want = {r[0]: int(n) - 1 for r, n in zip(ok, near.sum(1))}
    assert len(got) == len(rows) and all(r["n_links"] <= want.get(i, 0) for i, r in got.items())
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * sum(want.values())
    assert all(got[i]["kept"] and got[i]["n_links"] == 0 for i in (800, 801, 803, 804))
    assert neighbours.link(spark.createDataFrame([], VECTORS)).count() == 0


def test_near_vectors_of_tight_subgroups_are_one_component(spark):
    """Every list fills inside its subgroup; links between subgroups are found all the same."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal(32)
    base /= np.linalg.norm(base)
    rows = []
    for g in range(3):
        side = rng.standard_normal(32)
        side -= (side @ base) * base
        centre = base + 0.08 * side / np.linalg.norm(side)
        rows += [(100 * g + i, (centre + 1e-4 * rng.standard_normal(32)).tolist(), 1, "", "") for i in range(20)]
    rows += [(900 + i, rng.standard_normal(32).tolist(), 1, "", "") for i in range(40)]
    got = {r["vec_id"]: r for r in neighbours.link(spark.createDataFrame(rows, VECTORS)).collect()}
    assert {(r["n_links"], r["component_id"]) for i, r in got.items() if i < 900} == {(59, 0)}
    assert all(r["n_links"] == 0 and r["kept"] for i, r in got.items() if i >= 900)


def test_main_text(spark):
    page = ("<html><body><nav>Home</nav><div class='cookie-notice'>We use</div><article><h1>T &amp; t</h1><p>One\n <b>two</b><br>three<p>Four&nbsp;five"
            "<form>Mail</form><script>if (a<b) x</script></article><aside>More</aside><div id=comments><p>First!</div><footer>F</footer>")
    rows = [(1, "http://h.example/1", page, 0), (2, None, None, 0), (3, "no url", "", 0), (4, "http://h.example/2", "plain &lt;text", 0), (5, "http://h.example/3", "<div>" * 3000 + "deep", 0)]
    for i in range(6, 12):
        rows.append((i, "http://w.example/x", f"<body><div class=top>Site name</div><div class=main><p>Text number {i} is here</p><p>and goes on {i * 7}</p></div><div class=end>All rights</div></body>", 0))
    got = {r["page_id"]: r for r in pages.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string, wrapper int")).collect()}
    assert got[1]["text"] == "T & t\nOne two three\nFour five"
    assert got[2]["text"] == got[3]["text"] == "" and got[4]["text"] == "plain <text" and got[5]["text"] == "deep"
    assert got[7]["text"] == "Text number 7 is here\nand goes on 49" and got[7]["n_chars"] == len(got[7]["text"])


PAGE = "page_id bigint, url string, html string"


def texts_of(spark, rows):
    return {r["page_id"]: r["text"] for r in pages.main_texts(spark.createDataFrame(rows, PAGE)).collect()}


def test_main_text_of_containers_with_constant_text_of_their_own(spark):
    shapes = {"a": "<body><article>By Staff<p>Varying text {0}</p></article>", "b": "<body><div class=story>Advertisement<p>Varying text {0}</p></div>", "c": "<body>Skip to content<div>Varying text {0}</div>"}
    rows = [(100 * n + i, f"http://{h}.example/{i}", shape.format(i)) for n, (h, shape) in enumerate(shapes.items()) for i in range(4)]
    assert texts_of(spark, rows) == {r[0]: f"Varying text {r[0] % 100}" for r in rows}


def test_main_text_of_many_templates_of_a_host(spark):
    rows = []
    for k in range(8):  # more templates than a few pages would show; two main parts each
        for i in range(5):
            n = 10 * k + i
            rows.append((n, "http://t.example/x", f"<body><div class=top{chr(97 + k)}>Site {k}</div><div class=one><p>First part {n}</p><p>{'often' if i < 3 else 'seldom'} said</p></div><div class=two>Other part {n}</div>"))
    got = texts_of(spark, rows)
    assert got == {r[0]: f"First part {r[0]}\n{'often' if r[0] % 10 < 3 else 'seldom'} said\nOther part {r[0]}" for r in rows}


def test_main_text_outside_and_of_several_articles(spark):
    page = "<body><div class=top>Site</div><article><p>One {0}</article><article><p>Two {0}</article><div class=more>Beside {0}</div>"
    rows = [(i, "http://many.example/x", page.format(i)) for i in range(4)] + [(9, "http://few.example/x", page.format(9))]
    assert texts_of(spark, rows) == {i: f"One {i}\nTwo {i}\nBeside {i}" for i in range(4)} | {9: "One 9\nTwo 9"}
    same = [(i, "http://s.example/x", f"<body><article><p>All the same</article><div class=more>{i}</div>") for i in range(4)]
    assert texts_of(spark, same) == {i: f"All the same\n{i}" for i in range(4)}


def test_language_model(spark, odd, empty):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    assert lm.score(empty).count() == 0
    for frame in (docs, odd):
        texts = [(r["doc_id"], (r["text"] or "").encode().split()) for r in frame.select("doc_id", "text").collect()]
        texts = [(i, b" ".join(w).lower().split() + [None]) for i, w in texts]
        counts = Counter(w for i, ws in texts if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
        total, distinct = sum(counts.values()), len(counts)
        rows = lm.score(frame).collect()
        want = sorted((-1 if i is None else i, len(w), sum(counts[x] > 0 for x in w), round(sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w), 3)) for i, w in texts)
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 3)) for r in rows) == want
        assert all(math.isfinite(r["score"]) and r["train_tokens"] == total for r in rows)
    held = lm.score(docs).where("held_out").agg(F.sum("score").alias("a"), F.sum("base_score").alias("b")).first()
    assert held["a"] > held["b"]


def test_mixed_copies_come_near_the_targets(spark):
    rows = [(i, "abc"[i % 3], " ".join(f"w{i}x{j}" for j in range(40 + i % 90))) for i in range(1800)]
    docs = spark.createDataFrame([*rows, (5000, None, None), (5001, None, "")], "doc_id long, source string, text string")
    out = mixing.copies(docs).collect()
    size, words, times = collections.Counter(), collections.Counter(), collections.Counter()
    for _, source, text in rows:
        size[source] += len(text.split())
    for r in out:
        words[r["source"]] += len((r["text"] or "").split())
        times[r["doc_id"]] += 1
    for source, weight in zip("abc", (5, 2, 1)):
        target = sum(size.values()) * weight / 8
        assert abs(words[source] - target) < 0.12 * target
    assert max(times.values()) <= 3 and times[5000] == times[5001] == 1
    assert times == collections.Counter(r["doc_id"] for r in mixing.copies(docs.repartition(5)).collect())


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 50, "d": 3, "e": 700, None: 90}, {f"s{i}": 1 + 37 * i % 101 for i in range(20)}])
def test_targets_beside_resharing_step_by_step(spark, sizes):
    rows = [(i, s, n) for i, (s, n) in enumerate(sizes.items())]
    found = {r["source"]: r["target"] for r in mixing.shares(spark.createDataFrame(rows, "doc_id long, source string, size long"), (5, 2, 1), 3).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(sizes), {}
    while True:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        open_ -= over
    target |= {s: level * weight[s] for s in open_}
    assert found == pytest.approx(target) and sum(found.values()) == pytest.approx(sum(sizes.values()))


def test_slots_of_an_epoch_take_every_block_once(spark):
    sizes = [1, 64, 65, 130, 700, 64 * 97, 64 * 1000 + 1]
    sources = spark.createDataFrame([(i, n, 3.0 * n) for i, n in enumerate(sizes)], "ordinal long, source_size long, target double")
    dealt = mixing.deal(sources, 64, 3, 100).groupBy("ordinal", "block").agg(F.count(F.lit(1)).alias("times")).collect()
    assert {r["times"] for r in dealt} == {3}
    blocks = collections.Counter(r["ordinal"] for r in dealt)
    assert all(blocks[i] == -(-n // 64) for i, n in enumerate(sizes))
    assert all(0 <= r["block"] < blocks[r["ordinal"]] for r in dealt)
