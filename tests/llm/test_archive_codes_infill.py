"""Archives, part codes and fill-in-the-middle beside plain versions; odd rows included."""

import gzip
import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow.fs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillframe.llm import archive, infill, partcodes

BIG = "<p>" + "long payload " * 20_000
PAGES = [
    (5, "http://www.B.example.org:80/x?y=1#z", "a" * 100), (3, "https://b.example.org/x?y=1", "a" * 100), (9, None, "a" * 100),
    (1, "http://c.test/short", "b" * 99), (2, "http://c.test/short", "b" * 99), (4, "http://c.test/null", None), (6, "", ""),
    (None, "http://d.test/", "c" * 200), (None, "http://d.test/", "c" * 200), (7, "http://e.test/é ü\n", "ü" * 50), (8, "not a url", "ü" * 50),
    (10, "http://f.test/", BIG), (10, "http://f.test/", BIG), (11, "http://" + "g" * 3000 + ".test/", BIG), (None, None, BIG), (12, "http://c.test/crlf", "\r\n\r\nWARC/1.1\r\n" * 9),
]
SCHEMA = "page_id bigint, url string, html string, key int, size string, digest int, file int"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, 1, "s", 2, 3) for r in PAGES], SCHEMA)


def plain_captures(rows):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        ids = [i for i, _, h in rows if (h or "").encode() == data and i is not None]
        first = min(ids) if ids and len(data) >= 100 else None
        again = first is not None and page_id != first
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 7])
def test_archive_round_trip(spark, pages, partitions):
    assert sorted((tuple(r) for r in archive.digest(pages.repartition(partitions)).collect()), key=str) == plain_captures(PAGES)
    assert archive.digest(pages.where("false")).count() == 0


def test_archive_lookups_blocks_and_payloads(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://{'abc'[i % 3]}.site{i % 7}.org/{i % 11}", f"page {i % 40} " * 30) for i in range(500)] + [(None, "http://a.site1.org/1", "x" * 300)] * 50
    written = archive.write(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3), f"{tmp_path}/records")
    made = archive.Archive(f"{tmp_path}/records", f"{tmp_path}/index", archive.index(written, f"{tmp_path}/index", rows=8, blocks=4))
    contents = made.table_of_contents()
    assert len(contents) > 10 and [c[0] for c in contents] == sorted(c[0] for c in contents)
    asked = spark.createDataFrame([("http://b.site2.org/5", i) for i in range(500)] + [("http://a.site1.org/1", None), ("http://nowhere.org/", 1), ("zz", 1), (None, None)] * 2, "url string, page_id bigint")
    want = sorted([(i, u) for i, u, _ in rows if u == "http://b.site2.org/5" or (i is None and u == "http://a.site1.org/1")], key=str)
    found = archive.read(made, archive.lookup(made, asked)).collect()
    assert sorted([(r["page_id"], r["url"]) for r in found], key=str) == want
    texts = {i: t for i, _, t in rows}
    assert all(bytes(r["payload"]).decode() == texts[r["page_id"]] for r in found if r["record_type"] == "response")
    under = archive.captures_under(made, b"org,site3")
    assert sorted(r["page_id"] for r in under.collect()) == [i for i, u, _ in rows if i is not None and ".site3.org" in u]
    assert archive.captures_under(made, b"").count() == len(rows) and archive.captures_under(made, b"zz").count() == 0
    # A damaged record is reported, never given.
    fs, path = archive.place(made.records)
    file = fs.get_file_info(pyarrow.fs.FileSelector(path))[0].path
    with open(file, "r+b") as f:
        members = f.read()
        f.seek(0)
        f.write(gzip.compress(b"WARC/1.1\r\n\r\n" + b"?" * 40)[:60] + members[60:])
    with pytest.raises(Exception):
        archive.read(made, written).collect()


@pytest.mark.parametrize("url, key", [("http://WWW.Example.com/a?b", "com,example)/a?b"), ("https://u@x.example.com:8443", "com,example,x:8443)/"), ("mailto:x", "mailto:x"), (None, "")])
def test_url_keys(url, key):
    assert archive.url_key(url) == key.encode()


def test_long_keys_stay_bounded_and_apart():
    keys = {archive.url_key("http://x.org/" + "p" * 5000 + c) for c in "abc"}
    assert len(keys) == 3 and max(map(len, keys)) == archive.KEY_BYTES


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = sorted(((i, label, [math.floor(1024 * Fraction(x)) for x in v]) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)),
                  key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    size = len(kept[0][2]) // parts
    cells = [[v[p * size:(p + 1) * size] for _, _, v in kept] for p in range(parts)]
    books = [list(map(list, c[:entries])) for c in cells]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for x in cells[p]:
                groups.setdefault(near(x, books[p])[1], []).append(x)
            for i, xs in groups.items():
                books[p][i] = [sum(c) // len(xs) for c in zip(*xs)]
    last = [[near(x, books[p]) for x in cells[p]] for p in range(parts)]
    sha = hashlib.sha256(",".join(str(n) for b in books for e in b for n in e).encode()).hexdigest()
    errors = [sum(last[p][k][0] for p in range(parts)) for k in range(len(kept))]
    totals = {}
    for (_, label, _), e in zip(kept, errors):
        totals[label] = totals.get(label, 0) + e
    top = partcodes.LAST
    return sorted([(i, "".join(f"{last[p][k][1]:02x}" for p in range(parts)), min(errors[k], top), min(totals[label], top), sha) for k, (i, label, _) in enumerate(kept)], key=str)


EMBEDDINGS = "vec_id bigint, embedding array<double>, label int, v int, far string, _id int"


@pytest.mark.parametrize("case", ["usual", "odd", "few", "huge"])
def test_codes(spark, case):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)], int(i % 3) or None) for i in range(400)]
    if case == "odd":
        rows += [(5, rows[6][1], None), (None, rows[7][1], 2), (None, rows[7][1], 2), (900, None, 1), (901, [1.0, None] * 4, 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] * 8, 1), *[(904, [0.5] * 8, 9)] * 150]
    if case == "few":
        rows = rows[:5] + [(7, rows[0][1], 1)]
    if case == "huge":
        rows = rows[:60] + [(70 + i, [1e30 * x for x in rows[i][1]], 1) for i in range(20)] + [(99, [1e308, -1e308] * 4, 4)]
    frame = spark.createDataFrame([(*r, 1, "f", 2) for r in rows], EMBEDDINGS)
    got = sorted((tuple(r) for r in partcodes.digest(frame.repartition(5)).collect()), key=str)
    assert got == plain_codes(rows)


def test_codes_drop_other_lengths_and_prune(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16)) * 4
    rows = [(i, [float(x) for x in centres[i % 40] + rng.normal(size=16) * 0.05], 0) for i in range(2000)]
    odd = [(5000, [1.0] * 12, 0), (5001, [1.0] * 15, 0), (5002, [], 0)]
    frame = spark.createDataFrame([(*r, 1, "f", 2) for r in rows + odd], EMBEDDINGS)
    coded = partcodes.encode(partcodes.learn(frame))
    assert coded.count() == len(rows)
    assert coded.agg(F.avg("evaluated")).first()[0] < 0.5 * 4 * 256
    assert partcodes.digest(frame.where("false")).count() == 0
    assert partcodes.learn(frame.where("vec_id = 5001")) is None


DOCS = [(1, None), (2, ""), (3, "a"), (None, "no id, é\U0001f600 and more"), (4, "has <M> inside"), (5, "<P"), (6, "<" * 50), (7, "word " * 100_000), (8, "\U0001f600é" * 40), (8, "\U0001f600é" * 40)]


def plain_infill(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_infill(spark):
    rows = DOCS + [(100 + i, f"text <number {i} of> é many" * (i % 5)) for i in range(300)]
    frame = spark.createDataFrame([(i, t, "other", 5) for i, t in rows], "doc_id bigint, text string, form string, n int")
    out = infill.transform(frame, keep=("form", "n", "text"))
    assert out.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = sorted([(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], bytes(r["output"]).decode()) for r in out.collect()], key=str)
    assert got == sorted([(i, *plain_infill(i, t)) for i, t in rows], key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = infill.restore(out).collect()
    assert all(bytes(r["restored"]).decode() == (r["text"] or "") for r in back)
    assert infill.digest(frame).count() == len(rows) and infill.digest(frame.where("false")).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab<PSM>é\U0001f600", max_size=30), st.integers(0, 30), st.integers(0, 30), st.sampled_from(["psm", "spm"]))
def test_rotations_invert(text, a, b, form):
    data = text.encode()
    if any(m in data for m in (infill.PREFIX, infill.SUFFIX, infill.MIDDLE)):
        return
    at = [*infill.characters(data).tolist(), len(data)]
    first, second = sorted((min(a, len(at) - 1), min(b, len(at) - 1)))
    assert infill.restored(bytes(infill.arranged(data, at[first], at[second], form)), form) == data
