"""Small inputs with results worked out by hand or by plain Python."""

import itertools
import math
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillframe.corpus import tokens as tok
from quillframe.corpus import weights
from quillframe.functions import arrays, dates, numeric, text
from quillframe.operators import aggregate, inspect, joins, missing, neighbours, ordering, project, timeseries, windows
from quillframe.registry import load_catalog
from quillframe.sources import accesslog, files, fixedwidth
from quillframe.stats import distributions as dist
from quillframe.stats import inference

def log_line(**changes):
    """A line put together from the fields of the public access-log format, each with a value of its own."""
    values = {name: f"{name}-value" for name in accesslog.FIELDS} | {
        "date_time": "[05/Feb/2019:10:15:30 +0200]", "status": "304", "bytes_sent": "12", "total_time": "7",
        "request": '"PUT /a%20b?c=d HTTP/2"', "referer": '"https://start.example/x y"', "user_agent": '"probe (v=1; \'q\') z"'}
    return " ".join((values | changes).values())


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, f, kind="string"):
    return [r[0] for r in column(spark, values, kind).orderBy("i").select(f(F.col("v"))).collect()]


def test_log_lines(spark):
    lines = [log_line(), log_line(date_time="[9/Dec/2020:23:59:59 -1130]", referer="-", user_agent="-", bytes_sent="-"),
             log_line(request='"no quote at the end'), log_line(date_time="[31/Foo/2020:00:00:00 +0000]"), log_line(date_time="no-brackets"),
             "", "  " + log_line(key="a\x1fb") + " further fields  ", None]
    rows = accesslog.parse(spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string").orderBy("i").coalesce(1)).collect()
    assert [r["ok"] for r in rows] == [True, True, False, False, False, False, False, False]
    first = rows[0].asDict()
    assert first["user_agent"] == "probe (v=1; 'q') z" and first["referer"] == "https://start.example/x y" and first["request"] == "PUT /a%20b?c=d HTTP/2"
    assert all(first[f] == f"{f}-value" for f in ("bucket_owner", "bucket", "ip", "requester", "request_id", "operation", "key", "error", "object_size", "turn_around_time"))
    assert (first["log_date"], first["log_time"], first["log_zone"], first["status"]) == ("2019-02-05", "2019-02-05 10:15:30", "+0200", "304")
    assert (rows[1]["log_time"], rows[1]["log_zone"], rows[1]["referer"], rows[1]["user_agent"]) == ("2020-12-09 23:59:59", "-1130", "-", "-")


def test_log_lines_with_more_fields_and_daily_counts(spark):
    frame = spark.createDataFrame([(log_line() + " tail of more fields",), (log_line(),), (log_line(referer="-"),), ("rest",), ("rest",)], "line string")
    parsed = accesslog.parse(frame)
    assert parsed.where("ok").count() == 3
    plain = {(r["user_agent"], r["error_line"]): r["n"] for r in accesslog.daily_requests(parsed).collect()}
    assert plain == {("probe (v=1; 'q') z", None): 3, (None, "rest"): 2}
    older = {r["user_agent"]: r["n"] for r in accesslog.daily_requests(parsed, compat=True).where("error_line is null").collect()}
    assert older == {"https://start.example/x y": 2, "-": 1}


def test_clean_names(spark):
    dirty = ["a#b!c?", "##", " mIXED  case\t", "already Fine", "x-y o'z", ""]
    assert apply(spark, dirty, text.clean_names) == ["Abc", "", "Mixed  Case", "Already Fine", "X-y O'z", ""]


def test_mixed_dates(spark):
    # A value for each format in turn, then values that miss one by a sign, a number or a word.
    fits = {"1999-12-31": "1999-12-31", "2000-Feb-29": "2000-02-29", "02-28-2001": "2001-02-28", "20240229": "2024-02-29", "3 June, 1987": "1987-06-03", "22nd of August, 2003": "2003-08-22"}
    misses = ["2001-02-29", "13-13-2001", "1999/12/31", "22nd August 2003", "tomorrow", ""]
    got = apply(spark, [*fits, *misses], dates.parse_mixed)
    assert [str(d) for d in got] == [*fits.values(), *["None"] * len(misses)]


def test_sentence_cleaner(spark):
    got = apply(spark, ["It's (really)  good, isn't it?"], text.clean_sentence)
    assert got == ["it 's \\( really \\) good , is n't it \\?"]


@pytest.mark.parametrize("name", ["capitalize", "swapcase", "strip"])
def test_case_functions(spark, name):
    values = ["aB", "  two WORDS here\t", "q", "", "1st", "ÉcOLE"]
    assert apply(spark, values, getattr(text, name)) == [getattr(v, name)() for v in values]


def test_pad_and_find(spark):
    values = ["ab", "-7", "abcdefghijk", "xyx"]
    for w in (5, 6):
        assert apply(spark, values, lambda c, w=w: text.center(c, w, "*")) == [v.center(w, "*") for v in values]
        assert apply(spark, values, lambda c, w=w: text.zfill(c, w)) == [v.zfill(w) for v in values]
        assert apply(spark, values, lambda c, w=w: text.ljust(c, w)) == [v.ljust(w) for v in values]
    assert apply(spark, values, lambda c: text.find(c, "x")) == [v.find("x") for v in values]
    assert apply(spark, values, lambda c: text.rfind(c, "x")) == [v.rfind("x") for v in values]
    assert [tuple(p) for p in apply(spark, ["a-b-c", "abc"], lambda c: text.rpartition(c, "-"))] == [("a-b", "-", "c"), ("", "", "abc")]


@pytest.mark.parametrize("name", ["isalnum", "isalpha", "isdigit", "isspace", "istitle", "islower", "isupper"])
def test_character_classes(spark, name):
    values = ["abc", "Abc Def", "ABC", "12", "a1", " ", "", "Ärger", "x!"]
    assert apply(spark, values, lambda c: text.is_class(c, name)) == [getattr(v, name)() for v in values]


def test_special_functions(spark):
    xs = [0.5, 1.0, 2.5, 10.0]
    np.testing.assert_allclose(apply(spark, xs, numeric.ln_gamma, "double"), [math.lgamma(x) for x in xs], atol=1e-12)
    np.testing.assert_allclose(apply(spark, xs, numeric.erf, "double"), [math.erf(x) for x in xs])
    np.testing.assert_allclose(apply(spark, [0.1, 0.9], lambda c: numeric.erf(numeric.erfinv(c)), "double"), [0.1, 0.9])
    assert apply(spark, [-7, 7], lambda c: numeric.floor_div(c, F.lit(2)), "int") == [-4, 3]
    assert apply(spark, [-7, 7], lambda c: numeric.floor_mod(c, F.lit(-2)), "int") == [-7 % -2, 7 % -2]


def test_array_slices(spark):
    seq = list(range(15))
    cases = [(None, None, 1), (3, 8, 1), (-12, -7, 1), (None, None, 2), (20, None, 1), (-100, 2, 1)]
    for a, b, c in cases:
        assert apply(spark, [seq], lambda x, a=a, b=b, c=c: arrays.slice_step(x, a, b, c), "array<int>") == [seq[a:b:c]]
    assert apply(spark, [[1, 2, 1]], lambda x: arrays.remove_first(x, 1), "array<int>") == [[2, 1]]


def test_fixed_width_dictionary(spark, tmp_path):
    fields = fixedwidth.parse_dictionary(['infile dictionary {', '  _column(1)  str12  caseid  %12s  "RESPONDENT ID"',
                                          '  _column(13)  byte  PregOrdr  %2f  "ORDER"'])
    assert [(f.start, f.end, f.type, f.name) for f in fields] == [(1, 13, "string", "caseid"), (13, None, "tinyint", "pregordr")]
    (tmp_path / "f.dat").write_text("          1  2\n          2   \n")
    assert [tuple(r) for r in fixedwidth.read_fixed_width(spark, str(tmp_path), fields).collect()] == [("1", 2), ("2", None)]


def test_durations(spark):
    assert apply(spark, ["2:05:09", "0:0:1", "x", None], files.duration_seconds) == [7509, 1, None, None]


def test_nan_becomes_null(spark):
    d = spark.createDataFrame([(1.0,), (float("nan"),)], "v double")
    assert [r["v"] for r in files.nan_to_null(d).collect()] == [1.0, None]
    assert missing.missing_summary(d).first()["n_missing"] == 1


def test_null_safe_merge(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    assert joins.merge(a, a, on=["k"]).count() == 1
    assert joins.merge(a, a, on=["k"], null_keys_match=True).count() == 2


def test_trim_nothing(spark):
    d = column(spark, [1.0, 2.0, 3.0], "double")
    assert inference.trimmed(d, [], "v", 0.1).first()["mean"] == 2.0


def test_cohen_uses_population_variance(spark):
    d = spark.createDataFrame([(1.0, True), (3.0, True), (2.0, False), (6.0, False)], "v double, g boolean")
    assert inference.cohen_d(d, "v", F.col("g")).first()["d"] == pytest.approx(-2 / math.sqrt(2.5))


def test_odds(spark):
    assert apply(spark, [0.5, 1.0], dist.odds, "double") == [1.0, math.inf]


def test_month_anchors(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2015-01-01', DATE '2015-03-31', INTERVAL 1 DAY)) AS day")
    assert sorted(str(r[0]) for r in timeseries.anchors(days, "BM").collect()) == ["2015-01-30", "2015-02-27", "2015-03-31"]


def test_keyword_case(spark):
    d = column(spark, ["Salt and Pepper", "salt"])
    assert [r["Salt"] for r in aggregate.keyword_flags(d, "v", ["Salt"]).orderBy("i").collect()] == [True, True]
    assert [r["Salt"] for r in aggregate.keyword_flags(d, "v", ["Salt"], case_sensitive=True).orderBy("i").collect()] == [True, False]


def test_skip_grams_and_windows(spark):
    d = column(spark, ["the quick brown fox", "héllo wörld, again", "a"])
    words = [v.split() for v in ("the quick brown fox", "h llo w rld , again", "a")]
    want = sorted((i, w, ws[q]) for i, ws in enumerate(words) for p, w in enumerate(ws) for q in range(max(0, p - 2), min(len(ws), p + 3)) if q != p)
    assert sorted((r["i"], r["center"], r["context"]) for r in tok.skip_grams(d, "i", "v", 2).collect()) == want
    texts = ["the quick brown fox", "héllo wörld, again", "a"]
    want = sorted((i, s, t[s:s + 5], t[s + 5]) for i, t in enumerate(texts) for s in range(0, len(t) - 5))
    assert sorted(tuple(r) for r in tok.char_windows(d, "i", "v", 5, 1).collect()) == want


def test_padding_and_characters(spark):
    assert apply(spark, [[1, 2, 3], [1, 2, 3, 4, 5]], lambda c: tok.pad_front(c, 4), "array<bigint>") == [[0, 1, 2, 3], [2, 3, 4, 5]]
    assert apply(spark, ["az b"], lambda c: tok.char_text(tok.char_ids(c))) == ["az b"]


def test_batches_are_whole_and_stable(spark):
    d = spark.range(50)
    a = weights.batches(d, ["id"], 8, 2, seed=1).toPandas().sort_values(["epoch", "id"]).reset_index(drop=True)
    b = weights.batches(d.repartition(5), ["id"], 8, 2, seed=1).toPandas().sort_values(["epoch", "id"]).reset_index(drop=True)
    assert a.equals(b) and (a.groupby(["epoch", "batch"]).size() <= 8).all() and len(a) == 100
    assert not a[a.epoch == 0]["batch"].reset_index(drop=True).equals(a[a.epoch == 1]["batch"].reset_index(drop=True))


@pytest.mark.parametrize("metric", ["l2", "l1"])
def test_nearest_with_a_hot_cluster(spark, metric):
    rng = np.random.default_rng(3)
    v = np.where(rng.random((300, 1)) < 0.4, 0.0, rng.normal(size=(300, 5)))  # 40 % are copies of one point
    df = spark.createDataFrame([(i, list(map(float, x))) for i, x in enumerate(v)], "id int, v array<double>")
    got = neighbours.nearest(df, df, "id", "v", 3, metric=metric, rows=32).toPandas()
    d = np.abs(v[:, None] - v[None]).sum(-1) if metric == "l1" else np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1, kind="stable")[:, :3]
    assert got.sort_values(["id", "rank"])["neighbour"].to_numpy().reshape(300, 3).tolist() == want.tolist()


def test_resampling(spark, monkeypatch):
    monkeypatch.setattr(inference, "LEAF_ROWS", 40)
    df = spark.range(200).select("id", (F.col("id") % 17).cast("double").alias("v"), (F.col("id") < 80).alias("g"))
    median = inference.quantile_statistic(df, "v", 0.5, name="median")
    stats = [inference.MEAN, inference.STD, median]

    def table(frame, **options):
        return inference.resampled(frame, "v", ["id"], 30, stats, seed=2, **options).orderBy("statistic", "iter").toPandas()

    a, b = table(df, side=F.col("g")), table(df.repartition(7), side=F.col("g"))
    assert np.allclose(a[["first", "rest"]], b[["first", "rest"]])
    v = np.array([i % 17 for i in range(200)], float)
    seen = a[a["iter"] == 0].set_index("statistic")
    assert np.isclose(seen.loc["mean", "first"], v[:80].mean()) and np.isclose(seen.loc["std", "rest"], v[80:].std())
    assert seen.loc["median", "first"] == np.sort(v[:80])[39] and seen.loc["median", "rest"] == np.sort(v[80:])[59]
    means = a[(a["statistic"] == "mean") & (a["iter"] > 0)]
    assert means["first"].nunique() > 10 and np.allclose(80 * means["first"] + 120 * means["rest"], v.sum())  # a split, not a draw with replacement
    boot = table(df)
    means = boot[(boot["statistic"] == "mean") & (boot["iter"] > 0)]["first"]
    assert abs(means.mean() - v.mean()) < 0.3 and abs(means.std() - v.std() / math.sqrt(200)) < 0.15
    assert set(boot[boot["statistic"] == "median"]["first"]) <= set(v)
    whole = inference.bootstrap_stats(df, "v", ["id"], 40, seed=2).toPandas()
    assert np.allclose(whole["cv"], whole["std"] / whole["mean"])


def test_permutation_shares_follow_the_exact_test(spark):
    first, rest = [1.0, 4.0, 6.0, 9.0], [2.0, 3.0, 8.0, 12.0, 15.0]
    df = spark.createDataFrame([(i, x, i < 4) for i, x in enumerate(first + rest)] + [(99, None, True)], "id int, v double, g boolean")
    every = [abs(np.mean(c) - (sum(first + rest) - sum(c)) / 5) for c in itertools.combinations(first + rest, 4)]
    seen = abs(np.mean(first) - np.mean(rest))
    got = inference.permutation_shares(df, "v", F.col("g"), ["id"], 1500, [inference.MEAN], seed=1).first()
    assert np.isclose(got["difference"], seen) and abs(got["p"] - np.mean([d >= seen - 1e-9 for d in every])) < 0.05
    test = inference.permutation_test(df, "v", F.col("g"), ["id"], 100, seed=1).first()
    assert np.isclose(test["mean_diff"], seen) and 0 <= test["mean_p"] <= 1 and 0 <= test["std_p"] <= 1


def test_draws_of_a_node_add_up_over_its_leaves(monkeypatch):
    monkeypatch.setattr(inference, "LEAF_ROWS", 50)
    counts = {int(n): int(c) for n, c in zip(np.random.default_rng(1).permutation(1 << 16)[:3000], np.random.default_rng(2).integers(1, 9, 3000))}
    tree, total = inference.SplitTree(counts), sum(counts.values())
    assert 0 < tree.depth <= 16
    for replace in (False, True):
        for i in (1, 2):
            drawn = [tree.drawn(leaf, total // 3, 5, i, replace) for leaf in range(1 << tree.depth)]
            assert sum(drawn) == total // 3
            if not replace:
                assert all(k <= n for k, n in zip(drawn, tree.levels[tree.depth]))


def test_draws_follow_the_distribution(spark):
    df = column(spark, [1.0] * 70 + [2.0] * 30, "double")
    got = dist.draw(df, "v", spark.range(4000), seed=3).groupBy("v").count().toPandas().set_index("v")["count"]
    assert abs(got[1.0] / 4000 - 0.7) < 0.03 and got.sum() == 4000


def test_linear_svc_learns_from_every_element(spark):
    rows = [(i, [0.1 * ((i * k) % 7) for k in range(63)] + [1.0 if i % 2 else -1.0], 1 if i % 2 else 8) for i in range(200)]
    t = SimpleNamespace(embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    got = load_catalog()["L15_linear_svc"].build(t).collect()
    assert got and all((r["prediction"] == 1.0) == (r["vec_id"] % 2 == 1) for r in got)


def test_null_keys_and_values(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, None, 4.0), (3, "a", None), (4, "b", 6.0), (None, "b", 8.0)], "i int, k string, v double")
    kept = aggregate.transform_groups(df, ["k"], {"m": F.avg("v")}, {"d": F.col("v") - F.col("m")}).orderBy("v").collect()
    assert [(r["v"], r["d"]) for r in kept] == [(None, None), (2.0, 0.0), (4.0, None), (6.0, -1.0), (8.0, 1.0)]
    fitted = inference.residuals(df, "i", "v", ["k"])
    assert fitted.count() == 5 and fitted.where("k is null").first()["fitted"] is None
    assert [r["v"] for r in inspect.head(df, ["v"], 2).collect()] == [2.0, 4.0] and [r["v"] for r in inspect.tail(df, ["v"], 2).collect()] == [None, 8.0]
    order = {r["v"]: r["position"] for r in ordering.arg_sort(df, ["v"]).collect()}
    assert order == {2.0: 0, 4.0: 1, 6.0: 2, 8.0: 3, None: 4}
    assert {r["v"]: r["rank"] for r in windows.first_come_ranks(df, "v", ["i"]).collect()} == {None: None, 2.0: 1, 4.0: 2, 6.0: 3, 8.0: 4}
    assert {r["v"]: r["seen"] for r in windows.seen_before(df, ["k"], ["v"]).collect()} == {None: False, 2.0: True, 4.0: False, 6.0: False, 8.0: True}
    rolled = windows.rolling(df.where("i is not null"), "i", "v", {"s": F.sum("v")}, 1, 0).orderBy("i").collect()
    assert [r["s"] for r in rolled] == [None, 6.0, None, None]
    ranked = windows.running(df, [], ["i"], {"total": "v"}).collect()
    assert {r["i"]: r["total"] for r in ranked} == {1: 2.0, 2: 6.0, 3: 6.0, 4: 12.0, None: 20.0}
    smallest = ordering.smallest_per_group(df, ["k"], ["v"], 1)
    assert {r["k"]: r["v"] for r in smallest.collect()} == {"a": 2.0, "b": 6.0, None: 4.0}


def test_transposing_a_wide_frame(spark):
    labels = list(range(1100))
    df = spark.range(1100).select("id", *[(F.col("id") * 1000 + i).alias(f"c{i}") for i in range(920)])
    wide = project.transpose(df, "id", labels)
    assert len(wide.columns) == 1101 and len(labels) * 920 > 1_000_000
    row = wide.where("column_name = 'c7'").first()
    assert row["0"] == "7" and row["1099"] == "1099007" and wide.select("column_name").distinct().count() == 920
