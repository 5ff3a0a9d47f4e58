"""Distributions and inference."""

from functools import reduce

from pyspark.sql import functions as F

from quillframe.catalog.aggregates import rnd
from quillframe.functions import numeric
from quillframe.plans.quantiles import quantiles
from quillframe.registry import query
from quillframe.stats import distributions as dist
from quillframe.stats import inference as inf

PMF = "(SELECT l_returnflag AS f, l_quantity AS x, count(*) AS n FROM lineitem GROUP BY ALL)"


def flag(t, f):
    return t.lineitem.filter(F.col("l_returnflag") == f).groupBy("l_quantity").agg(F.count("*").alias("n"))


@query("Q01_pmf", "SELECT l_quantity, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 12) AS p FROM lineitem GROUP BY 1")
def _(t):
    return rnd(dist.pmf(t.lineitem, "l_quantity"), p=12)


@query("Q02_pmf_moments", f"""
WITH p AS (SELECT f, x, n / sum(n) OVER (PARTITION BY f) AS p FROM {PMF}), m AS (SELECT f, sum(p * x) AS m FROM p GROUP BY 1)
SELECT f AS l_returnflag, round(max(m), 9) AS mean, round(sum(p * pow(x - m, 2)), 9) AS var, round(sqrt(sum(p * pow(x - m, 2))), 9) AS std,
 arg_max(x, (p, x)) AS mode FROM p JOIN m USING (f) GROUP BY 1""")
def _(t):
    return rnd(dist.pmf_summary(dist.pmf(t.lineitem, "l_quantity", ["l_returnflag"]), "l_quantity", ["l_returnflag"]), mean=9, var=9, std=9)


@query("Q03_cdf_percentiles", """
SELECT l_returnflag, quantile_disc(l_extendedprice, 0.1) AS p10, quantile_disc(l_extendedprice, 0.5) AS p50, quantile_disc(l_extendedprice, 0.9) AS p90,
 round(count(*) FILTER (l_extendedprice <= 20000) / count(*) * 100, 9) AS rank FROM lineitem GROUP BY 1""")
def _(t):
    q = quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, kind="disc")
    return rnd(q.join(dist.percentile_rank(t.lineitem, "l_extendedprice", 20000, ["l_returnflag"]), "l_returnflag"), rank=9)


@query("Q04_compare", f"""
SELECT round(sum(CASE WHEN a.x < b.x THEN a.n * b.n ELSE 0 END) / sum(a.n * b.n), 12) AS less, round(sum(CASE WHEN a.x = b.x THEN a.n * b.n ELSE 0 END) / sum(a.n * b.n), 12) AS equal,
 round(sum(CASE WHEN a.x > b.x THEN a.n * b.n ELSE 0 END) / sum(a.n * b.n), 12) AS greater FROM {PMF} a, {PMF} b WHERE a.f = 'R' AND b.f = 'A'""")
def _(t):
    two = t.lineitem.filter("l_returnflag IN ('R', 'A')")
    return rnd(dist.compare(two, "l_quantity", F.col("l_returnflag") == "R"), less=12, equal=12, greater=12)


@query("Q05_convolution", " UNION ALL ".join(f"""
SELECT '{k}' AS op, round(a.x {o} b.x, 9) + 0.0 AS l_quantity, round(sum(a.n * b.n) / max(t), 12) AS p FROM {PMF} a, {PMF} b,
 (SELECT sum(n) FILTER (f = 'R') * sum(n) FILTER (f = 'A') AS t FROM {PMF}) WHERE a.f = 'R' AND b.f = 'A' GROUP BY 2"""
    for k, o in (("add", "+"), ("sub", "-"), ("mul", "*"), ("div", "/"))))
def _(t):
    a, b = flag(t, "R"), flag(t, "A")
    frames = [dist.convolve(a, b, "l_quantity", op).select(F.lit(op).alias("op"), "l_quantity", F.round("p", 12).alias("p")) for op in dist.OPERATIONS]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out


@query("Q06_maximum", """
SELECT l_quantity, round(pow(c, 6) - pow(c - p, 6), 12) AS p FROM (SELECT l_quantity, count(*) / sum(count(*)) OVER () AS p,
 sum(count(*)) OVER (ORDER BY l_quantity) / sum(count(*)) OVER () AS c FROM lineitem GROUP BY 1)""")
def _(t):
    return rnd(dist.maximum_of(dist.cdf(t.lineitem, "l_quantity"), "l_quantity", 6), p=12)


@query("Q07_mixture", f"""
SELECT x AS l_quantity, round(sum(p * CASE f WHEN 'A' THEN 0.5 WHEN 'N' THEN 0.3 ELSE 0.2 END), 12) AS p FROM
 (SELECT f, x, n / sum(n) OVER (PARTITION BY f) AS p FROM {PMF}) GROUP BY 1""")
def _(t):
    table = dist.pmf(t.lineitem, "l_quantity", ["l_returnflag"])
    return rnd(dist.mixture(table, "l_returnflag", "l_quantity", {"A": 0.5, "N": 0.3, "R": 0.2}), p=12)


JOINT = "(SELECT l_linenumber AS x, l_quantity AS y, count(*) / (SELECT count(*) FROM lineitem) AS p FROM lineitem GROUP BY ALL)"


@query("Q08_joint", f"""
SELECT 'joint' AS kind, x, y, round(p, 12) AS p FROM {JOINT} UNION ALL SELECT 'marginal', x, NULL, round(sum(p), 12) FROM {JOINT} GROUP BY x
UNION ALL SELECT 'conditional', x, 3.0::DOUBLE, round(p / sum(p) OVER (), 12) FROM {JOINT} WHERE y = 3""")
def _(t):
    j = dist.joint(t.lineitem.select(F.col("l_linenumber").alias("x"), F.col("l_quantity").alias("y")), "x", "y")
    m, c = dist.marginal(j, "x"), dist.conditional(j, "x", "y", 3)
    none, at = F.lit(None).cast("double"), F.lit(3.0)
    rows = j.select(F.lit("joint").alias("kind"), "x", "y", "p").unionAll(m.select(F.lit("marginal"), "x", none, "p"))
    return rnd(rows.unionAll(c.select(F.lit("conditional"), "x", at, "p")), p=12)


@query("Q09_intervals", """
WITH c AS (SELECT l_quantity AS x, count(*) AS n FROM lineitem GROUP BY 1),
r AS (SELECT x, n, sum(n) OVER (ORDER BY n DESC, x DESC) - n AS prev, sum(n) OVER () AS total FROM c)
SELECT 'central' AS kind, quantile_disc(l_quantity, 0.05) AS x, NULL::BIGINT AS n FROM lineitem UNION ALL SELECT 'central', quantile_disc(l_quantity, 0.95), NULL FROM lineitem
UNION ALL SELECT 'likeliest', x, n FROM r WHERE prev < total * 0.9""")
def _(t):
    q = quantiles(t.lineitem, [], "l_quantity", {"lo": 0.05, "hi": 0.95}, kind="disc")
    ends = q.select(F.explode(F.array("lo", "hi")).alias("x")).select(F.lit("central").alias("kind"), "x", F.lit(None).cast("bigint").alias("n"))
    return ends.unionAll(dist.likeliest_interval(t.lineitem, "l_quantity", 90).select(F.lit("likeliest"), "l_quantity", "n"))


@query("Q10_bayes", """
WITH d AS (SELECT event_type = 'error' AS hit, count(*) AS n FROM events GROUP BY 1), h AS (SELECT i / 100.0 AS hypo FROM range(1, 100) r(i)),
s AS (SELECT hypo, sum(n * CASE WHEN hit THEN ln(hypo) ELSE ln(1 - hypo) END) AS ll FROM d, h GROUP BY 1),
e AS (SELECT hypo, exp(ll - (SELECT max(ll) FROM s)) AS w FROM s)
SELECT CAST(hypo AS DOUBLE) AS hypo, round(w / sum(w) OVER (), 9) AS p FROM e""")
def _(t):
    d = t.events.groupBy((F.col("event_type") == "error").alias("hit")).agg(F.count("*").alias("n"))
    grid = [i / 100.0 for i in range(1, 100)]
    return rnd(dist.bayes_update(d, grid, lambda h: F.when(F.col("hit"), F.ln(h)).otherwise(F.ln(1 - h))), p=9)


@query("Q11_odds", """
SELECT lang, round(p / (1 - p), 9) AS odds, round((p / (1 - p)) / (p / (1 - p) + 1), 9) AS back FROM
 (SELECT lang, count(*) FILTER (quality = 1) / count(*) AS p FROM documents JOIN labels USING (doc_id) GROUP BY 1)""")
def _(t):
    q = t.documents.select("doc_id", "lang").join(t.labels, "doc_id").groupBy("lang").agg(
        dist.probability_from_counts(F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)).alias("p"))
    return q.select("lang", F.round(dist.odds(F.col("p")), 9).alias("odds"), F.round(dist.probability(dist.odds(F.col("p"))), 9).alias("back"))


def _u(seed):
    return f"CAST('0x' || substr(md5('{seed}-' || id), 1, 13) AS BIGINT) / 4503599627370496.0"


@query("Q12_draw", f"""
WITH c AS (SELECT o_totalprice AS x, CAST(sum(count(*)) OVER (ORDER BY o_totalprice) - count(*) AS DOUBLE) AS lo FROM orders GROUP BY 1),
d AS (SELECT o_orderkey AS id, CAST('0x' || substr(md5('21-' || o_orderkey), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE * (SELECT count(*) FROM orders) AS u FROM orders)
SELECT id, x AS o_totalprice FROM d ASOF JOIN c ON u >= lo""")
def _(t):
    return dist.draw(t.orders, "o_totalprice", t.orders.select(F.col("o_orderkey").alias("id")), seed=21)


FIT = """WITH m AS (SELECT l_returnflag AS f, avg(l_quantity) AS mu, stddev_pop(l_quantity) AS sd, avg(ln(l_quantity)) AS lmu, stddev_pop(ln(l_quantity)) AS lsd FROM lineitem GROUP BY 1),
d AS (SELECT DISTINCT l_returnflag AS f, l_quantity AS x FROM lineitem)"""


@query("Q13_fitted_density", FIT + """, s AS (SELECT f, x, exp(-0.5 * pow((x - mu) / sd, 2)) / (sd * sqrt(2 * pi())) AS normal,
 exp(-0.5 * pow((ln(x) - lmu) / lsd, 2)) / (lsd * sqrt(2 * pi())) / x AS lognormal, exp(-x / mu) / mu AS exponential,
 exp(x * ln(mu) - mu - lgamma(x + 1)) AS poisson,
 exp(lgamma(101) - lgamma(x + 1) - lgamma(101 - x) + x * ln(mu / 100) + (100 - x) * ln(1 - mu / 100)) AS binomial FROM d JOIN m USING (f))
SELECT f, x, round(normal, 9) AS normal, round(lognormal, 9) AS lognormal, round(exponential, 9) AS exponential, round(poisson, 9) AS poisson,
 round(binomial / sum(binomial) OVER (PARTITION BY f), 9) AS binomial FROM s""")
def _(t):
    x = F.col("x")
    li = t.lineitem.select(F.col("l_returnflag").alias("f"), F.col("l_quantity").alias("x"))
    m = li.groupBy("f").agg(F.avg("x").alias("mu"), F.stddev_pop("x").alias("sd"), F.avg(F.ln("x")).alias("lmu"), F.stddev_pop(F.ln("x")).alias("lsd"))
    d = li.distinct().join(m, "f")
    s = d.select("f", "x", dist.density("normal", x, mu=F.col("mu"), sigma=F.col("sd")).alias("normal"),
                 dist.density("lognormal", x, mu=F.col("lmu"), sigma=F.col("lsd")).alias("lognormal"),
                 dist.density("exponential", x, rate=1 / F.col("mu")).alias("exponential"),
                 dist.density("poisson", x, mean=F.col("mu")).alias("poisson"),
                 dist.density("binomial", x, n=100, p=F.col("mu") / 100).alias("binomial"))
    s = dist.normalize(s, "binomial", ["f"])
    return rnd(s, normal=9, lognormal=9, exponential=9, poisson=9, binomial=9)


@query("Q13_fitted_cdf", """
WITH m AS (SELECT avg(l_quantity) AS mu, stddev_pop(l_quantity) AS sd, count(l_quantity) AS total FROM lineitem), c AS (SELECT l_quantity, count(*) AS n FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY 1),
x AS (SELECT l_quantity, CAST(sum(n) OVER (ORDER BY l_quantity) AS DOUBLE) / total AS p, (l_quantity - mu) / (sd * sqrt(2)) AS z, mu FROM c, m)
SELECT l_quantity, round(p, 9) AS observed, round(0.5 + list_sum([CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END * pow(z, 2 * k + 1) / ((2 * k + 1) * exp(lgamma(k + 1.0))) for k in range(60)]) / sqrt(pi()), 9) AS normal,
 round(1 - exp(-l_quantity / mu), 9) AS exponential FROM x""")
def _(t):
    m = t.lineitem.agg(F.struct(F.avg("l_quantity").alias("mu"), F.stddev_pop("l_quantity").alias("sd"))).scalar()
    c = dist.cdf(t.lineitem, "l_quantity").select("l_quantity", "cum_p", m["mu"].alias("mu"), m["sd"].alias("sd"))
    x = F.col("l_quantity")
    return c.select("l_quantity", F.round("cum_p", 9).alias("observed"), F.round(dist.cumulative("normal", x, mu=F.col("mu"), sigma=F.col("sd")), 9).alias("normal"),
                    F.round(dist.cumulative("exponential", x, rate=1 / F.col("mu")), 9).alias("exponential"))


@query("Q14_kernel_density", """
WITH s AS (SELECT l_returnflag AS f, count(*) AS n, min(l_quantity) AS lo, max(l_quantity) AS hi, stddev_samp(l_quantity) * pow(count(*), -0.2) AS h FROM lineitem GROUP BY 1),
c AS (SELECT l_returnflag AS f, l_quantity AS v, count(*) AS k FROM lineitem GROUP BY ALL)
SELECT f AS l_returnflag, round(lo + (hi - lo) * i / 100, 9) AS x, round(sum(k * exp(-0.5 * pow((lo + (hi - lo) * i / 100 - v) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi())), 9) AS density
FROM c JOIN s USING (f), range(101) r(i) GROUP BY ALL""")
def _(t):
    return rnd(dist.kernel_density(t.lineitem, "l_quantity", ["l_returnflag"]), x=9, density=9)


@query("Q15_ddof", """
SELECT l_returnflag, round(avg(l_extendedprice), 6) AS mean, round(var_pop(l_extendedprice), 2) AS var0, round(stddev_pop(l_extendedprice), 6) AS std0,
 round(var_samp(l_extendedprice), 2) AS var1 FROM lineitem GROUP BY 1""")
def _(t):
    c = "l_extendedprice"
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.avg(c), 6).alias("mean"), F.round(F.var_pop(c), 2).alias("var0"),
                                                  F.round(F.stddev_pop(c), 6).alias("std0"), F.round(F.var_samp(c), 2).alias("var1"))


@query("Q16_trimmed", """
WITH r AS (SELECT l_returnflag, l_extendedprice AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS i, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
SELECT l_returnflag, count(*) AS n, round(avg(v), 6) AS mean, round(var_pop(v), 2) AS var FROM r WHERE i >= floor(0.01 * n) AND i < n - floor(0.01 * n) GROUP BY 1""")
def _(t):
    return rnd(inf.trimmed(t.lineitem, ["l_returnflag"], "l_extendedprice", 0.01), mean=6, var=2)


@query("Q17_moments", """
WITH m AS (SELECT l_linestatus AS s, avg(l_quantity) AS m, quantile_disc(l_quantity, 0.5) AS med FROM lineitem GROUP BY 1),
c AS (SELECT s, m, med, avg(pow(l_quantity, 2)) AS r2, avg(pow(l_quantity, 3)) AS r3, avg(pow(l_quantity - m, 2)) AS c2, avg(pow(l_quantity - m, 3)) AS c3
 FROM lineitem JOIN m ON l_linestatus = s GROUP BY ALL)
SELECT s AS l_linestatus, round(m, 7) AS raw1, round(r2, 5) AS raw2, round(r3, 4) AS raw3, round(c2, 6) AS central2, round(c3, 5) AS central3,
 round(c3 / pow(sqrt(c2), 3), 9) AS skewness, round(3 * (m - med) / sqrt(c2), 9) AS pearson_skewness FROM c""")
def _(t):
    return rnd(inf.moments(t.lineitem, ["l_linestatus"], "l_quantity"), raw1=7, raw2=5, raw3=4, central2=6, central3=5, skewness=9, pearson_skewness=9)


@query("Q18_median_iqr", """
SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS median, quantile_disc(l_extendedprice, 0.25) AS q1, quantile_disc(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1""")
def _(t):
    return quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"median": 0.5, "q1": 0.25, "q3": 0.75}, kind="disc")


@query("Q19_correlation", """
WITH r AS (SELECT l_quantity AS x, l_extendedprice AS y, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS rx,
 rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2 AS ry FROM lineitem)
SELECT round(covar_pop(x, y), 4) AS cov, round(corr(x, y), 9) AS pearson, round(corr(rx, ry), 9) AS spearman FROM r""")
def _(t):
    s = inf.spearman(t.lineitem, "l_quantity", "l_extendedprice").scalar()
    p = t.lineitem.agg(F.covar_pop("l_quantity", "l_extendedprice").alias("cov"), F.corr("l_quantity", "l_extendedprice").alias("pearson"))
    return rnd(p.withColumn("spearman", s), cov=4, pearson=9, spearman=9)


@query("Q20_least_squares", """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 5) AS intercept,
 round(regr_r2(l_extendedprice, l_quantity), 9) AS r2 FROM lineitem GROUP BY 1""")
def _(t):
    return rnd(inf.least_squares(t.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"]), slope=6, intercept=5, r2=9)


@query("Q20_residuals", """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, round(a + b * l_quantity, 5) AS fitted, round(l_extendedprice - (a + b * l_quantity), 5) AS residual FROM lineitem, f""")
def _(t):
    r = inf.residuals(t.lineitem, "l_quantity", "l_extendedprice")
    return rnd(r.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "fitted", "residual"), fitted=5, residual=5)


TWO = "(SELECT l_extendedprice AS v, l_returnflag = 'R' AS c FROM lineitem WHERE l_returnflag IN ('R', 'A'))"


@query("Q21_cohen_d", f"""
SELECT round((avg(v) FILTER (c) - avg(v) FILTER (NOT c)) / sqrt((count(*) FILTER (c) * var_pop(v) FILTER (c) + count(*) FILTER (NOT c) * var_pop(v) FILTER (NOT c)) / count(*)), 9) AS d FROM {TWO}""")
def _(t):
    two = t.lineitem.filter("l_returnflag IN ('R', 'A')")
    return rnd(inf.cohen_d(two, "l_extendedprice", F.col("l_returnflag") == "R"), d=9)


@query("Q22_overlap_superiority", f"""
WITH m AS (SELECT (avg(v) FILTER (c) + avg(v) FILTER (NOT c)) / 2 AS mid FROM {TWO}), r AS (SELECT v, c, rank() OVER (ORDER BY v) AS lo, count(*) OVER (PARTITION BY v) AS n,
 count(*) FILTER (c) OVER (PARTITION BY v) AS nc, count(*) FILTER (c) OVER (ORDER BY v) AS cc FROM {TWO})
SELECT round(count(*) FILTER (c AND v > mid) / count(*) FILTER (c) + count(*) FILTER (NOT c AND v < mid) / count(*) FILTER (NOT c), 12) AS overlap,
 round(sum(CASE WHEN NOT c THEN cc - nc ELSE 0 END) / (count(*) FILTER (c) * count(*) FILTER (NOT c)), 12) AS superiority FROM r, m""")
def _(t):
    two = t.lineitem.filter("l_returnflag IN ('R', 'A')")
    control = F.col("l_returnflag") == "R"
    sup = dist.compare(two, "l_extendedprice", ~control).select("greater").scalar()
    return rnd(inf.overlap_share(two, "l_extendedprice", control).withColumn("superiority", sup), overlap=12, superiority=12)


@query("Q23_permutation_test")
def _(t):
    two = t.lineitem.filter("l_returnflag IN ('R', 'A')")
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return inf.permutation_test(two, "l_quantity", F.col("l_returnflag") == "R", ids, 200, seed=5)


@query("Q24_bootstrap")
def _(t):
    stats = inf.bootstrap_stats(t.orders, "o_totalprice", ["o_orderkey"], 200, seed=9)
    return inf.bootstrap_summary(stats, ["mean", "std", "cv"])


@query("Q24_bootstrap_any_statistic")
def _(t):
    stats = [inf.MEAN, inf.quantile_statistic(t.orders, "o_totalprice", 0.5, name="median")]
    drawn = inf.bootstrap_stats(t.orders, "o_totalprice", ["o_orderkey"], 100, seed=9, statistics=stats)
    return inf.bootstrap_summary(drawn, ["mean", "median"])


@query("Q25_weighted_resample", """
WITH c AS (SELECT o_orderkey AS row, CAST(sum(w) OVER (ORDER BY o_orderkey) - w AS DOUBLE) AS lo FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS w FROM orders)),
d AS (SELECT o_orderkey AS id, CAST('0x' || substr(md5('22-' || o_orderkey), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE * (SELECT sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT FROM orders) AS u FROM orders)
SELECT id, row FROM d ASOF JOIN c ON u >= lo""")
def _(t):
    o = t.orders.select("o_orderkey", F.round(F.col("o_totalprice") * 100, 0).cast("bigint").alias("w"))
    return dist.draw_rows(o, "o_orderkey", "w", t.orders.select(F.col("o_orderkey").alias("id")), seed=22)


@query("Q26_curve_bands", """
WITH c AS (SELECT CAST(ts AS DATE) AS day, user_id, round(sum(value), 2) AS v FROM events GROUP BY ALL), l AS (SELECT day, list_sort(list(v)) AS l FROM c GROUP BY 1)
SELECT day, l[CAST(floor(len(l) * 0.05) AS BIGINT) + 1] AS p05, l[CAST(floor(len(l) * 0.5) AS BIGINT) + 1] AS p50, l[CAST(floor(len(l) * 0.95) AS BIGINT) + 1] AS p95 FROM l""")
def _(t):
    curves = t.events.groupBy(F.to_date("ts").alias("day"), "user_id").agg(F.round(F.sum("value"), 2).alias("v"))
    return quantiles(curves, ["day"], "v", {"p05": 0.05, "p50": 0.5, "p95": 0.95}, kind="row")


def _ratio_sql(r, coefficients):
    """Quotient of two polynomials in the SQL name ``r``, highest power first."""
    above, below = (reduce(lambda s, c: f"({s} * {r} + {c!r}::DOUBLE)", line[1:], f"{line[0]!r}::DOUBLE") for line in coefficients)
    return f"{above} / {below}"


@query("Q27_normal_plot", f"""
WITH s AS (SELECT o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) / (count(*) OVER () + 1.0::DOUBLE) AS p FROM orders WHERE o_totalprice IS NOT NULL),
q AS (SELECT *, p - 0.5::DOUBLE AS q, 0.180625::DOUBLE - (p - 0.5::DOUBLE) * (p - 0.5::DOUBLE) AS c, sqrt(-ln(least(p, 1 - p))) - 1.6::DOUBLE AS t, sqrt(-ln(least(p, 1 - p))) - 5.0::DOUBLE AS u FROM s)
SELECT o_totalprice, round(CASE WHEN abs(q) <= 0.425 THEN q * ({_ratio_sql('c', numeric.AS241_CENTRE)}) WHEN u <= 0 THEN sign(q) * ({_ratio_sql('t', numeric.AS241_SIDE)})
 ELSE sign(q) * ({_ratio_sql('u', numeric.AS241_TAIL)}) END, 9) AS score FROM q""")
def _(t):
    return rnd(dist.normal_plot(t.orders, "o_totalprice", ["o_orderkey"]), score=9)
