"""Scalar functions."""

from pyspark.sql import functions as F

from quillframe.functions import arrays, dates, numeric, text
from quillframe.operators.aggregate import grouped_values
from quillframe.registry import query
from quillframe.session import balanced

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
KEYS = ", ".join(LINE)
TOKENS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')"


def r(c, n, name):
    return F.round(c, n).alias(name)


def docs(t):
    return balanced(t.documents.select("doc_id", "text"), "doc_id")


def tokens(t):
    return docs(t).select("doc_id", text.words(F.col("text")).alias("w"))


@query("F01_arithmetic", f"""
SELECT {KEYS}, l_quantity + l_tax AS a, l_quantity - l_extendedprice AS b, l_quantity * l_discount AS c, round(l_extendedprice / l_quantity, 9) AS d,
 CAST(floor(-l_extendedprice / l_quantity) AS BIGINT) AS e, (l_linenumber - 10) - 3 * CAST(floor((l_linenumber - 10) / 3.0) AS BIGINT) AS f,
 pow(l_linenumber, 2) AS g, -l_quantity AS h, abs(l_discount - l_tax) AS i FROM lineitem""")
def _(t):
    q, p, d, x, n = (F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"))
    return t.lineitem.select(*LINE, (q + x).alias("a"), (q - p).alias("b"), (q * d).alias("c"), r(p / q, 9, "d"),
                             numeric.floor_div(-p, q).alias("e"), numeric.floor_mod(n - 10, F.lit(3)).alias("f"),
                             F.pow(n, F.lit(2)).alias("g"), (-q).alias("h"), F.abs(d - x).alias("i"))


@query("F02_trigonometry", f"""
SELECT {KEYS}, round(sin(l_quantity), 9) + 0.0 AS s, round(cos(l_quantity), 9) + 0.0 AS c, round(tan(l_quantity), 9) + 0.0 AS t, round(asin(l_discount), 9) AS asn,
 round(acos(l_discount), 9) AS acs, round(atan(l_quantity), 9) AS atn FROM lineitem""")
def _(t):
    q, d = F.col("l_quantity"), F.col("l_discount")
    return t.lineitem.select(*LINE, r(F.sin(q), 9, "s"), r(F.cos(q), 9, "c"), r(F.tan(q), 9, "t"), r(F.asin(d), 9, "asn"),
                             r(F.acos(d), 9, "acs"), r(F.atan(q), 9, "atn"))


@query("F03_exponentials", f"""
SELECT {KEYS}, round(exp(l_discount), 9) AS e, round(pow(2, l_tax), 9) AS e2, round(ln(l_quantity), 9) AS l, round(log2(l_quantity), 9) AS l2,
 round(log10(l_extendedprice), 9) AS l10, round(exp(l_discount) - 1, 9) AS em, round(ln(1 + l_tax), 9) AS lp,
 round(greatest(l_tax, l_discount) + ln(1 + exp(-abs(l_tax - l_discount))), 9) AS la FROM lineitem""")
def _(t):
    q, p, d, x = (F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    return t.lineitem.select(*LINE, r(F.exp(d), 9, "e"), r(F.pow(F.lit(2), x), 9, "e2"), r(F.ln(q), 9, "l"), r(F.log2(q), 9, "l2"),
                             r(F.log10(p), 9, "l10"), r(F.expm1(d), 9, "em"), r(F.log1p(x), 9, "lp"), r(numeric.logaddexp(x, d), 9, "la"))


@query("F04_gamma", f"""
SELECT {KEYS}, round(lgamma(l_quantity), 7) + 0.0 AS lg, round(gamma(l_discount + 1.5), 7) AS g,
 round(exp(lgamma(l_quantity) + lgamma(l_tax + 1) - lgamma(l_quantity + l_tax + 1)), 7) AS b FROM lineitem""")
def _(t):
    q, d, x = (F.col(c) for c in ("l_quantity", "l_discount", "l_tax"))
    return t.lineitem.select(*LINE, (F.round(numeric.ln_gamma(q), 7) + 0.0).alias("lg"), r(numeric.gamma(d + 1.5), 7, "g"),
                             r(numeric.beta(q, x + 1), 7, "b"))


# Maclaurin series of the error function and its inverse, for arguments up to 0.1.
ERF_SUM = "2 / sqrt(pi()) * (x - pow(x, 3) / 3 + pow(x, 5) / 10 - pow(x, 7) / 42 + pow(x, 9) / 216 - pow(x, 11) / 1320)"
ERFINV_SUM = "y + pow(y, 3) / 3 + 7 * pow(y, 5) / 30 + 127 * pow(y, 7) / 630 + 4369 * pow(y, 9) / 22680 + 34807 * pow(y, 11) / 178200"


@query("F04_error_functions", f"""
SELECT {KEYS}, round({ERF_SUM}, 9) AS erf, round(1 - {ERF_SUM}, 9) AS erfc, round({ERFINV_SUM}, 9) AS erfinv
FROM (SELECT *, l_discount AS x, l_discount * sqrt(pi()) / 2 AS y FROM lineitem)""")
def _(t):
    d = F.col("l_discount")
    return t.lineitem.select(*LINE, r(numeric.erf(d), 9, "erf"), r(numeric.erfc(d), 9, "erfc"), r(numeric.erfinv(d), 9, "erfinv"))


@query("F05_comparisons", f"""
SELECT {KEYS}, l_discount < l_tax AS lt, l_discount <= l_tax AS le, l_discount > l_tax AS gt, l_discount >= l_tax AS ge, l_discount = l_tax AS eq,
 l_discount <> l_tax AS ne, nullif(l_discount, 0) IS NOT DISTINCT FROM nullif(l_tax, 0) AS nulleq FROM lineitem""")
def _(t):
    a, b = F.col("l_discount"), F.col("l_tax")
    return t.lineitem.select(*LINE, (a < b).alias("lt"), (a <= b).alias("le"), (a > b).alias("gt"), (a >= b).alias("ge"), (a == b).alias("eq"),
                             (a != b).alias("ne"), F.nullif(a, F.lit(0.0)).eqNullSafe(F.nullif(b, F.lit(0.0))).alias("nulleq"))


@query("F06_bitwise", """
SELECT o_orderkey, o_orderkey & o_custkey AS a, o_orderkey | o_custkey AS o, xor(o_orderkey, o_custkey) AS x, ~o_orderkey AS n, bin(o_custkey) AS b FROM orders""")
def _(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return t.orders.select("o_orderkey", k.bitwiseAND(c).alias("a"), k.bitwiseOR(c).alias("o"), k.bitwiseXOR(c).alias("x"),
                           F.bitwise_not(k).alias("n"), F.bin(c).alias("b"))


@query("F07_rounding", f"""
SELECT {KEYS}, printf('%.2f', l_extendedprice) AS f, round(l_quantity / 2) AS up, round_even(l_quantity / 2, 0) AS even FROM lineitem""")
def _(t):
    q = F.col("l_quantity")
    return t.lineitem.select(*LINE, F.format_string("%.2f", "l_extendedprice").alias("f"), r(q / 2, 0, "up"), F.bround(q / 2, 0).alias("even"))


@query("F08_where", "SELECT event_id, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS level FROM events")
def _(t):
    return t.events.select("event_id", F.when(F.col("value") > 50, "high").otherwise("low").alias("level"))


@query("F09_case", r"""
SELECT p_partkey, lower(n) AS lo, upper(n) AS up, upper(n[1]) || lower(n[2:]) AS cap,
 list_reduce([upper(w[1]) || lower(w[2:]) for w in string_split(n, ' ')], lambda a, b: a || ' ' || b) AS title,
 list_reduce([CASE WHEN c = upper(c) THEN lower(c) ELSE upper(c) END for c in string_split(n, '')], lambda a, b: a || b) AS swap
FROM (SELECT p_partkey, p_brand || ' ' || p_name AS n FROM part)""")
def _(t):
    n = F.concat_ws(" ", "p_brand", "p_name")
    return t.part.select("p_partkey", F.lower(n).alias("lo"), F.upper(n).alias("up"), text.capitalize(n).alias("cap"),
                         text.title(n).alias("title"), text.swapcase(n).alias("swap"))


@query("F10_search", """
SELECT p_partkey, length(p_name) AS len, instr(p_name, 'e') - 1 AS find,
 CASE WHEN contains(p_name, 'e') THEN length(p_name) - instr(reverse(p_name), 'e') ELSE -1 END AS rfind,
 starts_with(p_name, 'small') AS starts, ends_with(p_name, 'ring') AS ends, contains(p_name, 'bolt') AS has FROM part""")
def _(t):
    n = F.col("p_name")
    return t.part.select("p_partkey", F.length(n).cast("bigint").alias("len"), text.find(n, "e").cast("bigint").alias("find"),
                         text.rfind(n, "e").cast("bigint").alias("rfind"), n.startswith("small").alias("starts"),
                         n.endswith("ring").alias("ends"), n.contains("bolt").alias("has"))


@query("F11_pad_trim", """
WITH p AS (SELECT c_custkey, c_mktsegment AS s, printf('%d', CAST(floor(c_acctbal) AS INTEGER) - 5000) AS n FROM customer)
SELECT c_custkey, CASE WHEN length(s) < 10 THEN rpad(s, 10, '.') ELSE s END AS l, CASE WHEN length(s) < 10 THEN lpad(s, 10, '.') ELSE s END AS r,
 repeat('*', (12 - length(s)) // 2) || s || repeat('*', (12 - length(s)) - (12 - length(s)) // 2) AS c,
 CASE WHEN n[1] = '-' THEN '-' || repeat('0', greatest(8 - length(n), 0)) || n[2:] ELSE repeat('0', greatest(8 - length(n), 0)) || n END AS z,
 trim('  ' || s || ' ') AS t, ltrim('  ' || s || ' ') AS lt, rtrim('  ' || s || ' ') AS rt FROM p""")
def _(t):
    s = F.col("c_mktsegment")
    n = (F.floor("c_acctbal").cast("int") - 5000).cast("string")
    padded = F.concat(F.lit("  "), s, F.lit(" "))
    return t.customer.select("c_custkey", text.ljust(s, 10, ".").alias("l"), text.rjust(s, 10, ".").alias("r"), text.center(s, 12, "*").alias("c"),
                             text.zfill(n, 8).alias("z"), text.strip(padded).alias("t"), F.ltrim(padded).alias("lt"), F.rtrim(padded).alias("rt"))


CLASSES = ["isalnum", "isalpha", "isdigit", "isdecimal", "isnumeric", "isspace", "istitle"]


@query("F12_classes", "SELECT p_partkey, " + ", ".join(
    f"regexp_matches(v, '{text.CLASS_PATTERNS[c]}') AS {c}" for c in CLASSES) + """,
 v = lower(v) AND v <> upper(v) AS islower, v = upper(v) AND v <> lower(v) AS isupper FROM (SELECT p_partkey,
 CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN p_brand WHEN 2 THEN p_type WHEN 3 THEN p_size::VARCHAR WHEN 4 THEN ' ' ELSE '' END AS v FROM part)""")
def _(t):
    v = F.expr("CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN p_brand WHEN 2 THEN p_type WHEN 3 THEN CAST(p_size AS string) WHEN 4 THEN ' ' ELSE '' END")
    return t.part.select("p_partkey", v.alias("v")).select("p_partkey", *[text.is_class(F.col("v"), c).alias(c) for c in [*CLASSES, "islower", "isupper"]])


@query("F13_split", r"""
SELECT p_partkey, string_split(p_name, ' ') AS parts, string_split(p_name, ' ')[1] AS head, ' ' AS sep, p_name[instr(p_name, ' ') + 1:] AS tail,
 regexp_extract(b, '^(.*)-([^-]*)$', 1) AS rhead, regexp_extract(b, '^(.*)-([^-]*)$', 2) AS rtail FROM (SELECT *, p_brand || '-' || p_type || '-' || p_size AS b FROM part)""")
def _(t):
    n, b = F.col("p_name"), F.concat_ws("-", "p_brand", "p_type", "p_size")
    p, rp = text.partition(n, " "), text.rpartition(b, "-")
    return t.part.select("p_partkey", text.words(n).alias("parts"), p["head"].alias("head"), p["sep"].alias("sep"), p["tail"].alias("tail"),
                         rp["head"].alias("rhead"), rp["tail"].alias("rtail"))


@query("F14_slice", """
SELECT p_partkey, p_name[1:3] AS first3, string_split(p_name, ' ')[-1] AS last_word, p_name[1:2] || '--' || p_name[5:] AS replaced FROM part""")
def _(t):
    n = F.col("p_name")
    return t.part.select("p_partkey", F.substring(n, 1, 3).alias("first3"), F.element_at(text.words(n), -1).alias("last_word"),
                         text.slice_replace(n, 2, 4, "--").alias("replaced"))


@query("F15_regex", r"""
SELECT doc_id, regexp_matches(text, '\A(?:[A-Z][a-z]+ )') AS starts, regexp_extract(text, '([A-Za-z]+)tion', 1) AS first_stem,
 regexp_extract_all(text, '([A-Za-z]+)tion', 1) AS stems, CAST(len(regexp_extract_all(text, 'th')) AS INTEGER) AS n,
 length(regexp_replace(text, '[aeiou]+', '#', 'g')) AS squeezed FROM documents""")
def _(t):
    c = F.col("text")
    return docs(t).select("doc_id", text.match(c, "[A-Z][a-z]+ ").alias("starts"), F.regexp_extract(c, "([A-Za-z]+)tion", 1).alias("first_stem"),
                              F.regexp_extract_all(c, F.lit("([A-Za-z]+)tion"), F.lit(1)).alias("stems"), F.regexp_count(c, F.lit("th")).alias("n"),
                              F.length(F.regexp_replace(c, "[aeiou]+", "#")).cast("bigint").alias("squeezed"))


@query("F16_build", """
SELECT p_partkey, p_name || '/' || p_brand AS cat, concat_ws('|', p_name, p_brand, p_type) AS joined, repeat(p_type, 2) AS twice,
 translate(p_name, 'abc', 'xyz') AS mapped, nfc_normalize(p_name || 'é') AS norm FROM part""")
def _(t):
    return t.part.select("p_partkey", F.concat("p_name", F.lit("/"), "p_brand").alias("cat"), F.concat_ws("|", "p_name", "p_brand", "p_type").alias("joined"),
                         F.repeat("p_type", 2).alias("twice"), F.translate("p_name", "abc", "xyz").alias("mapped"),
                         text.normalize(F.concat("p_name", F.lit("é"))).alias("norm"))


@query("F16_wrap")
def _(t):
    return docs(t).select("doc_id", text.wrap(F.col("text"), 60).alias("wrapped"))


@query("F17_clean_names", r"""
SELECT p_partkey, list_reduce([upper(w[1]) || lower(w[2:]) for w in string_split(regexp_replace(trim(n), '[!#?]', '', 'g'), ' ')], lambda a, b: a || ' ' || b) AS name
FROM (SELECT p_partkey, ' ' || upper(p_name) || CASE WHEN p_partkey % 2 = 0 THEN '##' ELSE '? ' END AS n FROM part)""")
def _(t):
    n = F.concat(F.lit(" "), F.upper("p_name"), F.expr("CASE WHEN p_partkey % 2 = 0 THEN '##' ELSE '? ' END"))
    return t.part.select("p_partkey", text.clean_names(n).alias("name"))


_SQL_CLEAN = "text"
for _p, _n in text.SENTENCE_REWRITES:
    _q, _m = _p.replace("'", "''"), _n.replace("'", "''").replace("\\", "\\\\")
    _SQL_CLEAN = f"regexp_replace({_SQL_CLEAN}, '{_q}', '{_m}', 'g')"
SQL_CLEAN = f"lower(trim({_SQL_CLEAN}))"


@query("F18_clean_sentence", f"SELECT doc_id, {SQL_CLEAN} AS clean FROM documents")
def _(t):
    return docs(t).select("doc_id", text.clean_sentence(F.col("text")).alias("clean"))


@query("F19_parse_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def _(t):
    ordinal = F.concat(F.date_format("o_orderdate", "d"), F.expr(
        "CASE WHEN day(o_orderdate) IN (1, 21, 31) THEN 'st' WHEN day(o_orderdate) IN (2, 22) THEN 'nd' WHEN day(o_orderdate) IN (3, 23) THEN 'rd' ELSE 'th' END"),
        F.lit(" of "), F.date_format("o_orderdate", "MMMM, yyyy"))
    forms = [ordinal, *[F.date_format("o_orderdate", f) for f in ("yyyy-MMM-d", "MM-dd-yyyy", "yyyyMMdd")]]
    mixed = F.element_at(F.array(*forms), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t.orders.select("o_orderkey", dates.parse_mixed(mixed).alias("day"))


@query("F20_format_dates", "SELECT o_orderkey, dayname(o_orderdate) AS weekday, strftime(o_orderdate, '%m/%d/%Y %H:%M') AS stamp FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "EEEE").alias("weekday"), F.date_format("o_orderdate", "MM/dd/yyyy HH:mm").alias("stamp"))


@query("F21_date_parts", """
SELECT event_id, year(ts) AS y, month(ts) AS m, day(ts) AS d, hour(ts) AS h, strftime(ts, '%H:%M:%S') AS time, isodow(ts) - 1 AS weekday FROM events""")
def _(t):
    big = lambda c, n: c.cast("bigint").alias(n)
    return t.events.select("event_id", big(F.year("ts"), "y"), big(F.month("ts"), "m"), big(F.dayofmonth("ts"), "d"), big(F.hour("ts"), "h"),
                           F.date_format("ts", "HH:mm:ss").alias("time"), big(dates.weekday(F.col("ts")), "weekday"))


@query("F22_date_arithmetic", """
SELECT o_orderkey, CAST(o_orderdate + INTERVAL 12 DAY AS DATE) AS later, date_diff('hour', o_orderdate, TIMESTAMP '2005-01-01') AS hours,
 o_orderdate + INTERVAL 90 MINUTE AS shifted FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", F.date_add("o_orderdate", 12).alias("later"),
                           F.timestamp_diff("HOUR", "o_orderdate", F.lit("2005-01-01").cast("timestamp_ntz")).alias("hours"),
                           (F.col("o_orderdate") + F.make_dt_interval(mins=F.lit(90))).cast("timestamp_ntz").alias("shifted"))


@query("F23_build_date", """
SELECT o_orderkey, TRY_CAST(printf('%04d-%02d-%02d', year(o_orderdate), month(o_orderdate), CAST(day(o_orderdate) + o_orderkey % 3 AS BIGINT)) AS DATE) AS made,
 TRY_CAST(printf('2011-%02d-%02d', month(o_orderdate), day(o_orderdate)) AS DATE) AS fixed_year FROM orders""")
def _(t):
    y, m, d = F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    return t.orders.select("o_orderkey", dates.build_date(y, m, d + F.col("o_orderkey") % 3).alias("made"),
                           dates.build_date(F.lit(2011), m, d).alias("fixed_year"))


@query("F24_truncate", "SELECT event_id, date_trunc('hour', ts) AS hour, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events")
def _(t):
    return t.events.select("event_id", dates.truncate("hour", F.col("ts")).alias("hour"), dates.truncate("day", F.col("ts")).alias("day"))


@query("F26_array_slices", f"""
SELECT doc_id, w[3:6] AS mid, CASE WHEN len(w) >= 12 THEN w[len(w) - 11:len(w) - 7] ELSE w[1:greatest(len(w) - 7, 0)] END AS tail, w[1:10:2] AS stride, list_reverse(w)[1:5] AS back
FROM (SELECT doc_id, {TOKENS} AS w FROM documents)""")
def _(t):
    w = F.col("w")
    return tokens(t).select("doc_id", arrays.slice_step(w, 2, 6).alias("mid"), arrays.slice_step(w, -12, -7).alias("tail"),
                            arrays.slice_step(w, 0, 10, 2).alias("stride"), F.slice(F.reverse(w), 1, 5).alias("back"))


@query("F27_array_edits", f"""
SELECT doc_id, len(list_append(w, 'end')) AS n, (w[1:2] || ['mid'] || w[3:])[1:5] AS inserted, len(w[1:len(w) - 1]) AS popped,
 list_contains(w, 'the') AS has, CASE WHEN list_contains(w, 'the') THEN len(w) - 1 ELSE len(w) END AS removed, len(w || w) AS doubled
FROM (SELECT doc_id, {TOKENS} AS w FROM documents)""")
def _(t):
    w = F.col("w")
    big = lambda c, n: F.size(c).cast("bigint").alias(n)
    inserted = F.concat(F.slice(w, 1, 2), F.array(F.lit("mid")), arrays.slice_step(w, 2))
    return tokens(t).select("doc_id", big(F.array_append(w, "end"), "n"), F.slice(inserted, 1, 5).alias("inserted"), big(arrays.pop_last(w), "popped"),
                            F.array_contains(w, "the").alias("has"), big(arrays.remove_first(w, "the"), "removed"), big(F.concat(w, w), "doubled"))


@query("F27_array_edits_whole", f"""
SELECT doc_id, list_append(w, 'end') AS appended, w[1:2] || ['mid'] || w[3:] AS inserted, w[1:len(w) - 1] AS popped,
 CASE WHEN list_contains(w, 'the') THEN w[1:list_position(w, 'the') - 1] || w[list_position(w, 'the') + 1:] ELSE w END AS removed, w || w AS doubled
FROM (SELECT doc_id, {TOKENS} AS w FROM documents)""")
def _(t):
    w = F.col("w")
    inserted = F.concat(F.slice(w, 1, 2), F.array(F.lit("mid")), arrays.slice_step(w, 2))
    return tokens(t).select("doc_id", F.array_append(w, "end").alias("appended"), inserted.alias("inserted"), arrays.pop_last(w).alias("popped"),
                            arrays.remove_first(w, "the").alias("removed"), F.concat(w, w).alias("doubled"))


@query("F28_comprehension", f"""
SELECT doc_id, list_sort(list_distinct([lower(x) for x in w if length(x) > 9])) AS long_words,
 len(flatten([string_split(x, '') for x in w])) AS letters FROM (SELECT doc_id, {TOKENS} AS w FROM documents)""")
def _(t):
    w = F.col("w")
    long_words = F.array_sort(F.array_distinct(F.transform(F.filter(w, lambda x: F.length(x) > 9), F.lower)))
    return tokens(t).select("doc_id", long_words.alias("long_words"),
                            F.size(F.flatten(F.transform(w, lambda x: F.split(x, "")))).cast("bigint").alias("letters"))


@query("F29_sorted_arrays", f"""
SELECT doc_id, list_sort(w)[1:3] AS first3, len(list_filter(w, lambda x: x <= 'm')) AS pos FROM (SELECT doc_id, {TOKENS} AS w FROM documents)""")
def _(t):
    w = F.array_sort("w")
    return tokens(t).select("doc_id", F.slice(w, 1, 3).alias("first3"), arrays.insertion_point(w, F.lit("m")).cast("bigint").alias("pos"))


FIXED = "['the', 'of', 'zebra']"


@query("F30_array_sets", f"""
SELECT doc_id, len(list_distinct(w || {FIXED})) AS u, list_sort(list_distinct(list_intersect(w, {FIXED}))) AS i,
 len(list_filter(list_distinct(w), lambda x: NOT list_contains({FIXED}, x))) AS d,
 list_sort(list_filter({FIXED}, lambda x: NOT list_contains(w, x))) AS only_right FROM (SELECT doc_id, {TOKENS} AS w FROM documents)""")
def _(t):
    w, f = F.col("w"), F.array(*[F.lit(x) for x in ("the", "of", "zebra")])
    return tokens(t).select("doc_id", F.size(F.array_union(w, f)).cast("bigint").alias("u"), F.array_sort(F.array_intersect(w, f)).alias("i"),
                            F.size(F.array_except(w, f)).cast("bigint").alias("d"), F.array_sort(F.array_except(f, w)).alias("only_right"))


@query("F31_maps", """
SELECT event_id, event_type AS got, 'none' AS missing, 'yes' AS updated, ['flag', 'kind', 'user'] AS keys, 2 AS n_after_delete FROM events""")
def _(t):
    m = F.map_from_arrays(F.array(F.lit("kind"), F.lit("user")), F.array(F.col("event_type"), F.col("user_id").cast("string")))
    up = arrays.update(m, F.create_map(F.lit("flag"), F.lit("yes")))
    return t.events.select("event_id", arrays.get(m, "kind", "none").alias("got"), arrays.get(m, "absent", "none").alias("missing"),
                           arrays.get(up, "flag", "no").alias("updated"), F.array_sort(F.map_keys(up)).alias("keys"),
                           F.size(arrays.delete(up, "user")).alias("n_after_delete"))


@query("F32_words_by_letter", """
SELECT letter, 0::BIGINT AS chunk, count(*) AS n, list(word ORDER BY word) AS values FROM
 (SELECT DISTINCT w[1] AS letter, w AS word FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part)) GROUP BY 1""")
def _(t):
    w = t.part.select(F.explode(text.words(F.col("p_name"))).alias("word"))
    return grouped_values(w.select(F.substring("word", 1, 1).alias("letter"), "word"), "letter", "word")


@query("F33_nested_matrix", """
SELECT vec_id, label, embedding[5]::DOUBLE AS centre, round(embedding[1]::DOUBLE + embedding[5]::DOUBLE + embedding[9]::DOUBLE, 6) + 0.0 AS trace FROM embeddings""")
def _(t):
    e = F.transform("embedding", lambda x: x.cast("double"))
    rows = F.array(*[F.slice(e, 1 + 3 * i, 3) for i in range(3)])
    df = t.embeddings.select(F.struct("vec_id", "label", rows.alias("matrix")).alias("rec"))
    m = F.col("rec.matrix")
    return df.select("rec.vec_id", "rec.label", m[1][1].alias("centre"), F.round(m[0][0] + m[1][1] + m[2][2], 6).alias("trace"))


@query("F34_unzip", f"""
SELECT doc_id, [length(x) for x in w][1:4] AS lengths, w[1:4] AS words FROM (SELECT doc_id, {TOKENS} AS w FROM documents)""")
def _(t):
    pairs = F.arrays_zip(F.transform("w", lambda x: F.length(x).cast("bigint")).alias("lengths"), F.col("w").alias("words"))
    p = tokens(t).select("doc_id", F.slice(pairs, 1, 4).alias("p"))
    return p.select("doc_id", arrays.unzip(F.col("p"), "lengths").alias("lengths"), arrays.unzip(F.col("p"), "words").alias("words"))


SIDE = 8


@query("F33_matrix_whole", f"""
SELECT vec_id, label, [e[{SIDE} * i + 1:{SIDE} * i + {SIDE}] for i in range({SIDE})] AS matrix, [[e[{SIDE} * j + i + 1] for j in range({SIDE})] for i in range({SIDE})] AS transposed,
 [e[{SIDE + 1} * i + 1] for i in range({SIDE})] AS diagonal FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)""")
def _(t):
    e = F.transform("embedding", lambda x: x.cast("double"))
    df = t.embeddings.select(F.struct("vec_id", "label", arrays.matrix(e, SIDE).alias("matrix")).alias("rec"))
    m = F.col("rec.matrix")
    return df.select("rec.vec_id", "rec.label", "rec.matrix", arrays.transposed(m, SIDE).alias("transposed"),
                     F.transform(m, lambda row, i: F.get(row, i)).alias("diagonal"))


@query("F34_unzip_whole", f"SELECT doc_id, [length(x) for x in w] AS lengths, w AS words FROM (SELECT doc_id, {TOKENS} AS w FROM documents)")
def _(t):
    pairs = F.arrays_zip(F.transform("w", lambda x: F.length(x).cast("bigint")).alias("lengths"), F.col("w").alias("words"))
    p = tokens(t).select("doc_id", pairs.alias("p"))
    return p.select("doc_id", arrays.unzip(F.col("p"), "lengths").alias("lengths"), arrays.unzip(F.col("p"), "words").alias("words"))
