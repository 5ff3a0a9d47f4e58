"""Mixing sources to target weights: packed blocks, dealt slots, index permutations and a join by index.

Everything here is DataFrame and SQL expressions. Hashes are plain modular arithmetic on BIGINT, so any SQL engine
gives the same mix. Rules: a null source is a source of its own and comes last; a null or empty text has size 0 and
is never taken; an empty table gives an empty result; repeated rows are documents of their own; columns other than
the three named ones are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.common import WORDS, saved

PRIME = 2_147_483_647
ROUNDS = 24


def mixed(a: str, b: str) -> str:
    """SQL for a number below PRIME that depends on the integers ``a`` and ``b``."""
    linear = f"(((({a}) % {PRIME}) * 48271 + (({b}) % {PRIME}) * 69621 + 1013904223) % {PRIME})"
    return f"((({linear} * {linear}) % {PRIME} * 16807 + {linear}) % {PRIME})"


def swap_step(x: str, r: str, n: str, seed: str) -> str:
    """SQL for one swap-or-not round: x and its partner change places or not, so the round is a permutation."""
    key = f"(({mixed(seed, r)} * {PRIME} + {mixed(f'{seed} + 7', r)}) % ({n}))"
    partner = f"(({key} + ({n}) - {x}) % ({n}))"
    return f"CASE WHEN {mixed(f'greatest({x}, {partner})', f'{seed} * 31 + {r}')} % 2 = 1 THEN {partner} ELSE {x} END"


def shares(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """Per source: ordinal, source_size, target. One row per source takes part, not documents.

    Sources are filled by weight; one that reaches ``cap`` times its size stops there, and what is over is shared
    again. In the order of cap/weight the full ones come first, so running sums give the level at once: it rises over
    the full sources and falls after the first open one, whose level is the one that holds.
    """
    sizes.createOrReplaceTempView("quillframe_mix_sizes")
    cycle = "CASE CAST(ordinal % {} AS INT) {} END".format(len(weights), " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights)))
    return sizes.sparkSession.sql(shares_sql("quillframe_mix_sizes", cycle, cap))


def shares_sql(sizes: str, cycle: str, cap: int) -> str:
    return f"""
    WITH totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM {sizes} GROUP BY source),
    ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS ordinal FROM totals),
    weighed AS (SELECT *, CAST({cycle} AS BIGINT) AS weight FROM ranked),
    levels AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS everything,
        CAST(coalesce(sum({cap} * source_size) OVER (ORDER BY {cap} * source_size / CAST(weight AS DOUBLE), ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS filled,
        CAST(sum(weight) OVER (ORDER BY {cap} * source_size / CAST(weight AS DOUBLE), ordinal ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS open
        FROM weighed),
    tested AS (SELECT *, (everything - filled) / open AS level, CAST({cap} * source_size AS DOUBLE) / weight <= (everything - filled) / open AS is_full FROM levels),
    common AS (SELECT *, max(CASE WHEN NOT is_full THEN level END) OVER () AS final_level FROM tested)
    SELECT source, ordinal, source_size, CASE WHEN is_full THEN CAST({cap} * source_size AS DOUBLE) ELSE final_level * weight END AS target FROM common
    """


def slot_counts(sources: str, block: int, cap: int) -> str:
    """SQL: per source its blocks, their ``least_words`` (the first ``longer`` blocks have one word more), and the slots that fill its target.

    All slots but the last take a whole block; the last takes the first ``rest`` words of its block, if any.
    """
    return f"""SELECT *, whole + CASE WHEN rest > 0 THEN 1 ELSE 0 END AS slots FROM (
        SELECT *, CASE WHEN whole < {cap} * blocks THEN CAST(greatest(least(round(target - whole * (source_size / CAST(blocks AS DOUBLE))), least_words), 0) AS BIGINT) ELSE 0 END AS rest FROM (
        SELECT *, source_size DIV blocks AS least_words, source_size % blocks AS longer, CAST(least({cap} * blocks, floor(target * blocks / source_size)) AS BIGINT) AS whole FROM (
        SELECT *, (source_size + {block} - 1) DIV {block} AS blocks FROM {sources} WHERE source_size > 0)))"""


def drawn_shard(all_slots: str, shard_slots: int) -> str:
    """SQL: the output shard that one trial of a source falls to."""
    return f"{mixed('slot', 'ordinal * 101 + 5')} % (({all_slots} + {shard_slots} - 1) DIV {shard_slots})"


def starts(block: str) -> str:
    """SQL: the first word of a block in its source."""
    return f"({block} * least_words + least({block}, longer))"


def block_of(word: str) -> str:
    """SQL: the block that holds a word of a source."""
    return f"CASE WHEN {word} < longer * (least_words + 1) THEN ({word}) DIV (least_words + 1) ELSE longer + ({word} - longer * (least_words + 1)) DIV least_words END"


def drawn_counts(counted: DataFrame, shard_slots: int) -> DataFrame:
    """ordinal, shard, drawn, first: the slots each output shard draws of each source, and the first of them.

    Every slot of a source is one trial over the shards, by hash, so the counts are multinomial with totals that fill
    the targets; a shard's own counts of sources are multinomial with the sources' shares, given those totals. The
    running sums are taken in groups of 4096 shards and over the groups.
    """
    spark = counted.sparkSession
    trials = (counted.select("ordinal", "slots", "all_slots")
              .withColumn("far", F.explode(F.expr("sequence(0L, (slots - 1) div 16777216)")))
              .withColumn("near", F.explode(F.expr("sequence(far * 4096, least(far * 4096 + 4095, (slots - 1) div 4096))")))
              .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "ordinal", "near")
              .withColumn("slot", F.explode(F.expr("sequence(near * 4096, least(near * 4096 + 4095, slots - 1))"))))
    counts = (trials.withColumn("shard", F.expr(drawn_shard("all_slots", shard_slots))).groupBy("ordinal", "shard").agg(F.count(F.lit(1)).alias("drawn"))
              .withColumn("far", F.expr("shard div 4096")))
    groups = (counts.groupBy("ordinal", "far").agg(F.sum("drawn").alias("n"))
              .withColumn("before", F.expr("coalesce(sum(n) over (partition by ordinal order by far rows between unbounded preceding and 1 preceding), 0)")).drop("n"))
    inside = counts.withColumn("inside", F.expr("sum(drawn) over (partition by ordinal, far order by shard rows between unbounded preceding and current row) - drawn"))
    return inside.join(groups, ["ordinal", "far"]).select("ordinal", "shard", "drawn", F.expr("before + inside").alias("first"))


def deal(sources: DataFrame, block: int, cap: int, shard_slots: int) -> DataFrame:
    """One row per slot of the mix: ordinal, shard, slot, block, rest (words taken from the block's start; null: all).

    A shard takes the run of slots that its drawn counts give it (see ``drawn_counts``). Slot i of a source takes block
    perm(i mod blocks) of its epoch i div blocks; epochs have permutations of their own, so no block is taken
    ``cap`` + 1 times. Slots are made from small rows whose bytes say nothing of the work, so their number of partitions is set.
    """
    spark = sources.sparkSession
    sources.createOrReplaceTempView("quillframe_mix_sources")
    counted = spark.sql(slot_counts("quillframe_mix_sources", block, cap)).withColumn("all_slots", F.expr("sum(slots) over ()")).where("slots > 0")
    key = f"({mixed('ordinal * 1000 + e', 'r')} * {PRIME} + {mixed('ordinal * 1000 + e + 7', 'r')}) % blocks"
    add = f"(((ordinal * 1000 + e) * 31 + r) % {PRIME}) * 69621 + 1013904223"
    counts = drawn_counts(counted, shard_slots).join(counted.select("ordinal", "blocks", "whole", F.col("rest").alias("last_words")), "ordinal")
    wide = (counts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "ordinal", "shard")  # what a round needs is the same for all slots of an epoch
            .withColumn("rounds", F.expr(f"transform(sequence(0L, {cap - 1}L), e -> transform(sequence(1L, {ROUNDS}L), r -> struct({key} AS key, {add} AS add)))"))
            .withColumn("slot", F.explode(F.expr("sequence(first, first + drawn - 1)"))))
    linear = f"transform(array((greatest(x, p) % {PRIME} * 48271 + r.add) % {PRIME}), l -> CASE WHEN ((l * l) % {PRIME} * 16807 + l) % {PRIME} % 2 = 1 THEN p ELSE x END)[0]"
    step = f"transform(array((r.key + blocks - x) % blocks), p -> {linear})[0]"
    return (wide.withColumn("block", F.expr(f"aggregate(rounds[cast(slot div blocks as int)], slot % blocks, (x, r) -> {step})"))
            .select("ordinal", "shard", "slot", "block", F.expr("CASE WHEN slot = whole THEN last_words END").alias("rest")))


def placed(docs: DataFrame, chunks: int) -> DataFrame:
    """Each document's first word position in its source, without a window over a whole source.

    A source is cut into ``chunks`` by a hash of the id; positions are summed inside a chunk and offset by the
    chunks before it, of which a source has ``chunks`` at most.
    """
    cut = docs.withColumn("chunk", F.expr(f"{mixed('abs(coalesce(doc_id, 0) % ' + str(PRIME) + ')', '3')} % {chunks}"))
    sums = cut.groupBy("ordinal", "chunk").agg(F.sum("size").alias("chunk_size"))
    offsets = sums.withColumn("before", F.expr("coalesce(sum(chunk_size) over (partition by ordinal order by chunk rows between unbounded preceding and 1 preceding), 0)"))
    inside = cut.withColumn("inside", F.expr("sum(size) over (partition by ordinal, chunk order by doc_id, size, text_hash rows between unbounded preceding and current row) - size"))
    return inside.join(offsets.select("ordinal", "chunk", "before"), ["ordinal", "chunk"]).withColumn("start", F.expr("before + inside")).drop("chunk", "before", "inside")


def taken_part() -> str:
    """SQL: words that the slots of a block take from the part of a document in it."""
    whole = f"(least(start + size, {starts('(block + 1)')}) - greatest(start, {starts('block')})) * coalesce(times, 0)"
    return f"{whole} + greatest(least(start + size, {starts('block')} + coalesce(rest, 0)) - greatest(start, {starts('block')}), 0)"


def mix(documents: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for ``documents`` with columns doc_id, source, text."""
    return taken_words(documents, **options).drop("text_hash")


def taken_words(documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, block: int = 64, shard_slots: int = 4096, chunks: int = 256) -> DataFrame:
    """The mix row by row, with the hash of each row's text."""
    sized = saved(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("text_hash"),
                                   F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("bigint").alias("size")))
    sources = saved(shares(sized, weights, cap))
    known = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    takes = (deal(sources, block, cap, shard_slots).groupBy("ordinal", "block")
             .agg(F.expr("count_if(rest IS NULL)").alias("times"), F.expr("coalesce(sum(rest), 0)").alias("rest")))
    sources.createOrReplaceTempView("quillframe_mix_sources")
    packed = documents.sparkSession.sql(slot_counts("quillframe_mix_sources", block, cap)).select("ordinal", "least_words", "longer")
    full = placed(known.where("size > 0"), chunks).join(packed, "ordinal")
    cuts = (full.withColumn("block", F.explode(F.expr(f"sequence({block_of('start')}, {block_of('(start + size - 1)')})")))
            .join(takes, ["ordinal", "block"], "left"))
    taken = (cuts.withColumn("words", F.expr(taken_part()))
             .groupBy("ordinal", "start", "doc_id", "source", "text_hash", "size", "source_size", "target")
             .agg(F.sum("words").alias("taken")))
    columns = ["doc_id", "source", "text_hash", "size", "source_size", "target", "taken"]
    return taken.select(columns).unionByName(known.where("size = 0").withColumn("taken", F.lit(0).cast("bigint")).select(columns))


def copies(documents: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves: each row as many times as the mix takes its words.

    Rows are decided one by one, told apart by id, source and text, so rows without an id or with a shared one are
    documents of their own. A part of a time counts as a whole one with a chance of that part, by a hash of these, so that
    a source's words come near its target also where every document would round the same way. Rows that agree in all
    three share the times of all of them; wholly equal rows are counted, not numbered, so their number does not matter.
    A row without words adds nothing to any share and stays once.
    """
    names = documents.columns
    plain = documents.toDF(*(f"c{i}" for i in range(len(names))))  # no name of the documents can meet one of the plan
    doc_id, source, text = (plain[f"c{names.index(c)}"] for c in ("doc_id", "source", "text"))
    plan = (taken_words(documents, **options).groupBy(*(F.col(k).alias(f"_{k}") for k in ("doc_id", "source", "text_hash")))
            .agg(F.sum("taken").alias("_taken"), F.max("size").alias("_size"), F.count(F.lit(1)).alias("_rows")))
    same = doc_id.cast("bigint").eqNullSafe(F.col("_doc_id")) & source.cast("string").eqNullSafe(F.col("_source")) & (F.xxhash64(text) == F.col("_text_hash"))
    joined = plain.join(plan, same).withColumn("_draw", F.expr(f"{mixed(f'pmod(xxhash64(_doc_id, _source), {PRIME})', f'pmod(_text_hash, {PRIME})')} / {PRIME}D"))
    whole = "case when _size = 0 then {n} else {n} * _taken div (_size * _rows) + case when ({n} * _taken % (_size * _rows)) / cast(_size * _rows as double) > _draw then 1 else 0 end end"
    alone = joined.where("_rows = 1").withColumn("_times", F.expr(whole.format(n="1L"))).select(*plain.columns, "_times")
    equal = (joined.where("_rows > 1").groupBy(*plain.columns, "_taken", "_size", "_rows", "_draw").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_times", F.expr(whole.format(n="_n"))).select(*plain.columns, "_times"))
    # A count of equal rows may be large; parts of it are dealt out as rows, each part within one array.
    times = alone.unionByName(equal).where("_times > 0").withColumn("_far", F.explode(F.expr("sequence(0L, (_times - 1) div 4096)")))
    return times.withColumn("_near", F.explode(F.expr("sequence(1L, least(4096L, _times - _far * 4096))"))).select(plain.columns).toDF(*names)


def oracle(weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, block: int = 64, shard_slots: int = 4096, chunks: int = 256) -> str:
    """The same mix in DuckDB SQL."""
    cycle = "CASE CAST(ordinal % {} AS INT) {} END".format(len(weights), " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights)))
    step = swap_step("x", "r", "blocks", "(ordinal * 1000 + slot // blocks)")
    chunk = f"{mixed('abs(coalesce(doc_id, 0) % ' + str(PRIME) + ')', '3')} % {chunks}"
    return f"""
    WITH sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
    targets AS ({shares_sql('sized', cycle, cap)}),
    slots AS ({slot_counts("targets", block, cap)}),
    trials AS (SELECT ordinal, unnest(range(slots)) AS slot, (SELECT CAST(sum(slots) AS BIGINT) FROM slots) AS all_slots FROM slots),
    drawn AS (SELECT ordinal, {drawn_shard("all_slots", shard_slots)} AS shard, count(*) AS drawn FROM trials GROUP BY 1, 2),
    runs AS (SELECT *, CAST(sum(drawn) OVER (PARTITION BY ordinal ORDER BY shard ROWS UNBOUNDED PRECEDING) AS BIGINT) - drawn AS first FROM drawn),
    dealt AS (SELECT ordinal, shard, unnest(range(first, first + drawn)) AS slot FROM runs),
    placed_slots AS (SELECT ordinal, CASE WHEN slot = whole THEN s.rest END AS rest,
        list_reduce(range(1, {ROUNDS + 1}), lambda x, r: {step}, slot % blocks) AS block FROM dealt JOIN slots s USING (ordinal)),
    takes AS (SELECT ordinal, block, count(*) FILTER (WHERE rest IS NULL) AS times, CAST(coalesce(sum(rest), 0) AS BIGINT) AS rest FROM placed_slots GROUP BY 1, 2),
    known AS (SELECT d.*, t.ordinal, t.source_size, t.target, {chunk} AS chunk FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
    starts AS (SELECT *, CAST(sum(size) OVER (PARTITION BY ordinal ORDER BY chunk, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start FROM known WHERE size > 0),
    placed AS (SELECT k.*, least_words, longer FROM starts k JOIN slots s ON k.ordinal = s.ordinal),
    cuts AS (SELECT *, unnest(range({block_of('start')}, {block_of('(start + size - 1)')} + 1)) AS block FROM placed)
    SELECT doc_id, source, size, source_size, target, CAST(sum({taken_part()}) AS BIGINT) AS taken
    FROM cuts LEFT JOIN takes USING (ordinal, block) GROUP BY ordinal, start, doc_id, source, size, source_size, target
    UNION ALL SELECT doc_id, source, size, source_size, target, CAST(0 AS BIGINT) FROM known WHERE size = 0
    """.replace(" DIV ", " // ")
