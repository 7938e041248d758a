"""Mixing sources to target weights by a low-discrepancy schedule.

Every source has blocks of its own length: 1024 words, less where the target
is small, so that a source has ``MIN_SLOTS`` slots or one for each word of its
target. The i-th slot of the mix is the i-th point of the golden-ratio
sequence (integer arithmetic modulo 2**32, so every engine gets the same
points). The points are mapped through the cumulative slot shares of the
sources; the rank of a slot within its source says which equal-token block of
the source's shuffled stream it takes, going round the stream at most three
times. The points that fall to a source differ from its share by a few at any
number of points, so its words differ from the target by a few of its blocks.

Points meet sources by an equi-join on cells of the unit interval that are as
wide as the smallest share, so a cell touches few sources however many there
are.

Shuffled stream: documents of a source in md5 order of their id. Positions
are running sums over 4096 hash ranges per source plus an offset table, so a
source with a third of all rows is spread over as many tasks; slot ranks are
counted the same way over stretches of the sequence. Blocks are cut from the
stream at multiples of the block length, so a document has as many fragments
as blocks it touches.

Targets: source totals times weights (1, 2, 3, repeating in code-point order,
null last) share all words; a target stops at three times its source's size
and the excess goes to the others by weight. This water level is found in
closed form from one sorted pass over the sources.

Defined results: a null or blank text has size 0 and takes nothing; a null
source is a source of its own, last in order; documents with equal or null
ids are separate rows (ties by text hash, equal rows are interchangeable);
without any word every target is 0; an empty table gives an empty result;
only the named columns are read, the others stay with the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from brasa.session import cut_lineage

from .common import table, words

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BLOCK_TOKENS = 1024
#: A source has so many slots at least, or as many as its target has words.
MIN_SLOTS = 256
GOLDEN = 2654435769  # 2**32 / golden ratio
STRETCH = 65_536


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size`` -> the same with ``sid``, ``target``, ``length`` (words of a block), ``n_blocks``,
    ``slots``, ``lo`` and ``hi`` (the source's range of 2**32).

    The windows run over the table of sources (one row each), not over documents.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(by_name) - 1) % len(WEIGHTS)) + 1)
    s = sizes.select("source", "source_size", weight.cast("double").alias("weight"),
                     (F.col("source_size") * MAX_EPOCHS).cast("double").alias("most"))
    # sources fill up in order of most / weight; the level of the first that does not fill up holds for the rest
    ratio = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(W.unboundedPreceding, -1)
    after = ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    level = (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    s = s.withColumn("level", level).withColumn("rank", F.row_number().over(ratio))
    first_open = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct("rank", "level"))
    s = s.withColumn("water", F.min(first_open).over(everything)["level"])
    s = s.withColumn("target", F.when(F.col("total") > 0, F.least(F.col("most"), F.col("water") * F.col("weight")))
                     .otherwise(F.lit(0.0)))
    length = F.greatest(F.lit(1.0), F.least(F.lit(float(BLOCK_TOKENS)), F.floor(F.col("target") / MIN_SLOTS).cast("double")))
    s = s.withColumn("length", length.cast("long")).withColumn("n_blocks", F.expr("(source_size + length - 1) div length"))
    slots = F.floor(F.col("n_blocks") * F.col("target") / F.col("source_size") + 0.5)
    s = s.withColumn("slots", F.when(F.col("source_size") > 0, slots).otherwise(0).cast("long"))
    part = by_name.rowsBetween(W.unboundedPreceding, W.currentRow)
    s = s.withColumn("cum", F.sum("slots").over(part)).withColumn("all", F.sum("slots").over(everything))
    edge = F.when(F.col("all") > 0, F.floor(F.col("cum") / F.col("all") * 2.0 ** 32)).otherwise(0)
    s = s.withColumn("hi", F.when(F.lead(F.lit(1)).over(by_name).isNull(), F.lit(2 ** 32)).otherwise(edge))
    return s.withColumn("lo", F.coalesce(F.lag("hi").over(by_name), F.lit(0))).select(
        "source", F.row_number().over(by_name).alias("sid"), "source_size", "target", "length", "n_blocks", "slots", "lo", "hi")


def schedule(spark: SparkSession, sources: DataFrame, slots: int) -> DataFrame:
    """``sid, block, times``: how often the schedule takes each block of each source's stream."""
    low, high = F.col("id") % STRETCH, F.shiftright(F.col("id") % 2 ** 32, 16)
    point = (low * GOLDEN + (high * GOLDEN % STRETCH) * STRETCH) % 2 ** 32
    # a cell is as wide as MIN_SLOTS slots, so it touches few sources; a source is listed under each cell of its range
    cell = max(1, 2 ** 32 * MIN_SLOTS // max(1, slots))
    points = spark.range(slots).select("id", point.alias("point")).withColumn("cell", F.expr(f"point div {cell}"))
    cells = sources.where("hi > lo and slots > 0").select(
        "sid", "lo", "hi", "n_blocks", F.explode(F.sequence(F.expr(f"lo div {cell}"), F.expr(f"(hi - 1) div {cell}"))).alias("cell"))
    dealt = points.join(cells, "cell").where("point >= lo and point < hi").select(
        "sid", "id", "n_blocks", F.expr(f"id div {STRETCH}").alias("stretch"))
    before = W.partitionBy("sid").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    offsets = dealt.groupBy("sid", "stretch").agg(F.count("*").alias("n")).select(
        "sid", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(W.partitionBy("sid", "stretch").orderBy("id")) - 1
    ranked = dealt.withColumn("within", within).join(offsets, ["sid", "stretch"]).select(
        "sid", "n_blocks", (F.col("within") + F.col("offset")).alias("rank"))
    return (ranked.where(F.col("rank") < F.col("n_blocks") * MAX_EPOCHS)
            .groupBy("sid", (F.col("rank") % F.col("n_blocks")).alias("block")).agg(F.count("*").alias("times")))


def mix(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row of ``df``."""
    order = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    docs = cut_lineage(df.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.size(words(F.col(text))).cast("long").alias("size"), order.alias("order"), F.xxhash64(text).alias("tie"),
        F.conv(F.substring(order, 1, 3), 16, 10).cast("int").alias("range")))
    ranges = docs.groupBy("source", "range").agg(F.sum("size").alias("n"))
    sources = cut_lineage(targets(ranges.groupBy("source").agg(F.sum("n").alias("source_size"))))
    times = schedule(df.sparkSession, sources, int(sources.agg(F.sum("slots")).first()[0] or 0))

    named = sources.select(F.col("source").alias("__s"), "sid", "source_size", "target", "length")
    same = F.col("source").eqNullSafe(F.col("__s"))
    before = W.partitionBy("sid").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranges.join(named, same).select(
        "sid", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    running = F.sum("size").over(W.partitionBy("sid", "range").orderBy("order", "doc_id", "tie")
                                 .rowsBetween(W.unboundedPreceding, W.currentRow))
    facts = ["doc_id", "source", "size", "source_size", "target"]
    placed = (docs.where("size > 0").join(named, same).withColumn("end", running).join(offsets, ["sid", "range"])
              .select("sid", "length", *facts, (F.col("end") + F.col("offset") - F.col("size")).alias("start"),
                      (F.col("end") + F.col("offset")).alias("end")))
    pieces = placed.select("*", F.explode(F.expr("sequence(start div length, (end - 1) div length)")).alias("block"))
    part = F.least("end", (F.col("block") + 1) * F.col("length")) - F.greatest("start", F.col("block") * F.col("length"))
    # a document with words is known by its place in the stream
    taken = (pieces.join(times, ["sid", "block"], "left").groupBy("sid", "start", *facts)
             .agg(F.sum(part * F.coalesce("times", F.lit(0))).cast("long").alias("taken")))
    blank = docs.where("size = 0").join(named, same).select(*facts, F.lit(0).cast("long").alias("taken"))
    return taken.select(*facts, "taken").unionByName(blank)


def query(spark, sf_dir) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")


def mix_sql(docs: str = "documents") -> str:
    """DuckDB SQL of :func:`mix` (document ids unique)."""
    split = "regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+')"
    return f"""
m_docs AS (SELECT doc_id, source, CAST(len(list_filter({split}, lambda x: x <> '')) AS BIGINT) AS size,
             md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS ord FROM {docs}),
m_w AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
          CAST([{', '.join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS DOUBLE) AS weight
        FROM m_docs GROUP BY source),
m_t AS (SELECT *, CAST(source_size * {MAX_EPOCHS} AS DOUBLE) AS most, CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM m_w),
m_l AS (SELECT *, (total - coalesce(sum(most) OVER (ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / sum(weight) OVER (ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
          row_number() OVER (ORDER BY most / weight, source ASC NULLS LAST) AS rk FROM m_t),
m_o AS (SELECT *, arg_min(level, CASE WHEN level * weight <= most THEN rk END) OVER () AS water FROM m_l),
m_g AS (SELECT *, CASE WHEN total > 0 THEN least(most, water * weight) ELSE 0.0 END AS target FROM m_o),
m_z AS (SELECT *, CAST(greatest(1.0, least({float(BLOCK_TOKENS)}, floor(target / {MIN_SLOTS}))) AS BIGINT) AS length FROM m_g),
m_n AS (SELECT *, (source_size + length - 1) // length AS n_blocks FROM m_z),
m_q AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(n_blocks * target / source_size + 0.5) AS BIGINT) ELSE 0 END AS slots FROM m_n),
m_c AS (SELECT *, sum(slots) OVER (ORDER BY source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
          sum(slots) OVER () AS n_slots, row_number() OVER (ORDER BY source ASC NULLS LAST) AS sid, count(*) OVER () AS n FROM m_q),
m_h AS (SELECT *, CASE WHEN sid = n THEN 4294967296 WHEN n_slots > 0
          THEN CAST(floor(CAST(cum AS DOUBLE) / CAST(n_slots AS DOUBLE) * 4294967296.0) AS BIGINT) ELSE 0 END AS hi FROM m_c),
m_s AS (SELECT *, coalesce(lag(hi) OVER (ORDER BY sid), 0) AS lo FROM m_h),
m_p AS (SELECT i, CAST(CAST(i AS HUGEINT) * {GOLDEN} % 4294967296 AS BIGINT) AS point
        FROM (SELECT unnest(range(CAST(max(n_slots) AS BIGINT))) AS i FROM m_s)),
m_r AS (SELECT s.sid, s.n_blocks, row_number() OVER (PARTITION BY s.sid ORDER BY i) - 1 AS rnk
        FROM m_p JOIN m_s s ON point >= lo AND point < hi AND s.slots > 0),
m_x AS (SELECT sid, rnk % n_blocks AS block_no, count(*) AS times FROM m_r WHERE rnk < n_blocks * {MAX_EPOCHS} GROUP BY ALL),
m_e AS (SELECT d.*, s.sid, s.source_size, s.target, s.length,
          sum(size) OVER (PARTITION BY s.sid ORDER BY ord, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fin
        FROM m_docs d JOIN m_s s ON d.source IS NOT DISTINCT FROM s.source),
m_f AS (SELECT e.*, unnest(range(CAST((fin - size) // length AS BIGINT), CAST((fin - 1) // length + 1 AS BIGINT))) AS block_no
        FROM m_e e WHERE size > 0),
m_k AS (SELECT f.sid, f.doc_id, f.fin, CAST(sum((least(fin, (f.block_no + 1) * f.length) - greatest(fin - size, f.block_no * f.length)) * coalesce(times, 0)) AS BIGINT) AS taken
        FROM m_f f LEFT JOIN m_x x ON x.sid = f.sid AND x.block_no = f.block_no GROUP BY ALL),
mixed AS (SELECT e.doc_id, e.source, e.size, e.source_size, e.target, coalesce(k.taken, 0) AS taken
        FROM m_e e LEFT JOIN m_k k ON k.sid = e.sid AND k.fin = e.fin AND e.size > 0 AND k.doc_id IS NOT DISTINCT FROM e.doc_id)"""


def oracle(docs: str = "documents") -> str:
    return f"WITH {mix_sql(docs)}\nSELECT * EXCLUDE (source) FROM mixed"
