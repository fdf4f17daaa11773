"""Mixing sources to target weights by Pareto order sampling.

A source's target, in words, is its share by weight of the whole mix, at most CEILING times what the
source has; what is cut off there is shared again by weight among the others (water filling).

Inside a source a document's expected number of copies is min(CEILING, kappa * level), where level is
the bit length of its word count: documents of some length are likelier than scraps. kappa makes the
expected words meet the target. The whole part of that number is taken for certain; the rest p is an
inclusion probability, and the documents are ranked by Pareto order, the random odds u/(1-u) divided
by the inclusion odds p/(1-p), the least first. The sample's size is fixed in words: documents are
taken in this order until the words still wanted are met to within half a document.

Random numbers are hashes of seed, doc_id and text: reruns and recomputed partitions agree. Nothing
orders a whole source in one task: the rank at which a source is cut is first found to within one of
CELLS cells of a histogram, and only that cell's documents are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import count_words, small, text_of, unused, written

WEIGHTS = (5, 2, 1)
VOLUME_PERCENT = 150
CEILING = 2
SEED = "mix-1"
#: Cells of the Pareto ranks of a source; one cell's documents are sorted in one task.
CELLS = 1 << 16
#: Logarithms of ranks lie within this on either side of 0: twice that of the odds of 52-bit numbers.
LOGS = 75.0


def draw(df: DataFrame, seed: str = SEED) -> Column:
    """52 random bits of a row, from its doc_id and text."""
    row = F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text_of(F.col("text"))))
    return F.conv(F.substring(F.md5(row), 1, 13), 16, 10).cast("long")


def level_of(size: Column) -> Column:
    return F.when(size > 0, F.length(F.bin(size))).otherwise(1).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, percent: int = VOLUME_PERCENT, ceiling: int = CEILING) -> DataFrame:
    """sizes (source, source_size: one row a source) with each source's target.

    The windows run over one row a source, never over documents. Sources take the weights in turn,
    in code-point order, null last.
    """
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int"))
    most = F.col("source_size") * ceiling
    order = W.orderBy((F.col("most") / F.col("weight")), F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", weight).withColumn("most", most)
    filled = ranked.select(
        "*",
        F.sum("source_size").over(W.partitionBy(F.lit(0))).alias("all_size"),
        F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("capped"),
        F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)).alias("open_weight"),
    )
    water = (F.col("all_size") * percent / F.lit(100.0) - F.col("capped")) / F.col("open_weight")
    filled = filled.withColumn("water", water)
    holds = F.when(F.col("water") * F.col("weight") <= F.col("most"), F.col("water"))
    filled = filled.withColumn("level_water", F.first(holds, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    target = F.least(F.col("most").cast("double"), F.coalesce(F.col("level_water") * F.col("weight"), F.col("most").cast("double")))
    return filled.select("source", "source_size", target.alias("target"))


def source_rates(light: DataFrame, ceiling: int = CEILING, **shares) -> DataFrame:
    """Per source: source_size, target and kappa. light: source, size, level (one row a document)."""
    levels = light.groupBy("source", "level").agg(F.sum("size").alias("words"))
    targets = source_targets(levels.groupBy("source").agg(F.sum("words").alias("source_size")), ceiling=ceiling, **shares)
    order = W.partitionBy("source").orderBy(F.col("level").desc())
    # at most 64 levels a source: water filling from the highest level down
    targets = targets.withColumnRenamed("source", "of")
    near = levels.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    near = near.select(
        "*",
        F.coalesce(F.sum("words").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("above"),
        F.sum(F.col("level") * F.col("words")).over(order.rowsBetween(0, W.unboundedFollowing)).alias("weighted"),
    )
    kappa = F.when(F.col("weighted") > 0, (F.col("target") - ceiling * F.col("above")) / F.col("weighted"))
    near = near.withColumn("kappa", kappa)
    fits = F.when(F.col("kappa") * F.col("level") <= ceiling, F.col("level"))
    return near.groupBy("source").agg(
        F.max("source_size").alias("source_size"),
        F.max("target").alias("target"),
        F.coalesce(F.max_by("kappa", fits), F.lit(float(ceiling))).alias("kappa"),
    )


def expected(kappa: Column, level: Column, ceiling: int = CEILING) -> Column:
    return F.least(F.lit(float(ceiling)), kappa * level)


def pareto(bits: Column, p: Column) -> Column:
    """Random odds over inclusion odds; null where nothing is left to chance."""
    u = (bits + F.lit(0.5)) / F.lit(float(1 << 52))
    return F.when(p > 0, (u / (1 - u)) / (p / (1 - p)))


def cell_of(rank: Column, cells: int) -> Column:
    """Equal steps of the rank's logarithm, which is a logistic number shifted by the inclusion odds: no cell holds
    more than one in a thousand of a level's documents (at CELLS), however small or large their chance."""
    return F.least(F.greatest(F.floor((F.ln(rank) + LOGS) / (2 * LOGS) * cells), F.lit(0)), F.lit(cells - 1)).cast("long")


def plan_mix(light: DataFrame, ceiling: int = CEILING, cells: int = CELLS, **shares) -> DataFrame:
    """Per source: source_size, target, kappa, and the last Pareto key taken (cut_cell; cut: rank, bits, size).

    light: source, size, level, bits; one row a document, written before (it is read several times).
    """
    rates = small(source_rates(light, ceiling, **shares))
    drawn = _ranked(light, rates, ceiling)
    whole = drawn.groupBy("of").agg(F.sum(F.col("size") * F.col("sure")).alias("sure_words"))
    wanted = rates.join(whole, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", "source_size", "target", "kappa", (F.col("target") - F.coalesce(F.col("sure_words"), F.lit(0))).alias("wanted")
    )
    wanted = small(wanted)
    ranks = drawn.where(F.col("rank").isNotNull())
    ranks = ranks.withColumn("cell", cell_of(F.col("rank"), cells))
    sums = ranks.groupBy("of", "cell").agg(F.sum("size").alias("words"))
    start = F.coalesce(F.sum("words").over(W.partitionBy("of").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("start", start).join(wanted.select(F.col("source").alias("s"), "wanted"), F.col("of").eqNullSafe(F.col("s")))
    # the last cell that begins within what is wanted: the cut lies in it, or is its predecessor's end
    at = sums.where(F.col("start") <= F.col("wanted")).groupBy("of").agg(F.max_by(F.struct("cell", "start", "wanted"), "cell").alias("at"))
    at = small(at.select(F.col("of").alias("s"), F.col("at.cell").alias("c"), "at.start", "at.wanted"))
    # rows alike have one key: they are counted before they meet, and the cut may take some of them
    edge = ranks.join(at, F.col("of").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c"))).groupBy("of", "rank", "bits", "size", "start", "wanted").agg(F.count("*").alias("n"))
    before = W.partitionBy("of").orderBy("rank", "bits", "size").rowsBetween(W.unboundedPreceding, -1)
    edge = edge.withColumn("ahead", F.col("start") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(before), F.lit(0)))
    fits = lambda i: F.col("ahead") + i * F.col("size") + F.col("size") / F.lit(2.0) <= F.col("wanted")
    most = F.when(F.col("size") == 0, F.col("n")).otherwise(F.least(F.col("n"), F.floor((F.col("wanted") - F.col("ahead")) / F.col("size") + 0.5).cast("long") + 1))
    # the quotient may be off by one at a boundary: the last of them must itself fit
    take = F.when(fits(F.col("most") - 1), F.col("most")).when(fits(F.col("most") - 2), F.col("most") - 1).otherwise(F.col("most") - 2)
    edge = edge.withColumn("most", most).withColumn("take", F.when(fits(F.lit(0)), F.greatest(take, F.lit(1))).otherwise(0))
    cut = edge.where(F.col("take") > 0).groupBy("of").agg(F.max(F.struct("rank", "bits", "size", "n", "take")).alias("last"))
    cut = cut.select("of", F.struct("last.rank", "last.bits", "last.size").alias("cut"), F.when(F.col("last.take") < F.col("last.n"), F.col("last.take")).alias("some"))
    done = at.join(cut, F.col("s").eqNullSafe(F.col("of")), "left").select("s", "c", "cut", "some")
    return wanted.join(done, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "kappa", F.col("c").alias("cut_cell"), "cut", "some"
    )


def _ranked(light: DataFrame, rates: DataFrame, ceiling: int) -> DataFrame:
    """light with of (its source), sure (whole copies) and rank (the Pareto order, null without a chance)."""
    rate = rates.select(F.col("source").alias("s"), F.col("kappa").alias("k"))
    joined = light.withColumnRenamed("source", "of").join(rate, F.col("of").eqNullSafe(F.col("s"))).drop("s")
    copies = joined.withColumn("copies", expected(F.col("k"), F.col("level"), ceiling)).withColumn("sure", F.floor("copies"))
    return copies.withColumn("rank", pareto(F.col("bits"), F.col("copies") - F.col("sure"))).drop("copies", "k")


def copies_taken(size: Column, level: Column, bits: Column, kappa: Column, cut_cell: Column, cut: Column, some: Column, ceiling: int = CEILING, cells: int = CELLS) -> tuple[Column, Column]:
    """How often the mix takes a document: its certain copies, and one more up to the cut of its source; and whether it lies at a cut
    that takes only some of the rows alike, which are then dealt apart (see dealt)."""
    share = expected(kappa, level, ceiling)
    sure = F.floor(share)
    rank = pareto(bits, share - sure)
    cell, key = cell_of(rank, cells), F.struct(rank.alias("rank"), bits.alias("bits"), size.alias("size"))
    at_cut = rank.isNotNull() & (cell == cut_cell) & cut.isNotNull()
    tied = F.coalesce(at_cut & some.isNotNull() & (key == cut), F.lit(False))
    drawn = rank.isNotNull() & ((cell < cut_cell) | (at_cut & (key <= cut))) & ~tied
    return sure + F.coalesce(drawn, F.lit(False)).cast("long"), tied


def dealt(rows: DataFrame, plan: DataFrame, own: list[str], copies: str, tied: str, some: str) -> DataFrame:
    """rows, of which one copy more is taken of `some` of the tied ones.

    Tied rows of a source are alike in doc_id, text and source. They are counted by their own columns and given back
    as often as there were, numbered; which of them get the copy makes no difference where they are alike in all.
    """
    if not plan.where(F.col("some").isNotNull()).limit(1).count():
        return rows
    n, i, ahead = unused(rows, "n", "i", "ahead")
    alike = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    kinds = dict(rows.dtypes)
    once = rows.where(~F.col(tied))
    if any("map" in kinds[c] or "variant" in kinds[c] for c in rows.columns):  # such columns can't be grouped by
        numbered = rows.where(F.col(tied)).withColumn(i, F.row_number().over(W.partitionBy(*own).orderBy(F.monotonically_increasing_id())))
    else:
        many = rows.where(F.col(tied)).groupBy(alike.alias(i)).agg(F.count("*").alias(n)).select(f"{i}.*", n)
        before = W.partitionBy(*own).orderBy(F.hash(*[F.col(f"`{c}`") for c in rows.columns]), *[F.col(f"`{c}`") for c in own]).rowsBetween(W.unboundedPreceding, -1)
        many = many.withColumn(ahead, F.coalesce(F.sum(n).over(before), F.lit(0)))
        numbered = many.withColumn(i, F.explode(F.sequence(F.col(ahead) + 1, F.col(ahead) + F.col(n)))).drop(n, ahead)
    taken = numbered.withColumn(copies, F.col(copies) + (F.col(i) <= F.col(some)).cast("long")).drop(i)
    return once.unionByName(taken)


def mix(docs: DataFrame, names: tuple[str, ...] = ("size", "source_size", "target", "copies"), seed: str = SEED, **shares) -> DataFrame:
    """docs with four columns more: size in words, source_size, target (words) and copies (0, 1 or 2).

    docs needs doc_id, text and source; columns called like the new ones are replaced. Null texts are
    empty (size 0); null sources are one source, the last; rows alike in doc_id, text and source draw
    alike, and a cut that falls among them takes some of them; an empty table gives no rows. The text itself is
    never shuffled, but for such rows: only light rows are.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {n.lower() for n in names}])
    size = count_words(F.col("text"))
    light = docs.select("source", size.alias("size"), draw(docs, seed).alias("bits")).withColumn("level", level_of(F.col("size")))
    found = small(plan_mix(written(light, "mix"), **shares))
    s, k, bits, z, src, tgt, cell, cut, some, copies, tied = unused(docs, "s_", "k_", "bits_", "z_", "src_", "tgt_", "cell_", "cut_", "some_", "copies_", "tied_")
    plan = found.select(F.col("source").alias(s), F.col("kappa").alias(k), F.col("source_size").alias(src), F.col("target").alias(tgt), F.col("cut_cell").alias(cell), F.col("cut").alias(cut), F.col("some").alias(some))
    sized = docs.withColumns({z: size, bits: draw(docs, seed)})
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col(s)))
    taken, at_cut = copies_taken(F.col(z), level_of(F.col(z)), F.col(bits), F.col(k), F.col(cell), F.col(cut), F.col(some))
    own = [F.col(f"`{c}`") for c in docs.columns]
    rows = dealt(joined.select(*own, z, src, tgt, some, taken.alias(copies), at_cut.alias(tied)), found, ["source"], copies, tied, some)
    return rows.select(*own, F.col(z).alias(names[0]), F.col(src).alias(names[1]), F.col(tgt).alias(names[2]), F.col(copies).alias(names[3]))


def mix_words(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    light = docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), draw(docs).alias("bits"))
    light = written(light.withColumn("level", level_of(F.col("size"))), "mix")
    plan = small(plan_mix(light.drop("doc_id")))
    taken, tied = copies_taken(F.col("size"), F.col("level"), F.col("bits"), F.col("kappa"), F.col("cut_cell"), F.col("cut"), F.col("some"))
    joined = light.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    rows = dealt(joined.select("doc_id", "source", "size", "source_size", "target", "some", taken.alias("copies"), tied.alias("tied")), plan, ["source"], "copies", "tied", "some")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its own columns only."""
    size, src, tgt, copies, i = unused(docs, "size", "source_size", "target", "copies", "i")
    counted = mix(docs, (size, src, tgt, copies))
    return counted.where(F.col(copies) > 0).withColumn(i, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*docs.columns)


SQL = """
WITH d AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text,''), '[^\\x20\\x09-\\x0D]+')) AS size,
    ('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR),'') || '|' || md5(coalesce(text,''))), 1, 13))::BIGINT AS bits
  FROM documents),
l AS (SELECT *, CASE WHEN size > 0 THEN length(bin(size)) ELSE 1 END AS level FROM d),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM l GROUP BY source),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 2 AS most FROM s0),
s2 AS (SELECT *, (SELECT sum(source_size) FROM s0)::BIGINT AS all_size,
    coalesce(sum(most) OVER (ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped,
    (sum(weight) OVER (ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS open_weight FROM s1),
s3 AS (SELECT *, (all_size * 150 / 100.0::DOUBLE - capped) / open_weight AS water FROM s2),
w AS (SELECT arg_min(water, most / weight) AS water FROM s3 WHERE water * weight <= most),
t AS (SELECT source, source_size, least(most::DOUBLE, coalesce((SELECT water FROM w) * weight, most::DOUBLE)) AS target FROM s3),
v0 AS (SELECT source, level, sum(size)::BIGINT AS words FROM l GROUP BY source, level),
v1 AS (SELECT v0.*, source_size, target,
    coalesce(sum(words) OVER (PARTITION BY v0.source ORDER BY level DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS above,
    (sum(level * words) OVER (PARTITION BY v0.source ORDER BY level DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weighted
    FROM v0 JOIN t ON v0.source IS NOT DISTINCT FROM t.source),
v2 AS (SELECT *, CASE WHEN weighted > 0 THEN (target - 2 * above) / weighted END AS kappa FROM v1),
r AS (SELECT source, max(source_size) AS source_size, max(target) AS target,
    coalesce(arg_max(kappa, level) FILTER (WHERE kappa * level <= 2), 2.0) AS kappa FROM v2 GROUP BY source),
e AS (SELECT l.*, r.source_size, r.target, least(2.0::DOUBLE, kappa * level) AS share FROM l JOIN r ON l.source IS NOT DISTINCT FROM r.source),
f AS (SELECT *, floor(share)::BIGINT AS sure, share - floor(share) AS p, (bits + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM e),
g AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM f),
h AS (SELECT *, target - sum(size * sure) OVER (PARTITION BY source) AS wanted FROM g),
k AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, rank IS NULL ORDER BY rank, bits, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM h)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
  ((sure + CASE WHEN rank IS NOT NULL AND ahead + size / 2.0::DOUBLE <= wanted THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM k
"""
