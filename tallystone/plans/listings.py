"""Registered queries of scanned trees, logs by month, time zones and conditions over names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystone import fixtures as fx
from tallystone import sources
from tallystone.functions import zones
from tallystone.operators import filters, metrics, ranks
from tallystone.plans.registry import register
from tallystone.sources import scratch, trees


def table(spark, d, name):
    return fx.table(spark, d, name)


# --- trees
@register("SELECT 'source=' || coalesce(nullif(source, ''), '__HIVE_DEFAULT_PARTITION__') || '/lang=' || coalesce(nullif(lang, ''), '__HIVE_DEFAULT_PARTITION__') AS folder, sum(coalesce(strlen(text), 0) + 1)::BIGINT AS bytes FROM documents GROUP BY ALL")
def tree_folders(spark, d):
    """All texts as lines of files in folders by source and language, and what a scan of these folders finds."""
    root = scratch.new_path(spark, "texts")
    table(spark, d, "documents").select("source", "lang", "text").write.partitionBy("source", "lang").text(root)
    return trees.by_folder(trees.scan(spark, root), root).select("folder", "bytes")


# --- a log by month
def _shipments(spark, d):
    root = scratch.new_path(spark, "shipments")
    rows = table(spark, d, "lineitem").select(F.col("l_shipdate").cast("timestamp_ntz").alias("operation_timestamp"), "l_orderkey", "l_quantity")
    sources.write_monthly(rows, root)
    return root


_SHIPPED = "shipped AS (SELECT l_shipdate::TIMESTAMP AS t, l_quantity AS q FROM lineitem)"


@register(f"WITH {_SHIPPED} SELECT strftime(t, '%Y-%m') AS month, count(*) AS n, round(sum(q), 6)::DOUBLE AS quantity FROM shipped WHERE t >= TIMESTAMP '1994-03-10' AND t < TIMESTAMP '1995-02-01' GROUP BY ALL")
def log_of_months(spark, d):
    rows = sources.read_monthly(spark, _shipments(spark, d), fx.at("1994-03-10 00:00:00"), fx.at("1995-02-01 00:00:00"))
    month = F.date_format("operation_timestamp", "yyyy-MM").alias("month")
    return rows.groupBy(month).agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 6).cast("double").alias("quantity"))


@register(f"""WITH {_SHIPPED}, windows AS (SELECT n_nationkey AS label, TIMESTAMP '1993-01-20' + to_months((n_nationkey * 2)::INT) AS start, TIMESTAMP '1993-01-20' + to_months((n_nationkey * 2)::INT) + to_days((n_nationkey % 7 * 9)::INT) AS stop FROM nation)
SELECT label, count(*) AS n, round(sum(q), 6)::DOUBLE AS quantity FROM windows JOIN shipped ON t >= start AND t < stop GROUP BY label""")
def log_of_windows(spark, d):
    start = F.expr("add_months(DATE'1993-01-20', CAST(n_nationkey * 2 AS INT))")
    windows = table(spark, d, "nation").select(F.col("n_nationkey").alias("label"), start.cast("timestamp_ntz").alias("start"), F.date_add(start, F.expr("CAST(n_nationkey % 7 * 9 AS INT)")).cast("timestamp_ntz").alias("stop"))
    found = sources.during(spark.read.parquet(_shipments(spark, d)), windows)
    return found.groupBy("label").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 6).cast("double").alias("quantity"))


# --- time zones; the SQL has New York's rule of these years: first Sunday of April to last Sunday of October, at two
@register("""WITH o AS (SELECT o_orderkey, o_orderdate::TIMESTAMP + to_minutes((o_orderkey % 48 * 30)::INT) AS wall FROM orders),
e AS (SELECT *, make_date(year(wall), 4, 1) AS a, make_date(year(wall), 10, 31) AS b FROM o),
s AS (SELECT *, (a + ((7 - dayofweek(a)) % 7)::INT)::TIMESTAMP + INTERVAL 2 HOUR AS summer, (b - dayofweek(b)::INT)::TIMESTAMP + INTERVAL 2 HOUR AS winter FROM e)
SELECT o_orderkey, CASE WHEN wall >= summer + INTERVAL 1 HOUR AND wall < winter THEN wall + INTERVAL 4 HOUR ELSE wall + INTERVAL 5 HOUR END AS utc,
CASE WHEN wall >= summer + INTERVAL 5 HOUR AND wall < winter + INTERVAL 4 HOUR THEN wall - INTERVAL 4 HOUR ELSE wall - INTERVAL 5 HOUR END AS shown, epoch_us(wall) AS micros FROM s""")
def time_zones(spark, d):
    """Times without a zone: as a New York clock's, turned into UTC; as UTC, on such a clock; and as instants."""
    wall = F.expr("CAST(o_orderdate AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, CAST(o_orderkey % 48 * 30 AS INT))")
    rows = table(spark, d, "orders").select("o_orderkey", wall.alias("wall"))
    zone = "America/New_York"
    return rows.select("o_orderkey", zones.to_utc(F.col("wall"), zone).alias("utc"), zones.in_zone(F.col("wall"), zone).alias("shown"), F.unix_micros(zones.as_utc(F.col("wall"))).alias("micros"))


# --- conditions over names
_PARTS = ["reeau", "éi", "100%", "_x", "xt's"]


@register(r"""SELECT doc_id, regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])(the|les|und|que)($|[^\p{L}\p{N}_])') AS worded,
contains(text, 'reeau') OR contains(text, 'éi') OR contains(text, '100%') OR contains(text, '_x') OR contains(text, 'xt''s') AS parted,
contains(lower(strip_accents(text)), 'reeau') OR contains(lower(strip_accents(text)), 'ei') AS unaccented,
starts_with(source || '/' || lang, 'src1/') AS placed, source IN ('src1', 'src3', 'src4') AS chosen FROM documents""")
def name_conditions(spark, d):
    text, path = F.col("text"), F.concat_ws("/", "source", "lang")
    return table(spark, d, "documents").select(
        "doc_id",
        filters.has_word(text, ["the", "les", "und", "que"]).alias("worded"),
        filters.has_part(text, _PARTS).alias("parted"),
        filters.has_part_without_accents(text, ["reeau", "éI"]).alias("unaccented"),
        filters.below(path, "src1").alias("placed"),
        filters.in_trees(F.col("source"), ["src1", "src3", "src4"]).alias("chosen"),
    )


@register("SELECT DISTINCT w AS pth FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) WHERE w IS NOT NULL")
def listed_paths(spark, d):
    """The different entries of all lists, of which each list is rid of its own repeats first."""
    lists = table(spark, d, "documents").select(filters.listed(F.split("text", " ")).alias("paths"))
    return lists.select(F.explode("paths").alias("pth")).distinct()


# --- workers that are gone, and exact quantiles of one group that holds everything
@register("WITH t AS (SELECT DISTINCT 'w' || user_id % 40 AS worker FROM events), c AS (SELECT 'w' || user_id % 40 AS worker FROM events WHERE ts >= TIMESTAMP '2024-01-30 20:00:00') SELECT worker FROM t WHERE worker NOT IN (SELECT worker FROM c)")
def dead_workers(spark, d):
    rows = table(spark, d, "events").select(F.concat(F.lit("w"), F.col("user_id") % 40).alias("worker"), "ts")
    return metrics.dead_workers(rows, rows.where(F.col("ts") >= fx.at("2024-01-30 20:00:00")))


@register("SELECT round(quantile_cont(l_extendedprice::DOUBLE, 0.001), 6) AS p0_1, round(quantile_cont(l_extendedprice::DOUBLE, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice::DOUBLE, 0.999), 6) AS p99_9, count(*) AS n FROM lineitem")
def price_quantiles(spark, d):
    rows = table(spark, d, "lineitem").select(F.lit("all").alias("g"), F.col("l_extendedprice").cast("double").alias("v"))
    found = ranks.quantiles(rows, "g", "v", {"p0_1": 0.001, "p50": 0.5, "p99_9": 0.999})
    return found.select(*(F.round(c, 6).alias(c) for c in ("p0_1", "p50", "p99_9")), "n")
