"""Stage B queries: profiles, top-k, distributions, correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.operators import correlation, ordering, profiles, sketches
from tidepanel.operators.ordering import value_ladder
from tidepanel.plans import explore
from tidepanel.session import write_table
from tidepanel.spec import CALENDAR_EXCLUDED, CORRELATION_CATEGORIES, ENERGY
from tidepanel.workload import sql as s
from tidepanel.workload import tables as tb
from tidepanel.workload.registry import query, tidy

# --- profiles -------------------------------------------------------------------------


@query(
    f"SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {s.r('avg(o_totalprice)', 4)} AS mean_o_totalprice FROM orders GROUP BY 1"
)
def annual_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(profiles.yearly(tb.load(spark, sf_dir, "orders"), "o_orderdate", ["o_totalprice"]), 4)


@query(
    f"SELECT {s.SEASON_NUMBER.format('o_orderdate')} AS season_num, {s.r('avg(o_totalprice)', 4)} AS mean_o_totalprice, "
    f"{s.r('stddev_samp(o_totalprice)', 4)} AS std_o_totalprice, {s.r('stddev_samp(o_totalprice) / 100', 4)} AS bar_o_totalprice "
    "FROM orders GROUP BY 1"
)
def seasonal_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(profiles.seasonal(tb.load(spark, sf_dir, "orders"), "o_orderdate", ["o_totalprice"]), 4)


_NET = "l_extendedprice * (1 - l_discount)"
_WEEKLY = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "net": _NET, "l_tax": "l_tax"}


@query(
    "SELECT CAST(isodow(l_shipdate) - 1 AS INTEGER) AS weekday, "
    + ", ".join(f"{s.r(f'avg({e})', 4)} AS mean_{n}" for n, e in _WEEKLY.items()) + " FROM lineitem GROUP BY 1"
)
def weekly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(profiles.weekly(tb.lines(spark, sf_dir), "l_shipdate", list(_WEEKLY)), 4)


@query(f"SELECT CAST(hour(ts) AS INTEGER) AS hour, {s.r('avg(value)')} AS mean_value FROM events GROUP BY 1")
def hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(profiles.hourly(tb.load(spark, sf_dir, "events"), "ts", ["value"]))


_SPREAD = "(SELECT value, ts + to_months(CAST(user_id % 12 AS INTEGER)) AS moved FROM events)"


@query(
    f"SELECT * FROM (SELECT {s.SEASON.format('moved')} AS season, CAST(hour(moved) AS INTEGER) AS hour, {s.r('avg(value)')} AS mean_value "
    f"FROM {_SPREAD} GROUP BY 1, 2) WHERE season IN ('Winter', 'Summer')"
)
def season_hour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = F.make_ym_interval(F.lit(0), (F.col("user_id") % 12).cast("int"))
    events = tb.load(spark, sf_dir, "events").withColumn("moved", F.col("ts") + months)
    return tidy(profiles.hourly_by_season(events, "moved", "value"))


# Accented names for the event types, to be found by their plain spelling.
_NAMES = {
    "view": "Île-de-France", "click": "Auvergne-Rhône-Alpes", "error": "BRETAGNE", "signup": "Normandie",
    "purchase": "Occitanie",
}
_NAME_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _NAMES.items()) + " END"


@query(
    f"SELECT lower(strip_accents({_NAME_SQL})) AS key, CAST(hour(ts) AS INTEGER) AS hour, {s.r('avg(value)')} AS mean_value "
    "FROM events WHERE event_type IN ('view', 'click', 'error') GROUP BY 1, 2"
)
def named_hour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.create_map(*[F.lit(x) for pair in _NAMES.items() for x in pair])[F.col("event_type")]
    events = tb.load(spark, sf_dir, "events").withColumn("name", name)
    return tidy(profiles.hourly_for(events, "name", "ts", "value", explore.TYPICAL))


@query(
    f"SELECT n_name, {s.r('avg(c_acctbal)')} AS mean_c_acctbal, {s.r('stddev_samp(c_acctbal)')} AS std_c_acctbal, "
    "CASE WHEN avg(c_acctbal) > 0 THEN 'positive' WHEN avg(c_acctbal) < 0 THEN 'negative' ELSE 'zero' END AS direction, "
    f"{s.r('stddev_samp(c_acctbal) / 10')} AS bar FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"
)
def entity_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation by nation; customers are averaged by key before names are joined."""
    customers = tb.load(spark, sf_dir, "customer")
    nations = tb.load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    by_key = profiles.balance(customers, "c_nationkey", "c_acctbal")
    return tidy(by_key.join(nations, by_key.c_nationkey == nations.n_nationkey).drop("c_nationkey", "n_nationkey"))


_TOP = "SELECT l_suppkey, avg(l_quantity) AS mean FROM lineitem GROUP BY 1 ORDER BY mean DESC, l_suppkey LIMIT {}"


@query(f"SELECT l_suppkey, {s.r('mean')} AS mean FROM ({_TOP.format(5)})")
def topk_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(profiles.top_entities(tb.load(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity", 5))


@query(
    "SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM lineitem "
    f"WHERE l_suppkey IN (SELECT l_suppkey FROM ({_TOP.format(8)}))"
)
def topk_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tb.load(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    return profiles.rows_of_top(lines, "l_suppkey", "l_quantity", 8)


_MIX = list(explore.MIX)


@query(
    f"WITH {s.clean()}, m AS (SELECT \"Region\", avg(\"Consommation_MW\") AS rank_, {', '.join(f'avg({c}) AS {c}' for c in _MIX)} "
    "FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3) SELECT \"Region\", "
    + ", ".join(f"{s.r(f'{c} / {s.total(_MIX)} * 100')} AS {s.q(c)}" for c in _MIX) + " FROM m"
)
def topk_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(profiles.mix_of_top(tb.clean_panel(spark, sf_dir), "Region", "Consommation_MW", _MIX, 3))


_ALL_SOURCES = [*_MIX, "Bioenergies_MW"]


@query(
    f"WITH {s.clean()}, m AS (" + " UNION ALL ".join(f"SELECT '{c}' AS source, avg({c}) AS mean FROM clean" for c in _ALL_SOURCES)
    + f") SELECT source, {s.r('mean')} AS mean, {s.r('mean / sum(mean) OVER () * 100')} AS share FROM m"
)
def overall_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(profiles.overall_mix(tb.clean_panel(spark, sf_dir), _ALL_SOURCES))


_EXTENT = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS measure, {s.r(f'avg({c})')} AS mean, {s.r(f'min({c})')} AS min, {s.r(f'max({c})')} AS max FROM lineitem"
        for c in _EXTENT
    )
)
def global_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(profiles.extent(tb.load(spark, sf_dir, "lineitem"), _EXTENT))


@query("SELECT DISTINCT source FROM documents")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.distinct_values(tb.load(spark, sf_dir, "documents"), "source")


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_orderpriority LIMIT 1")
def modal_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.most_frequent(tb.load(spark, sf_dir, "orders"), "o_orderpriority")


@query(
    "SELECT event_type, ts, value FROM events WHERE event_type = (SELECT event_type FROM events GROUP BY 1 "
    "ORDER BY count(*) DESC, 1 LIMIT 1) ORDER BY ts, event_id LIMIT 168"
)
def first_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.load(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")
    return profiles.first_rows_of_mode(events, "event_type", "ts", 168, ["event_id"]).drop("event_id")


# --- distributions --------------------------------------------------------------------


def _box_sql(table: str, group: str, value: str) -> str:
    return f"""WITH q AS (SELECT {group} AS g, count(*) AS n, avg({value}) AS mean,
  quantile_cont({value}, 0.25::DOUBLE) AS q1, quantile_cont({value}, 0.5::DOUBLE) AS median,
  quantile_cont({value}, 0.75::DOUBLE) AS q3 FROM {table} GROUP BY 1)
SELECT g AS {group}, n, {s.rounded(['mean', 'q1', 'median', 'q3'], 4)},
  {s.r(f'min({value}) FILTER (WHERE inside)', 4)} AS whisker_low, {s.r(f'max({value}) FILTER (WHERE inside)', 4)} AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS outliers
FROM (SELECT q.*, {value}, {value} BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) AS inside
      FROM {table} JOIN q ON {group} = g) GROUP BY g, n, mean, q1, median, q3"""


@query(_box_sql("events", "event_type", "value"))
def box_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(profiles.box_summary(tb.load(spark, sf_dir, "events"), "event_type", "value"), 4)


@query(_box_sql("lineitem", "l_returnflag", "l_extendedprice"))
def box_summary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three groups hold the whole table."""
    return tidy(profiles.box_summary(tb.load(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice"), 4)


@query(
    "WITH q AS (SELECT lang AS g, quantile_cont(n_chars, 0.25::DOUBLE) AS q1, quantile_cont(n_chars, 0.75::DOUBLE) AS q3 FROM documents WHERE lang IS NOT NULL GROUP BY 1) "
    "SELECT lang, n_chars, count(*) AS n FROM documents JOIN q ON lang = g "
    "WHERE n_chars NOT BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) GROUP BY 1, 2"
)
def box_fliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of documents beyond the whiskers of their language."""
    return profiles.box_fliers(tb.load(spark, sf_dir, "documents").select("lang", "n_chars"), "lang", "n_chars")


@query(
    f"""WITH top AS (SELECT event_type FROM events GROUP BY 1 ORDER BY avg(value) DESC, 1 LIMIT 3),
x AS (SELECT event_type, value FROM events WHERE event_type IN (FROM top)),
m AS (SELECT event_type, count(*) AS n, avg(value) AS mean, quantile_cont(value, 0.5::DOUBLE) AS median, min(value) AS lo,
  max(value) AS hi, stddev_samp(value) * pow(count(*), -0.2::DOUBLE) AS h FROM x GROUP BY 1),
g AS (SELECT m.*, CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / 99 AS gx FROM m, range(100) r(i))
SELECT event_type, n, {s.rounded(['mean', 'median', 'lo', 'hi'])}, point, {s.r('gx')} AS x,
  {s.r('sum(exp(-0.5::DOUBLE * pow((gx - value) / h, 2))) / (n * h * sqrt(2 * pi()))', 9)} AS density
FROM g JOIN x USING (event_type) GROUP BY event_type, n, mean, median, lo, hi, point, gx, h"""
)
def violin_kde(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profiles.violin_summary(tb.load(spark, sf_dir, "events"), "event_type", "value", k=3)
    return tidy(found, density=9)


@query(
    f"""WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n FROM lineitem),
p AS (SELECT least(floor((l_extendedprice - lo) / ((hi - lo) / 50)), 49) AS b FROM lineitem, e),
c AS (SELECT b, count(*) AS c FROM p GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, {s.r('lo + i * ((hi - lo) / 50)', 4)} AS "left", {s.r('lo + (i + 1) * ((hi - lo) / 50)', 4)} AS "right",
  coalesce(c, 0) AS count, {s.r('coalesce(c, 0) / (n * ((hi - lo) / 50))', 9)} AS density
FROM range(50) r(i) CROSS JOIN e LEFT JOIN c ON b = i"""
)
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profiles.histogram(tb.load(spark, sf_dir, "lineitem"), "l_extendedprice", 50)
    return tidy(found, 4, density=9)


_DRAW = "md5('42|' || CAST(event_id AS VARCHAR))"


@query(f"SELECT event_id, value FROM events ORDER BY {_DRAW}, event_id LIMIT 1000")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.hash_sample(tb.load(spark, sf_dir, "events").select("event_id", "value"), ["event_id"], 1000)


@query(
    "SELECT event_type, event_id, value FROM events "
    f"QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY {_DRAW}, event_id) <= 300"
)
def hash_sample_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.load(spark, sf_dir, "events").select("event_type", "event_id", "value")
    return ordering.hash_sample_by(events, ["event_type"], ["event_id"], 300)


# --- stored sketches ------------------------------------------------------------------


@query(
    """WITH e AS (SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users,
  quantile_disc(value, 0.5) AS x FROM events GROUP BY 1)
SELECT event_type, n, users, true AS users_in_bound, true AS median_in_bound FROM e"""
)
def stored_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches per event type and month, stored, then merged upward: are distinct users and the
    median within the sketches' error bounds of the exact values?"""
    events = tb.load(spark, sf_dir, "events").select("event_type", "ts", "user_id", "value")
    stored = write_table(sketches.monthly(events, ["event_type"], "ts", "user_id", "value"), "sketches")
    merged = sketches.merged(stored, ["event_type"], {"median": 0.5})
    ladder = value_ladder(events, ["event_type"], "value")
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    # The share of rows at or below the sketch's median, from the exact ladder.
    place = ladder.join(merged.select("event_type", "median"), "event_type").where(F.col("value") <= F.col("median"))
    share = place.groupBy("event_type").agg((F.sum("n_at") / F.max("total")).alias("share"))
    both = merged.join(exact, "event_type").join(share, "event_type")
    return both.select(
        "event_type", "n", "users",
        (F.abs(F.col("distinct") - F.col("users")) <= sketches.DISTINCT_ERROR * F.col("users")).alias("users_in_bound"),
        (F.abs(F.col("share") - 0.5) <= sketches.RANK_ERROR).alias("median_in_bound"),
    )


# --- correlation ----------------------------------------------------------------------

_LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net", "charge", "l_partkey", "l_suppkey"]
_LINES = f"lines AS (SELECT *, {_NET} AS net, {_NET} * (1 + l_tax) AS charge FROM lineitem)"


def _corr_sql(columns: list[str], table: str, keep: str = "true") -> str:
    """One pass over the table: all pairs in a struct list, then unnested."""
    cells = ", ".join(
        f"{{'var1': '{a}', 'var2': '{b}', 'n': count(*) FILTER (WHERE {s.q(a)} IS NOT NULL AND {s.q(b)} IS NOT NULL), "
        f"'corr': corr({s.q(a)}, {s.q(b)}), 'lower': {str(i > j).lower()}}}"
        for i, a in enumerate(columns) for j, b in enumerate(columns)
        if keep == "true" or i > j
    )
    return (
        f"SELECT p.var1 AS var1, p.var2 AS var2, p.n AS n, CASE WHEN isnan(p.corr) THEN NULL ELSE p.corr END AS corr "
        f"FROM (SELECT unnest([{cells}]) AS p FROM {table})"
    )


@query(f"WITH {_LINES} SELECT var1, var2, n, {s.r('corr')} AS corr FROM ({_corr_sql(_LINE_COLUMNS, 'lines')})")
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(correlation.correlation_matrix(tb.lines(spark, sf_dir), _LINE_COLUMNS))


@query(
    f"WITH {_LINES}, p AS ({_corr_sql(_LINE_COLUMNS, 'lines', 'lower')}) "
    f"SELECT var1, var2, n, {s.r('corr')} AS corr FROM p ORDER BY abs(p.corr) DESC, var1, var2 LIMIT 15"
)
def top_corr_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = correlation.correlation_matrix(tb.lines(spark, sf_dir), _LINE_COLUMNS)
    return tidy(correlation.strongest_pairs(correlation.lower_triangle(matrix, _LINE_COLUMNS), top=15))


PANEL_NUMERIC = [c for c in (*s.MEASURES, *s.RATES, "Quarter", *s.CLEAN_DERIVED) if c not in CALENDAR_EXCLUDED]


@query(
    f"WITH {s.clean()}, p AS ({_corr_sql(PANEL_NUMERIC, 'clean', 'lower')}) "
    f"SELECT least(var1, var2) AS a, greatest(var1, var2) AS b, n, {s.r('corr')} AS corr FROM p WHERE abs(p.corr) > 0.5"
)
def strong_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of the cleaned panel with |r| > 0.5, over all its numeric columns."""
    panel = tb.stored_clean_panel(spark, sf_dir)
    names = correlation.numeric_columns(panel)
    matrix = correlation.correlation_matrix(panel, names)
    found = correlation.strongest_pairs(correlation.lower_triangle(matrix, names), above=0.5)
    return tidy(found.select(F.least("var1", "var2").alias("a"), F.greatest("var1", "var2").alias("b"), "n", "corr"))


_CATS = CORRELATION_CATEGORIES


def _category_sql() -> str:
    cells = []
    for a, xs in _CATS.items():
        for b, ys in _CATS.items():
            if a == b:
                value = "1.0::DOUBLE"
            else:
                terms = [f"abs(corr({s.q(x)}, {s.q(y)}))" for x in xs for y in ys]
                value = f"({' + '.join(terms)}) / {len(terms)}"
            cells.append(f"{{'cat1': '{a}', 'cat2': '{b}', 'm': {value}}}")
    return f"SELECT p.cat1 AS cat1, p.cat2 AS cat2, {s.r('p.m')} AS mean_abs_corr FROM (SELECT unnest([{', '.join(cells)}]) AS p FROM clean)"


@query(f"WITH {s.clean()} {_category_sql()}")
def category_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [c for vs in _CATS.values() for c in vs]
    matrix = correlation.correlation_matrix(tb.stored_clean_panel(spark, sf_dir), names)
    return tidy(correlation.category_matrix(matrix, _CATS))


# Student quantile at 97.5 % by its expansion in 1 / dof (exact to 1e-12 at these sizes).
_Z = "1.959963984540054::DOUBLE"
_T_CRITICAL = (
    f"({_Z} + (pow({_Z}, 3) + {_Z}) / (4 * v) + (5 * pow({_Z}, 5) + 16 * pow({_Z}, 3) + 3 * {_Z}) / (96 * v * v))"
)


@query(
    f"WITH {_LINES}, p AS ({_corr_sql(_LINE_COLUMNS, 'lines')}), t AS (SELECT {_T_CRITICAL} AS t, v FROM (SELECT count(*) - 2.0::DOUBLE AS v FROM lines)), "
    "c AS (SELECT t / sqrt(v + t * t) AS rc FROM t) "
    f"SELECT var1, var2, n, {s.r('corr')} AS corr, {s.r('rc')} AS r_critical, "
    f"{s.r('CASE WHEN abs(p.corr) < rc THEN 0 ELSE p.corr END')} AS corr_significant FROM p, c"
)
def r_critical_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tb.lines(spark, sf_dir)
    return tidy(correlation.mask_insignificant(correlation.correlation_matrix(lines, _LINE_COLUMNS), lines))


def _rolling_sql(part: str, order: str, window: int) -> str:
    w = f"OVER ({part} ORDER BY {order} ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
    return (
        f"SELECT event_id, {s.r('CASE WHEN n = ' + str(window) + ' AND NOT isnan(c) THEN c END')} AS corr_value__hour FROM "
        f"(SELECT event_id, corr(value, hour(ts)) {w} AS c, count(*) {w} AS n FROM events)"
    )


def _events_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.load(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    return events.withColumn("hour", F.hour("ts"))


@query(_rolling_sql("PARTITION BY event_type", "ts, event_id", 720))
def rolling_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = correlation.rolling_correlation(_events_hour(spark, sf_dir), tb.EVENTS, [("value", "hour")])
    return tidy(found.select("event_id", "corr_value__hour"))


@query(_rolling_sql("", "event_type, ts, event_id", 720))
def rolling_corr_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames over the whole (entity, time) order, crossing entities as the original does."""
    found = correlation.rolling_correlation(
        _events_hour(spark, sf_dir), tb.EVENTS, [("value", "hour")], across_entities=True
    )
    return tidy(found.select("event_id", "corr_value__hour"))


@query(
    f"WITH {s.clean()}, p AS ({_corr_sql(PANEL_NUMERIC, 'clean', 'lower')}) SELECT CAST(9 AS INTEGER) AS n_variables, "
    "min(\"Datetime\") AS first_ts, max(\"Datetime\") AS last_ts, count(DISTINCT \"Region\") AS n_entities, "
    "(SELECT count(*) FROM p WHERE abs(p.corr) > 0.5) AS n_strong_pairs FROM clean"
)
def exploration_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.exploration_report(tb.stored_clean_panel(spark, sf_dir), ENERGY)


@query(
    f"SELECT event_type, n, {s.r('n * 100.0 / sum(n) OVER ()')} AS percent FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)"
)
def category_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tb.load(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return tidy(profiles.percent_of_total(counts, "n"))


