"""Stage A queries: reading, casting, rolling up, filling, deriving, features, quality."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.functions import columns as fx
from tidepanel.operators import cleaning, features, ordering, quality
from tidepanel.plans import clean as stage
from tidepanel.plans import forecast
from tidepanel.session import new_path, write_table
from tidepanel.sources import readers, writers
from tidepanel.spec import ENERGY, LAGS, NULL_CATEGORIES, ROLLING_WINDOWS
from tidepanel.streaming import rollup
from tidepanel.workload import sql as s
from tidepanel.workload import tables as tb
from tidepanel.workload.registry import query, tidy

HOURLY = ENERGY.at(hourly=True)
SOURCES = list(ENERGY.sources)


def _folder(spark: SparkSession, name: str) -> str:
    return new_path(spark, name)


# --- sources and sinks ----------------------------------------------------------------


@query(f"WITH {s.raw()} SELECT {', '.join(map(s.q, s.RAW_COLUMNS))} FROM raw")
def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table written as semicolon text and scanned back as text."""
    raw = tb.raw_panel(spark, sf_dir)
    path = _folder(spark, "raw")
    writers.write_csv(raw, path, sep=";")
    return readers.read_raw(spark, path, raw.columns)


_PANEL_COLUMNS = (
    f"\"Region\", \"Datetime\", {s.rounded(['Consommation_MW', 'Part_renouvelable', 'Balance_MW'])}, \"Season\""
)


def _panel_columns(panel: DataFrame) -> DataFrame:
    return tidy(panel.select("Region", "Datetime", "Consommation_MW", "Part_renouvelable", "Balance_MW", "Season"))


@query(f"WITH {s.clean('user_id')} SELECT {_PANEL_COLUMNS} FROM clean")
def panel_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned panel of users (numbers as text) written as Parquet and read back with few columns."""
    path = _folder(spark, "clean")
    writers.write_panel(tb.clean_panel(spark, sf_dir, "user_id"), path)
    return _panel_columns(readers.read_panel(spark, path))


@query(f"WITH {s.clean()} SELECT {_PANEL_COLUMNS} FROM clean")
def panel_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned panel written as CSV and read back with its schema."""
    path = _folder(spark, "clean-csv")
    panel = tb.clean_panel(spark, sf_dir)
    writers.write_panel(panel, path, fmt="csv")
    return _panel_columns(readers.read_panel(spark, path, "csv", panel.schema))


@query(
    f"WITH {s.hourly('user_id')} SELECT \"Region\", \"Datetime\", {s.rounded(['Consommation_MW'])} "
    "FROM hourly ORDER BY \"Region\", \"Datetime\" LIMIT 1000"
)
def panel_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.hourly_rollup(tb.typed_panel(spark, sf_dir, "user_id"), ENERGY)
    return tidy(writers.panel_head(rows.select("Region", "Datetime", "Consommation_MW")))


# --- casting and renaming -------------------------------------------------------------

_RENAMED = [(k, ENERGY.renames.get(k, k)) for k in s.RAW_COLUMNS if k not in ENERGY.unwanted]


@query(f"WITH {s.raw('user_id')} SELECT {', '.join(f'{s.q(a)} AS {s.q(b)}' for a, b in _RENAMED)} FROM raw")
def rename_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.rename_and_drop(tb.raw_panel(spark, sf_dir, "user_id"), ENERGY)


_MESSY = """CASE WHEN event_id % 11 = 0 THEN 'ND' WHEN event_id % 13 = 0 THEN '-' WHEN event_id % 17 = 0 THEN 'nan'
  WHEN event_id % 19 = 0 THEN '12d' WHEN event_id % 23 = 0 THEN NULL
  ELSE ' ' || replace(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '.', CASE WHEN event_id % 2 = 0 THEN ',' ELSE '.' END) END"""


def _messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.load(spark, sf_dir, "events")
    number = F.col("value").cast("decimal(18,2)").cast("string")
    e = F.col("event_id")
    text = (
        F.when(e % 11 == 0, "ND").when(e % 13 == 0, "-").when(e % 17 == 0, "nan").when(e % 19 == 0, "12d")
        .when(e % 23 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), F.when(e % 2 == 0, F.replace(number, F.lit("."), F.lit(","))).otherwise(number)))
    )
    return events.select("event_id", text.alias("text"))


@query(f"SELECT event_id, {s.locale_number('text')} AS number FROM (SELECT event_id, {_MESSY} AS text FROM events)")
def locale_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messy(spark, sf_dir).select("event_id", fx.locale_number("text").alias("number"))


_AUDITED = ["Consommation (MW)", "Thermique (MW)", "Nucléaire (MW)", "Eolien (MW)", "Solaire (MW)"]


@query(
    f"WITH {s.raw('user_id')} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {s.q(c)} IS NOT NULL AND ({s.point_number(s.q(c))}) IS NULL) "
        f"AS lost_plain, count(*) FILTER (WHERE {s.q(c)} IS NOT NULL AND ({s.locale_number(s.q(c))}) IS NULL) AS lost_locale "
        "FROM raw" for c in _AUDITED
    )
)
def cast_loss_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cast_losses(tb.raw_panel(spark, sf_dir, "user_id"), _AUDITED)


@query(f"WITH {s.typed('user_id')} SELECT \"Region\", \"Datetime\" FROM typed")
def timestamp_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = cleaning.rename_and_drop(tb.raw_panel(spark, sf_dir, "user_id"), ENERGY)
    return cleaning.assemble_timestamp(raw, ENERGY).select("Region", "Datetime")


@query(
    "SELECT o_orderkey, CAST(try_cast(day AS DATE) AS TIMESTAMP) AS parsed FROM (SELECT o_orderkey, CASE o_orderstatus "
    "WHEN 'P' THEN o_orderpriority WHEN 'O' THEN strftime(o_orderdate, '%Y-%d-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day "
    "FROM orders)"
)
def lenient_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text: pending orders have their priority there, open ones day and month swapped."""
    iso = F.col("o_orderdate").cast("date").cast("string")
    swapped = F.concat(F.substring(iso, 1, 4), F.substring(iso, 8, 3), F.substring(iso, 5, 3))
    status = F.col("o_orderstatus")
    day = F.when(status == "P", F.col("o_orderpriority")).when(status == "O", swapped).otherwise(iso)
    orders = tb.load(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"))
    return orders.select("o_orderkey", fx.lenient_date("day").cast("timestamp_ntz").alias("parsed"))


# --- resampling and filling -----------------------------------------------------------

_GAPS = """gaps AS (SELECT epoch_us("Datetime") - epoch_us(lag("Datetime") OVER (PARTITION BY "Region" ORDER BY "Datetime")) AS us
  FROM typed)"""


@query(
    f"WITH {s.typed()}, {_GAPS} SELECT us / 1000000 AS gap_seconds, count(*) AS n FROM gaps WHERE us IS NOT NULL "
    "GROUP BY us ORDER BY n DESC, us LIMIT 1"
)
def granularity_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.granularity(tb.typed_panel(spark, sf_dir), ENERGY)


@query(
    "WITH gaps AS (SELECT CAST(floor(epoch_us(ts) / 60000000) AS BIGINT) * 60 AS m, event_type, event_id FROM events), "
    "d AS (SELECT m - lag(m) OVER (PARTITION BY event_type ORDER BY m, event_id) AS g FROM gaps) "
    "SELECT CAST(g AS DOUBLE) AS gap_seconds, count(*) AS n FROM d WHERE g IS NOT NULL GROUP BY g ORDER BY n DESC, g LIMIT 1"
)
def granularity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modal gap at event grain (minutes), where a type may hold most of the table."""
    minutes = tb.load(spark, sf_dir, "events").withColumn("ts", fx.floor_to("ts", 1))
    return cleaning.granularity(minutes, tb.EVENTS)


_HOUR_COLUMNS = [*s.MEASURES, *s.RATES]


@query(f"WITH {s.hourly('user_id')} SELECT \"Region\", \"Datetime\", \"Nature\", {s.rounded(_HOUR_COLUMNS)} FROM hourly")
def hourly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(cleaning.hourly_rollup(tb.typed_panel(spark, sf_dir, "user_id"), ENERGY))


@query(
    f"WITH {s.typed('user_id')} SELECT \"Region\", \"Datetime\", "
    + ", ".join(f"{s.r(s.ruled_rate(c))} AS {c}" for c in s.RATES) + " FROM typed"
)
def rate_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = cleaning.zero_idle_rates(tb.typed_panel(spark, sf_dir, "user_id"), ENERGY)
    return tidy(ruled.select("Region", "Datetime", *s.RATES))


_PART, _ORDER = '"Region"', '"Datetime"'


@query(
    f"WITH {s.typed('user_id')}, {s.interpolation('typed', _PART, _ORDER, SOURCES)} SELECT \"Region\", \"Datetime\", "
    + ", ".join(f"{s.r(s.interpolated(c, _PART, _ORDER))} AS {c}" for c in SOURCES) + " FROM near"
)
def interpolate_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-hourly grain: an entity's window is bounded by the period."""
    panel = tb.typed_panel(spark, sf_dir, "user_id")
    return tidy(ordering.interpolate(panel, HOURLY, SOURCES).select("Region", "Datetime", *SOURCES))


@query(
    "WITH gappy AS (SELECT event_id, event_type, ts, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value FROM events), "
    f"{s.interpolation('gappy', 'event_type', 'ts, event_id', ['value'])} "
    f"SELECT event_id, {s.r(s.interpolated('value', 'event_type', 'ts'))} AS value FROM near"
)
def interpolate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event grain: chunks per entity, nearest values carried between chunks."""
    events = tb.gappy_events(spark, sf_dir).select("event_id", "event_type", "ts", "value")
    return tidy(ordering.interpolate(events, tb.EVENTS, ["value"]).select("event_id", "value"))


@query(
    f"WITH {s.typed('user_id')} SELECT \"Region\", \"Datetime\", "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _HOUR_COLUMNS) + " FROM typed"
)
def fill_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = cleaning.fill_zero(tb.typed_panel(spark, sf_dir, "user_id"), ENERGY)
    return tidy(filled.select("Region", "Datetime", *_HOUR_COLUMNS))


_CLEAN_TEXT = ["Region", "Datetime", "Nature", "Season", "Year", "Month", "Day", "Hour", "DayOfWeek", "IsWeekend", "Quarter"]


@query(
    f"WITH {s.clean()} SELECT {', '.join(map(s.q, _CLEAN_TEXT))}, {s.rounded([*_HOUR_COLUMNS, *s.CLEAN_DERIVED])} FROM clean"
)
def clean_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole of stage A. The source is half-hourly by construction, though too sparse at
    the smallest scale for its modal gap (query ``granularity_mode``) to show it."""
    return tidy(tb.clean_panel(spark, sf_dir))


@query(
    f"WITH {s.clean_hours()} SELECT {', '.join(map(s.q, _CLEAN_TEXT))}, {s.rounded([*_HOUR_COLUMNS, *s.CLEAN_DERIVED])} FROM clean"
)
def clean_hourly_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage A for an hourly source with missing hours: the grain is detected, nothing is rolled up, hours
    without a row are added and interpolated."""
    raw = write_table(tb.hourly_source(spark, sf_dir), "raw")
    return tidy(stage.clean(raw, regular=True).select(*_CLEAN_TEXT, *_HOUR_COLUMNS, *s.CLEAN_DERIVED))


@query(f"WITH {s.hourly()} SELECT \"Region\", \"Datetime\", {s.rounded(s.MEASURES)}, {s.rounded(s.RATES)}, \"Nature\" FROM hourly")
def streaming_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly rollup of a panel that arrives in three parts: a stream over its files, drained after
    each part, and closed at the end."""
    panel = write_table(tb.typed_panel(spark, sf_dir), "typed")
    source, sink, state = (new_path(spark, n) for n in ("arriving", "hours", "state"))
    first, last = panel.agg(F.min("Datetime"), F.max("Datetime")).first()
    cuts = [first, *(first + (last - first) * k / 3 for k in (1, 2)), last + timedelta(seconds=1)]
    for a, b in zip(cuts, cuts[1:]):
        at = F.col("Datetime")
        panel.where((at >= F.lit(a).cast("timestamp_ntz")) & (at < F.lit(b).cast("timestamp_ntz"))).write.mode("append").parquet(source)
        rollup.drain(spark, panel.schema, source, sink, state, ENERGY, "1 hour")
    rollup.close(spark, panel.schema, source, ENERGY, str(last + timedelta(days=2)))
    rollup.drain(spark, panel.schema, source, sink, state, ENERGY, "1 hour")
    hours = spark.read.parquet(sink)
    return tidy(hours.select("Region", "Datetime", *s.MEASURES, *s.RATES, "Nature"))


# --- derived columns ------------------------------------------------------------------


@query(
    "SELECT o_orderkey, " + ", ".join(f"{e} AS {s.q(n)}" for n, e in s.calendar("o_orderdate").items())
    + f", {s.SEASON_NUMBER.format('o_orderdate')} AS season_num FROM orders"
)
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar columns, season and its ordinal."""
    orders = tb.load(spark, sf_dir, "orders")
    parts = orders.select("o_orderkey", *[c.alias(n) for n, c in fx.calendar("o_orderdate").items()])
    return parts.withColumn("season_num", fx.season_number("Season"))


_TOTALS = f"{s.total(ENERGY.sources)} AS total, {s.total(ENERGY.renewables)} AS renewable"


@query(
    f"WITH {s.typed('user_id')} SELECT \"Region\", \"Datetime\", {s.r('total')} AS total, {s.r('renewable')} AS renewable, "
    f"{s.r('CASE WHEN total > 0 THEN renewable / total * 100 ELSE 0 END')} AS share, "
    f"{s.r('total - \"Consommation_MW\"')} AS balance FROM (SELECT *, {_TOTALS} FROM typed)"
)
def row_sums_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.typed_panel(spark, sf_dir, "user_id").withColumns(
        {"total": fx.sum_present(ENERGY.sources), "renewable": fx.sum_present(ENERGY.renewables)}
    )
    return tidy(rows.select(
        "Region", "Datetime", "total", "renewable", fx.share("renewable", "total").alias("share"),
        (F.col("total") - F.col("Consommation_MW")).alias("balance"),
    ))


@query(
    "SELECT doc_id, md5(lower(strip_accents(text))) AS key_hash, length(strip_accents(text)) AS key_length FROM documents"
)
def accent_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accent- and case-free key of whole texts (hashed to keep the result small)."""
    keyed = tb.load(spark, sf_dir, "documents").withColumn("key", fx.accent_key("text"))
    return keyed.select("doc_id", F.md5("key").alias("key_hash"), F.length("key").cast("long").alias("key_length"))


@query(
    "SELECT doc_id, split_part(source || '_' || lang, '_', 1) AS head, "
    "replace(source || '_' || lang, '_', ' ') AS spaced, "
    "CASE WHEN length(text) > 30 THEN substring(text, 1, 30) || '...' ELSE text END AS label FROM documents"
)
def text_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat_ws("_", "source", "lang")
    return tb.load(spark, sf_dir, "documents").select(
        "doc_id", fx.first_token(name).alias("head"), fx.spaced(name).alias("spaced"),
        fx.shortened("text", 30).alias("label"),
    )


def _timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.load(spark, sf_dir, "events")
    return events.withColumns(fx.calendar("ts")).withColumnRenamed("ts", "Datetime")


_CYCLES = {"hour": ("hour(ts)", 24), "dow": ("(isodow(ts) - 1)", 7), "month": ("month(ts)", 12), "doy": ("dayofyear(ts)", 365)}


@query(
    "SELECT event_id, CAST(dayofyear(ts) AS INTEGER) AS day_of_year, " + ", ".join(
        f"{s.r(f'{fn}(2 * pi() * {x} / {p})')} AS {n}_{fn}" for n, (x, p) in _CYCLES.items() for fn in ("sin", "cos")
    ) + " FROM events"
)
def cyclic_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = features.with_cyclic(_timed_events(spark, sf_dir), ENERGY)
    names = [f"{n}_{fn}" for n in _CYCLES for fn in ("sin", "cos")]
    return tidy(wide.select("event_id", "day_of_year", *names))


_WAVE = "15 + 10 * sin(2 * pi() * dayofyear(ts) / 365 - pi() / 2) + 5 * sin(2 * pi() * hour(ts) / 24 - pi() / 3)"


@query(f"SELECT event_id, {s.r(_WAVE)} AS temperature FROM events")
def harmonic_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.load(spark, sf_dir, "events")
    wave = fx.harmonic_temperature(F.dayofyear("ts"), F.hour("ts"))
    return tidy(events.select("event_id", wave.alias("temperature")))


_UNIFORM = "((('0x' || substr(md5('42|' || event_id), {at}, 8))::UBIGINT)::DOUBLE + 0.5) / 4294967296.0::DOUBLE"


@query(
    f"WITH u AS (SELECT event_id, ts, {_UNIFORM.format(at=1)} AS a, {_UNIFORM.format(at=9)} AS b FROM events) "
    f"SELECT event_id, {s.r(_WAVE + ' + 3 * sqrt(-2 * ln(a)) * cos(2 * pi() * b)')} AS temperature FROM u"
)
def noisy_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same wave with normal noise that depends on the row's key alone."""
    events = tb.load(spark, sf_dir, "events")
    wave = fx.harmonic_temperature(F.dayofyear("ts"), F.hour("ts"), 42, ["event_id"])
    return tidy(events.select("event_id", wave.alias("temperature")))


_W = 'OVER (PARTITION BY "Region" ORDER BY "Datetime")'
_RATIO_SQL = """"Hour" * "IsWeekend" AS "Hour_IsWeekend",
  "Production_totale_MW" / nullif(lag("Consommation_MW") OVER (PARTITION BY "Region" ORDER BY "Datetime") + 1, 0) AS "Production_Conso_Ratio",
  "Production_renouvelable_MW" / nullif("Nucleaire_MW" + 1, 0) AS "Renew_Nuclear_Ratio" """


@query(
    f"WITH {s.clean()}, x AS (SELECT *, {_RATIO_SQL} FROM clean) SELECT \"Region\", \"Datetime\", \"Hour_IsWeekend\", "
    f"{s.rounded(['Production_Conso_Ratio', 'Renew_Nuclear_Ratio'])} FROM x"
)
def interaction_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    lagged = features.with_lags(tb.clean_panel(spark, sf_dir), HOURLY, lags=[1])
    wide = features.with_interactions(lagged, ENERGY)
    return tidy(wide.select("Region", "Datetime", "Hour_IsWeekend", "Production_Conso_Ratio", "Renew_Nuclear_Ratio"))


def _lag_sql(value: str, part: str, order: str, name: str) -> str:
    return ", ".join(
        f"{s.r(f'lag({value}, {k}) OVER (PARTITION BY {part} ORDER BY {order})')} AS {s.q(f'{name}_lag_{k}')}" for k in LAGS
    )


def _rolling_sql(value: str, part: str, order: str, name: str, round_: bool = True) -> str:
    out = []
    for k in ROLLING_WINDOWS:
        frame = f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
        for fn, label in (("avg", "mean"), ("stddev_samp", "std")):
            cell = f"{fn}({value}) {frame}"
            out.append(f"{s.r(cell) if round_ else cell} AS {s.q(f'{name}_rolling_{label}_{k}')}")
    return ", ".join(out)


@query(
    f"WITH {s.hourly('user_id')} SELECT \"Region\", \"Datetime\", "
    f"{_lag_sql('\"Consommation_MW\"', _PART, _ORDER, 'Consommation_MW')} FROM hourly"
)
def lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly grain, one window per entity; the entities grow with the table."""
    panel = cleaning.hourly_rollup(tb.typed_panel(spark, sf_dir, "user_id"), ENERGY)
    wide = features.with_lags(panel.select("Region", "Datetime", "Consommation_MW"), HOURLY)
    return tidy(wide.drop("Consommation_MW"))


@query(
    f"WITH {s.hourly('user_id')} SELECT \"Region\", \"Datetime\", "
    f"{_rolling_sql('\"Consommation_MW\"', _PART, _ORDER, 'Consommation_MW')} FROM hourly"
)
def rolling_mean_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = cleaning.hourly_rollup(tb.typed_panel(spark, sf_dir, "user_id"), ENERGY)
    wide = features.with_rolling(panel.select("Region", "Datetime", "Consommation_MW"), HOURLY)
    return tidy(wide.drop("Consommation_MW"))


@query(f"SELECT event_id, {_lag_sql('value', 'event_type', 'ts, event_id', 'value')} FROM events")
def lags_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event grain: five entities hold the whole table, so each is cut into chunks."""
    events = tb.load(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    wide = features.with_lags(events, tb.EVENTS)
    return tidy(wide.drop("event_type", "ts", "value"))


@query(f"SELECT event_id, {_rolling_sql('value', 'event_type', 'ts, event_id', 'value')} FROM events")
def rolling_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.load(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    wide = features.with_rolling(events, tb.EVENTS)
    return tidy(wide.drop("event_type", "ts", "value"))


@query(
    f"WITH {s.typed('user_id')} SELECT \"Region\", \"Datetime\", \"Consommation_MW\", \"Thermique_MW\", \"Nature\" FROM typed "
    "WHERE \"Consommation_MW\" IS NOT NULL AND \"Thermique_MW\" IS NOT NULL AND \"Nature\" IS NOT NULL"
)
def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = tb.typed_panel(spark, sf_dir, "user_id")
    return panel.select("Region", "Datetime", "Consommation_MW", "Thermique_MW", "Nature").na.drop("any")


_FEATURES = [
    "Consommation_MW", *[f"Consommation_MW_lag_{k}" for k in LAGS],
    *[f"Consommation_MW_rolling_{x}_{k}" for k in ROLLING_WINDOWS for x in ("mean", "std")],
    "Production_Conso_Ratio", "Renew_Nuclear_Ratio", "Temperature_simulated",
    *[f"{n}_{fn}" for n in _CYCLES for fn in ("sin", "cos")],
]
_RAW_LAGS = ", ".join(f"lag(\"Consommation_MW\", {k}) {_W} AS \"Consommation_MW_lag_{k}\"" for k in LAGS)
_CYCLE_SQL = ", ".join(
    f"{fn}(2 * pi() * {x.replace('ts', '\"Datetime\"')} / {p}) AS {n}_{fn}" for n, (x, p) in _CYCLES.items() for fn in ("sin", "cos")
)
FEATURES_SQL = f"""{s.clean()},
wide AS (SELECT *, {_RAW_LAGS}, {_rolling_sql('"Consommation_MW"', _PART, _ORDER, 'Consommation_MW', False)},
  {_RATIO_SQL}, {_CYCLE_SQL}, {_WAVE.replace('ts', '"Datetime"')} AS "Temperature_simulated" FROM clean),
features AS (SELECT * FROM wide WHERE COLUMNS(*) IS NOT NULL),
split AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY "Datetime", "Region") - 1 < floor(0.8 * (SELECT count(*) FROM features))
  THEN 'train' ELSE 'test' END AS split FROM features)"""


@query(f"WITH {FEATURES_SQL} SELECT \"Region\", \"Datetime\", split, \"Hour_IsWeekend\", {s.rounded(_FEATURES)} FROM split")
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All model inputs with the chronological split (without the random noise term)."""
    wide = forecast.prepared(tb.clean_panel(spark, sf_dir), noise_seed=None)
    return tidy(wide.select("Region", "Datetime", "split", "Hour_IsWeekend", *_FEATURES))


@query(
    "SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) - 1 < floor(0.8 * (SELECT count(*) FROM events)) "
    "THEN 'train' ELSE 'test' END AS split FROM events"
)
def chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.load(spark, sf_dir, "events").select("ts", "event_id")
    return ordering.chronological_split(events, ["ts", "event_id"]).select("event_id", "split")


@query("SELECT event_id, row_number() OVER (ORDER BY event_type, ts, event_id) - 1 AS row_index FROM events")
def row_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.load(spark, sf_dir, "events").select("event_type", "ts", "event_id")
    return ordering.with_row_index(events, ["event_type", "ts", "event_id"]).select("event_id", "row_index")


# --- quality --------------------------------------------------------------------------


def _count_nulls(columns: list[str], table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {s.q(c)} IS NULL) AS nulls, count(*) AS n FROM {table}" for c in columns
    )


@query(
    f"WITH {s.raw('user_id')}, c AS ({_count_nulls(s.RAW_COLUMNS, 'raw')}) "
    f"SELECT \"column\", nulls, {s.r('nulls * 100.0 / n')} AS percent FROM c WHERE nulls > 0"
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(quality.null_profile(tb.raw_panel(spark, sf_dir, "user_id")))


@query(
    f"WITH {s.raw('user_id')}, c AS ({_count_nulls(s.RAW_COLUMNS, 'raw')}) "
    f"SELECT \"column\", nulls, {s.r('nulls * 100.0 / n')} AS percent FROM c WHERE nulls > 0 "
    "ORDER BY nulls DESC, \"column\" LIMIT 10"
)
def null_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(quality.null_profile(tb.raw_panel(spark, sf_dir, "user_id"), top=10))


_SIZE = (
    "SELECT max(n) AS n_rows, CAST(count(*) AS INTEGER) AS n_columns, CAST(sum(n) AS BIGINT) AS cells, "
    "CAST(sum(nulls) AS BIGINT) AS null_cells, {} AS completeness FROM c"
).format(s.r("(sum(n) - sum(nulls)) * 100.0 / sum(n)"))


@query(f"WITH {s.raw('user_id')}, c AS ({_count_nulls(s.RAW_COLUMNS, 'raw')}) {_SIZE}")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(quality.completeness(tb.raw_panel(spark, sf_dir, "user_id")))


_CLEAN_COLUMNS = [*_CLEAN_TEXT, *_HOUR_COLUMNS, *s.CLEAN_DERIVED]


@query(
    f"WITH {s.clean()}, a AS ({_count_nulls(s.RAW_COLUMNS, 'raw')}), b AS ({_count_nulls(_CLEAN_COLUMNS, 'clean')}) "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS stage, max(n) AS n_rows, CAST(sum(n) - sum(nulls) AS BIGINT) AS filled_cells, "
        f"{s.r('(sum(n) - sum(nulls)) * 100.0 / sum(n)')} AS completeness FROM {t}" for name, t in (("before", "a"), ("after", "b"))
    )
)
def before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(quality.before_after(tb.raw_panel(spark, sf_dir), tb.clean_panel(spark, sf_dir)))


def _members(names: tuple[str, ...]) -> list[str]:
    return [c for c in s.RAW_COLUMNS if any(n[:-1] in c if n.endswith("*") else n == c for n in names)]


@query(
    f"WITH {s.raw('user_id')}, c AS ({_count_nulls(s.RAW_COLUMNS, 'raw')}), g AS (" + " UNION ALL ".join(
        f"SELECT '{cat}' AS category, CAST(sum(nulls) AS BIGINT) AS nulls FROM c WHERE \"column\" IN "
        f"({', '.join(repr(m) for m in _members(names))})" for cat, names in NULL_CATEGORIES.items()
    ) + f") SELECT category, nulls, {s.r('nulls * 100.0 / sum(nulls) OVER ()')} AS share FROM g"
)
def null_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(quality.null_categories(tb.raw_panel(spark, sf_dir, "user_id"), NULL_CATEGORIES))


@query(
    f"WITH {s.raw('user_id')} SELECT CAST(date_trunc('month', try_cast(\"Date\" AS DATE)) AS TIMESTAMP) AS month, "
    f"{s.r('sum(' + ' + '.join(f'CAST({s.q(c)} IS NULL AS INTEGER)' for c in s.RAW_COLUMNS) + f') * 100.0 / (count(*) * {len(s.RAW_COLUMNS) + 2})')} "
    "AS null_percent FROM raw WHERE try_cast(\"Date\" AS DATE) IS NOT NULL GROUP BY 1"
)
def null_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(quality.null_by_month(tb.raw_panel(spark, sf_dir, "user_id"), "Date"))


_MAPPED = [*s.MEASURES, *s.RATES]


@query(
    f"WITH {s.typed('user_id')} " + " UNION ALL ".join(
        f"SELECT \"Region\", \"Datetime\", '{c}' AS \"column\", CAST({c} IS NULL AS INTEGER) AS is_null FROM typed "
        f"WHERE (SELECT count(*) FROM typed WHERE {c} IS NULL) > 0" for c in _MAPPED
    )
)
def null_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = tb.typed_panel(spark, sf_dir, "user_id").select("Region", "Datetime", *_MAPPED)
    return quality.null_indicators(panel, ["Region", "Datetime"]).select("Region", "Datetime", "column", "is_null")


_PROFILED = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null, count(DISTINCT {c}) AS \"distinct\" FROM orders"
        for c, t in _PROFILED.items()
    )
)
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.column_profile(tb.load(spark, sf_dir, "orders").select(*_PROFILED))


_RULES = [("non_negative", c, f"{c} < 0") for c in ENERGY.nonnegative] + [
    ("filled", c, f"{c} IS NULL") for c in ("Region", "Datetime", "Nature", *_HOUR_COLUMNS)
]


@query(
    f"WITH {s.typed('user_id')}, v AS (" + " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{c}' AS \"column\", count(*) FILTER (WHERE {test}) AS violations FROM typed"
        for rule, c, test in _RULES
    ) + ") SELECT *, violations = 0 AS passed FROM v"
)
def validation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = tb.typed_panel(spark, sf_dir, "user_id").drop("Date", "Heure")
    return quality.validate(panel, ENERGY)


@query(
    f"WITH {s.clean()} SELECT count(*) AS n_rows, CAST({len(_CLEAN_COLUMNS)} AS INTEGER) AS n_columns, "
    "min(\"Datetime\") AS first_ts, max(\"Datetime\") AS last_ts, count(DISTINCT \"Region\") AS n_entities, "
    + ", ".join(f"{s.r(f'avg({c})')} AS \"mean_{c}\"" for c in ("Consommation_MW", "Production_totale_MW", "Part_renouvelable"))
    + " FROM clean"
)
def panel_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(quality.overview(tb.clean_panel(spark, sf_dir), ENERGY))
