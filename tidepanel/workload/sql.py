"""SQL text of the derived tables, for checking the queries on another engine."""

from __future__ import annotations

from collections.abc import Iterable

from tidepanel.functions import columns as fx
from tidepanel.spec import ENERGY, ENERGY_RENAMES
from tidepanel.workload.tables import SOURCES

RATES = [n for n in ENERGY_RENAMES.values() if "TCO" in n or "TCH" in n]
MEASURES = list(ENERGY.measures)
RAW_NUMBERS = [k for k, v in ENERGY_RENAMES.items() if v in MEASURES or v in RATES]

def slots(minutes: int = 30) -> str:
    return f"""slots AS (
  SELECT *, date_trunc('hour', ts) + to_minutes(CAST({minutes} * (minute(ts) // {minutes}) AS BIGINT)) AS slot,
         CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k
  FROM events)"""


PATTERN = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def q(name: str) -> str:
    return f'"{name}"'


def r(expr: str, digits: int = 6) -> str:
    """As ``registry.tidy`` rounds: exact halves nudged up, no negative zero."""
    return f"round(({expr}) + 37e-{digits + 3}, {digits}) + 0"


def rounded(names: Iterable[str], digits: int = 6) -> str:
    return ", ".join(f"{r(q(n), digits)} AS {q(n)}" for n in names)


def point_number(expr: str) -> str:
    text = f"trim({expr})"
    return f"CASE WHEN regexp_full_match({text}, '{PATTERN}') THEN CAST({text} AS DOUBLE) END"


def locale_number(expr: str) -> str:
    return point_number(f"replace({expr}, ',', '.')")


def _text(expr: str, digits: int = 2) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,{digits})) AS VARCHAR)"


def _at(modulus: int, rest: int, sign: str = "") -> str:
    return _text(f"sum({sign}value) FILTER (WHERE event_id % {modulus} = {rest})")


def raw(entity: str = "event_type", minutes: int = 30) -> str:
    cells = {
        "Nature": "arg_min('N' || (user_id % 3), event_id) FILTER (WHERE event_id % 5 <> 0)",
        "Consommation (MW)": "CASE WHEN min(event_id) % 11 = 0 THEN 'ND' ELSE "
        f"replace({_text('sum(value)')}, '.', ',') END",
    }
    cells |= {f"{s} (MW)": _at(6, n) for s, n in SOURCES.items()}
    cells |= {
        "Pompage (MW)": _at(10, 0, "-"),
        "Ech. physiques (MW)": _text("sum(value - 50)"),
        "Stockage batterie": _at(50, 0),
        "Déstockage batterie": _at(50, 1),
        "Eolien terrestre": _at(12, 2),
        "Eolien offshore": _at(12, 8),
    }
    for s, n in SOURCES.items():
        cells[f"TCO {s} (%)"] = _text(f"sum(k) FILTER (WHERE event_id % 6 = {n})", 1)
        cells[f"TCH {s} (%)"] = _text(f"max(k) FILTER (WHERE event_id % 6 = {n} AND k < 50)", 1)
    body = ",\n".join(f"{c} AS {q(n)}" for n, c in cells.items())
    return f"""{slots(minutes)},
raw AS (
  SELECT CAST(length(CAST({entity} AS VARCHAR)) AS VARCHAR) AS "Code INSEE région",
         CAST({entity} AS VARCHAR) AS "Région",
         strftime(slot, '%Y-%m-%d') AS "Date", strftime(slot, '%H:%M') AS "Heure",
         {body}, CAST(NULL AS VARCHAR) AS "Column 30"
  FROM slots GROUP BY {entity}, slot)"""


RAW_COLUMNS = [
    "Code INSEE région", "Région", "Nature", "Date", "Heure",
    *[k for k in ENERGY_RENAMES if k not in ("Région", "Date - Heure")], "Column 30",
]


def typed(entity: str = "event_type", minutes: int = 30, where: str = "true") -> str:
    numbers = ",\n".join(f"{locale_number(q(k))} AS {q(ENERGY_RENAMES[k])}" for k in RAW_NUMBERS)
    return f"""{raw(entity, minutes)},
typed AS (
  SELECT "Région" AS "Region", "Nature", {numbers},
         strptime("Date" || ' ' || "Heure", '%Y-%m-%d %H:%M') AS "Datetime"
  FROM raw WHERE {where})"""


def hourly(entity: str = "event_type") -> str:
    cells = [f"coalesce(sum({m}), 0) / 2 AS {m}" for m in MEASURES] + [f"avg({c}) AS {c}" for c in RATES]
    return f"""{typed(entity)},
hourly AS (
  SELECT "Region", date_trunc('hour', "Datetime") AS "Datetime", {", ".join(cells)},
         arg_min("Nature", "Datetime") FILTER (WHERE "Nature" IS NOT NULL) AS "Nature"
  FROM typed GROUP BY "Region", date_trunc('hour', "Datetime"))"""


def ruled_rate(rate: str) -> str:
    source = f"{rate.split('_')[1]}_MW"
    return f"CASE WHEN {source} IS NULL OR {source} = 0 THEN 0 ELSE {rate} END"


def interpolated(column: str, part: str, order: str) -> str:
    """Linear by position, from columns pos_/val_ built by the caller's window."""
    return f"""CASE WHEN {column} IS NOT NULL THEN {column}
      WHEN pv_{column} IS NULL THEN nv_{column} WHEN nv_{column} IS NULL THEN pv_{column}
      ELSE pv_{column} + (nv_{column} - pv_{column}) * (CAST(idx - pi_{column} AS DOUBLE) / (ni_{column} - pi_{column})) END"""


def interpolation(source: str, part: str, order: str, columns: Iterable[str]) -> str:
    """CTEs ``numbered`` and ``near`` with the nearest filled rows on both sides."""
    columns = list(columns)
    near = []
    for c in columns:
        back = f"OVER (PARTITION BY {part} ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        ahead = f"OVER (PARTITION BY {part} ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        at = f"CASE WHEN {c} IS NOT NULL THEN idx END"
        near += [
            f"last_value({c} IGNORE NULLS) {back} AS pv_{c}", f"last_value({at} IGNORE NULLS) {back} AS pi_{c}",
            f"first_value({c} IGNORE NULLS) {ahead} AS nv_{c}", f"first_value({at} IGNORE NULLS) {ahead} AS ni_{c}",
        ]
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS idx FROM {source}),
near AS (SELECT *, {", ".join(near)} FROM numbered)"""


# Season of each month and its ordinal.
SEASON = """CASE WHEN month({0}) IN (12, 1, 2) THEN 'Winter' WHEN month({0}) IN (3, 4, 5) THEN 'Spring'
  WHEN month({0}) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END"""
SEASON_NUMBER = """CASE WHEN month({0}) IN (12, 1, 2) THEN 1 WHEN month({0}) IN (3, 4, 5) THEN 2
  WHEN month({0}) IN (6, 7, 8) THEN 3 ELSE 4 END"""


def calendar(ts: str) -> dict[str, str]:
    return {
        "Year": f"CAST(year({ts}) AS INTEGER)",
        "Month": f"CAST(month({ts}) AS INTEGER)",
        "Day": f"CAST(day({ts}) AS INTEGER)",
        "Hour": f"CAST(hour({ts}) AS INTEGER)",
        "DayOfWeek": f"CAST(isodow({ts}) - 1 AS INTEGER)",
        "IsWeekend": f"CAST(isodow({ts}) >= 6 AS INTEGER)",
        "Quarter": f"CAST(quarter({ts}) AS INTEGER)",
        "Season": SEASON.format(ts),
    }


def total(columns: Iterable[str]) -> str:
    return "(" + " + ".join(f"coalesce({c}, 0)" for c in columns) + ")"


def clean(entity: str = "event_type") -> str:
    """The cleaned panel (half-hourly source, so sums hold no null to interpolate)."""
    filled = [*MEASURES, *[f"coalesce({ruled_rate(c)}, 0) AS {c}" for c in RATES]]
    return f"""{hourly(entity)},
filled AS (SELECT "Region", "Datetime", {", ".join(filled)}, "Nature" FROM hourly),
{derived()}"""


def clean_hours() -> str:
    """The cleaned panel of the hourly source with gaps, on a grid of all hours."""
    part, order = '"Region"', '"Datetime"'
    filled = [f"coalesce({interpolated(c, part, order) if c in ENERGY.sources else c}, 0) AS {c}" for c in MEASURES]
    filled += [f"coalesce({ruled_rate(c)}, 0) AS {c}" for c in RATES]
    where = """(CAST(substr("Date", 9, 2) AS INTEGER) + CAST(substr("Heure", 1, 2) AS INTEGER)) % 11 <> 0"""
    return f"""{typed(minutes=60, where=where)},
ends AS (SELECT "Region", min("Datetime") AS a, max("Datetime") AS b FROM typed GROUP BY 1),
grid AS (SELECT "Region", unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS "Datetime" FROM ends),
regular AS (SELECT * FROM grid LEFT JOIN typed USING ("Region", "Datetime")),
{interpolation("regular", part, order, ENERGY.sources)},
filled AS (SELECT "Region", "Datetime", {", ".join(filled)}, "Nature" FROM near),
{derived()}"""


def derived() -> str:
    """The CTE ``clean`` from ``filled``."""
    parts = ", ".join(f"{e} AS {q(n)}" for n, e in calendar('"Datetime"').items())
    return f"""clean AS (
  SELECT *, CASE WHEN "Production_totale_MW" > 0
            THEN "Production_renouvelable_MW" / "Production_totale_MW" * 100 ELSE 0 END AS "Part_renouvelable",
         "Production_totale_MW" - "Consommation_MW" AS "Balance_MW"
  FROM (SELECT *, {parts}, {total(ENERGY.sources)} AS "Production_totale_MW",
               {total(ENERGY.renewables)} AS "Production_renouvelable_MW" FROM filled))"""


CLEAN_DERIVED = ["Production_totale_MW", "Production_renouvelable_MW", "Part_renouvelable", "Balance_MW"]


def normal_quantile(p: str) -> str:
    """The normal quantile by the library's fixed coefficients, written out."""

    def ratio(x: str, tables: tuple) -> str:
        sides = []
        for coefficients in tables:
            text = f"{coefficients[-1]!r}::DOUBLE"
            for c in reversed(coefficients[:-1]):
                text = f"(({text}) * {x} + {c!r}::DOUBLE)"
            sides.append(text)
        return f"({sides[0]}) / ({sides[1]})"

    tail = f"sqrt(-ln(least({p}, 1 - {p})))"
    near, far = ratio(f"({tail} - 1.6::DOUBLE)", fx.QUANTILE_TAIL), ratio(f"({tail} - 5)", fx.QUANTILE_FAR)
    middle = ratio(f"(0.180625::DOUBLE - ({p} - 0.5) * ({p} - 0.5))", fx.QUANTILE_MIDDLE)
    return (
        f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {middle} "
        f"ELSE sign({p} - 0.5) * CASE WHEN {tail} <= 5 THEN {near} ELSE {far} END END"
    )


# --- tail probabilities by Simpson's rule (an independent check of the library's) -------

_SIMPSON = "CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"


def _upper(density: str, end: str) -> str:
    """1 - integral of ``density`` (in u) from 0 to ``end``; null when ``end`` is null."""
    return (
        f"(SELECT greatest(0, 1 - sum({_SIMPSON} * ({density}) * top / 6000)) FROM "
        f"(SELECT i, top, i * top / 2000 AS u FROM (SELECT {end} AS top) x, range(2001) g(i)) y)"
    )


def t_two_sided(t: str, dof: str) -> str:
    density = (
        f"2 * exp(lgamma(({dof} + 1) / 2.0) - lgamma({dof} / 2.0)) / sqrt({dof} * pi()) "
        f"* pow(1 + u * u / {dof}, -({dof} + 1) / 2.0)"
    )
    return _upper(density, f"least(abs({t}), 40.0)")


def f_upper(f: str, d1: str, d2: str) -> str:
    density = (
        f"2 * exp(lgamma(({d1} + {d2}) / 2.0) - lgamma({d1} / 2.0) - lgamma({d2} / 2.0) "
        f"+ {d1} / 2.0 * ln(CAST({d1} AS DOUBLE) / {d2})) * pow(u, {d1} - 1) "
        f"* pow(1 + {d1} * u * u / {d2}, -({d1} + {d2}) / 2.0)"
    )
    return _upper(density, f"least(sqrt({f}), 40.0)")


def chi2_upper(x: str, dof: str) -> str:
    density = (
        f"exp((1 - {dof} / 2.0) * ln(2.0) - lgamma({dof} / 2.0) - u * u / 2) * pow(u, {dof} - 1)"
    )
    return _upper(density, f"least(sqrt({x}), 60.0)")


def normality(rows: str, keys: str) -> str:
    """Jarque-Bera and K² of column e of ``rows`` per ``keys``, as CTEs and the final select."""
    return f"""nr AS ({rows}),
nc AS (SELECT {keys}, e - avg(e) OVER (PARTITION BY {keys}) AS d FROM nr WHERE e IS NOT NULL),
nm AS (SELECT {keys}, count(*)::DOUBLE AS n, avg(d * d) AS m2, avg(pow(d, 3)) AS m3, avg(pow(d, 4)) AS m4 FROM nc GROUP BY {keys}),
nk AS (SELECT *, m3 / pow(m2, 1.5::DOUBLE) AS skewness, m4 / (m2 * m2) - 3 AS kurtosis,
  3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS b2,
  6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb FROM nm),
nw AS (SELECT *, n / 6 * (skewness * skewness + kurtosis * kurtosis / 4) AS jb, sqrt(2 * (b2 - 1)) - 1 AS w2,
  6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS a,
  (kurtosis - (3 * (n - 1) / (n + 1) - 3)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x FROM nk),
nz AS (SELECT *, asinh(skewness * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) / sqrt(2 / (w2 - 1))) / sqrt(0.5::DOUBLE * ln(w2)) AS zs,
  (1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))) AS base FROM nw),
nf AS (SELECT *, CASE WHEN n >= 20 THEN zs * zs + pow((1 - 2 / (9 * a) - cbrt(base)) / sqrt(2 / (9 * a)), 2) END AS k2 FROM nz)
SELECT {keys}, CAST(n AS BIGINT) AS n, {rounded(['skewness', 'kurtosis', 'jb'], 4)}, {r('exp(-jb / 2)', 4)} AS jb_p,
  {r('k2', 4)} AS k2, {r('exp(-k2 / 2)', 4)} AS k2_p, coalesce(exp(-k2 / 2), exp(-jb / 2)) > 0.05 AS normal FROM nf"""
