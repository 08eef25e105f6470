"""Stage C queries: pair batteries, rank correlation, group tests, time dependence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.functions import columns as fx
from tidepanel.functions.tails import tail
from tidepanel.operators import correlation as corr
from tidepanel.operators import grouptests, serial
from tidepanel.plans import testing
from tidepanel.spec import TESTED_GROUPS, TESTED_PAIRS
from tidepanel.workload import sql as s
from tidepanel.workload import tables as tb
from tidepanel.workload.profile_queries import _LINES
from tidepanel.workload.registry import query, tidy

LINE_PAIRS = [("l_quantity", "l_extendedprice"), ("l_extendedprice", "net"), ("l_discount", "net"), ("l_tax", "l_discount")]
EVENT_PAIRS = [("value", "hour"), ("user_id", "value")]
_EVENTS = "ev AS (SELECT *, CAST(hour(ts) AS INTEGER) AS hour FROM events)"


def events_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.load(spark, sf_dir, "events").drop("props").withColumn("hour", F.hour("ts"))


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


# --- pairs ----------------------------------------------------------------------------


def _pearson_sql(pairs: list[tuple[str, str]], table: str) -> str:
    return _union([
        f"SELECT '{x} vs {y}' AS pair, count(*) AS n, corr({x}, {y}) AS r, regr_slope({y}, {x}) AS slope, "
        f"regr_intercept({y}, {x}) AS intercept, CAST(min({x}) AS DOUBLE) AS x_min, CAST(max({x}) AS DOUBLE) AS x_max FROM {table}"
        for x, y in pairs
    ])


_PEARSON = f"p AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t FROM ({_pearson_sql(LINE_PAIRS, 'lines')}))"
_STRENGTH = """CASE WHEN abs(r) < 0.1 THEN 'Négligeable' WHEN abs(r) < 0.3 THEN 'Faible' WHEN abs(r) < 0.5 THEN 'Modérée'
  WHEN abs(r) < 0.7 THEN 'Forte' ELSE 'Très forte' END"""
_STARS = "CASE WHEN pv < 0.001 THEN '***' WHEN pv < 0.01 THEN '**' WHEN pv < 0.05 THEN '*' ELSE 'ns' END"


@query(
    f"WITH {_LINES}, {_PEARSON}, v AS (SELECT *, {s.t_two_sided('t', '(n - 2)')} AS pv FROM p) SELECT pair, n, "
    f"{s.rounded(['r', 't', 'slope', 'intercept', 'x_min', 'x_max'], 5)}, {s.r('r * r', 5)} AS r_squared, {s.r('pv', 5)} AS p, "
    f"{_STRENGTH} AS strength, {_STARS} AS stars, {s.r('r * r * 100', 5)} AS variance_explained FROM v"
)
def pearson_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = corr.with_labels(corr.with_pearson_p(corr.pearson(tb.lines(spark, sf_dir), LINE_PAIRS)))
    return tidy(found, 5)


@query(
    f"WITH {_LINES}, p AS ({_pearson_sql(LINE_PAIRS, 'lines')}) SELECT pair, CAST(i AS INTEGER) AS point, "
    f"{s.r('x_min + i * (x_max - x_min) / 99', 4)} AS x, {s.r('intercept + slope * (x_min + i * (x_max - x_min) / 99)', 4)} AS y "
    "FROM p, range(100) g(i)"
)
def ols_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(corr.regression_line(corr.pearson(tb.lines(spark, sf_dir), LINE_PAIRS)), 4)


@query(
    f"WITH {_EVENTS}, p AS ({_pearson_sql(EVENT_PAIRS, 'ev')}) " + _union([
        f"SELECT event_id, pair, {s.r(f'{y} - (intercept + slope * {x})')} AS residual FROM ev, p WHERE pair = '{x} vs {y}'"
        for x, y in EVENT_PAIRS
    ])
)
def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = corr.with_residual(events_hour(spark, sf_dir), EVENT_PAIRS)
    return tidy(found.select("event_id", "pair", "residual"))


def _ranks(column: str, over: str = "") -> str:
    part = f"PARTITION BY {over}" if over else ""
    each = f"PARTITION BY {over}, {column}" if over else f"PARTITION BY {column}"
    return f"rank() OVER ({part} ORDER BY {column}) + (count(*) OVER ({each}) - 1) / 2.0::DOUBLE"


def _spearman_sql(pairs: list[tuple[str, str]], table: str) -> str:
    return _union([
        f"SELECT '{x} vs {y}' AS pair, count(*) AS n, corr(a, b) AS rho FROM (SELECT {_ranks(x)} AS a, {_ranks(y)} AS b FROM {table})"
        for x, y in pairs
    ])


@query(
    f"WITH {_LINES}, p AS ({_spearman_sql(LINE_PAIRS, 'lines')}), u AS (SELECT *, rho * sqrt((n - 2) / (1 - rho * rho)) AS t FROM p) "
    f"SELECT pair, n, {s.rounded(['rho'])}, {s.rounded(['t'], 4)}, {s.r(s.t_two_sided('t', '(n - 2)'))} AS p FROM u"
)
def spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = corr.spearman(tb.lines(spark, sf_dir), LINE_PAIRS)
    tested = found.withColumn("p", tail("t_two_sided", "t", F.col("n") - 2))
    return tidy(tested, t=4)


def _kendall_sql(pairs: list[tuple[str, str]], table: str, key: str = "event_id") -> str:
    out = []
    for x, y in pairs:
        ties = " ".join(
            f", {n} AS (SELECT sum(c * (c - 1) / 2.0::DOUBLE) AS t, sum(c * (c - 1.0::DOUBLE) * (c - 2)) AS t3, "
            f"sum(c * (c - 1.0::DOUBLE) * (2 * c + 5)) AS tv FROM (SELECT count(*) AS c FROM {table} GROUP BY {g}))"
            for n, g in (("tx", x), ("ty", y))
        )
        out.append(
            f"(WITH s AS (SELECT sum(sign(a.{x} - b.{x}) * sign(a.{y} - b.{y})) AS s FROM {table} a JOIN {table} b ON a.{key} < b.{key}), "
            f"m AS (SELECT count(*) AS n, count(*) * (count(*) - 1.0::DOUBLE) AS m FROM {table}){ties} "
            f"SELECT '{x} vs {y}' AS pair, n, s / (sqrt(m / 2 - tx.t) * sqrt(m / 2 - ty.t)) AS tau, "
            "s / sqrt((m * (2 * n + 5) - tx.tv - ty.tv) / 18 + 2 * tx.t * ty.t / m + tx.t3 * ty.t3 / (9 * m * (n - 2))) AS z "
            "FROM s, m, tx, ty)"
        )
    return _union(out)


@query(f"WITH {_EVENTS} SELECT pair, n, {s.rounded(['tau', 'z'])} FROM ({_kendall_sql(EVENT_PAIRS, 'ev')})")
def kendall_tau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all rows, by counting; the SQL compares every pair of rows."""
    return tidy(corr.kendall(events_hour(spark, sf_dir), EVENT_PAIRS))


_PAIR_R = f"({_pearson_sql(EVENT_PAIRS, 'ev')}) a JOIN ({_spearman_sql(EVENT_PAIRS, 'ev')}) b USING (pair)"


@query(
    f"WITH {_EVENTS} SELECT pair, {s.r('r')} AS r, {s.r('rho')} AS rho, abs(rho - r) > 0.1 AS nonlinear FROM {_PAIR_R}"
)
def nonlinearity(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_hour(spark, sf_dir)
    both = corr.pearson(events, EVENT_PAIRS).select("pair", "r").join(
        corr.spearman(events, EVENT_PAIRS).select("pair", "rho"), "pair"
    )
    return tidy(both.withColumn("nonlinear", fx.nonlinear("r", "rho")))


@query(
    f"WITH {_LINES}, c AS (SELECT count(*) AS n, corr(l_extendedprice, net) AS r_xy, corr(l_extendedprice, l_discount) AS r_xz, "
    "corr(net, l_discount) AS r_yz FROM lines), q AS (SELECT *, (r_xy - r_xz * r_yz) / sqrt((1 - r_xz * r_xz) * (1 - r_yz * r_yz)) "
    "AS r_partial FROM c), u AS (SELECT *, r_partial * sqrt((n - 3) / (1 - r_partial * r_partial)) AS t FROM q) "
    f"SELECT n, {s.rounded(['r_xy', 'r_xz', 'r_yz', 'r_partial'])}, {s.r(s.t_two_sided('t', '(n - 3)'))} AS p FROM u"
)
def partial_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = corr.partial_correlation(tb.lines(spark, sf_dir), "l_extendedprice", "net", "l_discount")
    return tidy(found.drop("t"))


_PANEL_RESIDUALS = _union([
    f"SELECT '{x} vs {y}' AS pair, {y} - (intercept + slope * {x}) AS e FROM c, p WHERE pair = '{x} vs {y}'" for x, y in TESTED_PAIRS
])
_NORMAL = s.normality(_PANEL_RESIDUALS, "pair").rpartition("\nSELECT")[0]
_PANEL_TESTS = f"""c AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY "Region", "Datetime") AS rid FROM clean),
p AS MATERIALIZED (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t FROM ({_pearson_sql(TESTED_PAIRS, 'c')})),
rs AS (SELECT *, rho * sqrt((n - 2) / (1 - rho * rho)) AS ts FROM ({_spearman_sql(TESTED_PAIRS, 'c')})),
kt AS ({_kendall_sql(TESTED_PAIRS, 'c', 'rid')}), {_NORMAL},
v AS (SELECT p.pair, p.n, r, t, {s.t_two_sided('t', '(p.n - 2)')} AS pv, rho, {s.t_two_sided('ts', '(p.n - 2)')} AS sp,
  tau, {s.t_two_sided('z', '1e7::DOUBLE')} AS kp, coalesce(exp(-k2 / 2), exp(-jb / 2)) > 0.05 AS residuals_normal
  FROM p JOIN rs USING (pair) JOIN kt USING (pair) LEFT JOIN nf USING (pair))"""


@query(
    f"WITH {s.clean()}, {_PANEL_TESTS} SELECT pair, n, {s.r('r', 5)} AS pearson_r, {s.r('pv', 5)} AS pearson_p, {s.r('rho', 5)} AS spearman_rho, "
    f"{s.r('sp', 5)} AS spearman_p, {s.r('tau', 5)} AS kendall_tau, {s.r('kp', 5)} AS kendall_p, {s.r('r * r', 5)} AS r_squared, "
    f"residuals_normal, {_STRENGTH} AS strength, {_STARS} AS stars, abs(rho - r) > 0.1 AS nonlinear FROM v"
)
def pair_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full battery on the cleaned panel: Pearson, Spearman, Kendall, normality of residuals, labels."""
    return tidy(testing.pair_tests(tb.stored_clean_panel(spark, sf_dir)), 5)


# --- groups ---------------------------------------------------------------------------

ORDER_TESTS = [("o_totalprice", "o_orderpriority"), ("o_totalprice", "o_orderstatus"), ("o_custkey", "o_orderpriority")]
LINE_TESTS = [("l_extendedprice", "l_returnflag"), ("l_quantity", "l_linestatus"), ("l_discount", "l_returnflag")]


def _anova_sql(tests: list[tuple[str, str]], table: str) -> str:
    return _union([
        f"SELECT '{m}' AS quantitative, '{c}' AS qualitative, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_groups, sum(n * pow(mean - grand, 2)) AS ssb, "
        f"sum(n * var) AS ssw FROM (SELECT {c}, count({m}) AS n, avg({m}) AS mean, var_pop({m}) AS var, "
        f"(SELECT avg({m}) FROM {table}) AS grand FROM {table} GROUP BY 1)" for m, c in tests
    ])


_EFFECT = "CASE WHEN e > 0.14 THEN 'Large' WHEN e > 0.06 THEN 'Medium' ELSE 'Small' END"


@query(
    f"WITH m AS ({_anova_sql(ORDER_TESTS, 'orders')}), f AS (SELECT *, (ssb / (n_groups - 1)) / (ssw / (n - n_groups)) AS f, "
    f"ssb / (ssb + ssw) AS e FROM m) SELECT quantitative, qualitative, n, n_groups, {s.r('f')} AS anova_f, {s.r('e', 8)} AS eta_squared, "
    f"{_EFFECT} AS effect_size, {s.r(s.f_upper('f', '(n_groups - 1)', '(n - n_groups)'))} AS anova_p FROM f"
)
def anova_eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = grouptests.with_anova_p(grouptests.anova(tb.load(spark, sf_dir, "orders"), ORDER_TESTS))
    return tidy(found, eta_squared=8)


def _kruskal_sql(tests: list[tuple[str, str]], table: str) -> str:
    return _union([
        f"SELECT '{m}' AS quantitative, '{c}' AS qualitative, CAST(max(total) AS BIGINT) AS n, count(*) AS n_groups, "
        f"(max(total) - 1) * sum(w * pow(mean_rank - (total + 1) / 2.0::DOUBLE, 2)) / max(sst) AS h FROM ("
        f"SELECT g, count(*) AS w, avg(rk) AS mean_rank, max(total) AS total, max(sst) AS sst FROM (SELECT *, count(*) OVER () AS total, "
        f"sum(pow(rk - (cnt + 1) / 2.0::DOUBLE, 2)) OVER () AS sst FROM (SELECT {c} AS g, {_ranks(m)} AS rk, count(*) OVER () AS cnt FROM {table})) GROUP BY g)"
        for m, c in tests
    ])


@query(
    f"WITH k AS ({_kruskal_sql(LINE_TESTS, 'lineitem')}) SELECT quantitative, qualitative, n, n_groups, {s.r('h')} AS kruskal_h, "
    f"{s.r(s.chi2_upper('h', '(n_groups - 1)'))} AS kruskal_p FROM k"
)
def kruskal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks over whole tables in which a value or a group may hold a third of the rows."""
    found = grouptests.kruskal(tb.load(spark, sf_dir, "lineitem"), LINE_TESTS)
    return tidy(grouptests.with_kruskal_p(found))


_TUKEY = """WITH g AS (SELECT o_orderpriority AS grp, count(*) AS n, avg(o_totalprice) AS mean, var_pop(o_totalprice) AS var FROM orders GROUP BY 1),
w AS (SELECT count(*) AS k, sum(n) - count(*) AS dof, sum(n * var) / (sum(n) - count(*)) AS mse FROM g)"""


@query(
    f"{_TUKEY} SELECT 'o_totalprice' AS quantitative, 'o_orderpriority' AS qualitative, a.grp AS group1, b.grp AS group2, "
    f"{s.r('b.mean - a.mean', 4)} AS mean_diff, {s.r('sqrt(mse / 2 * (1.0::DOUBLE / a.n + 1.0::DOUBLE / b.n))', 4)} AS std_error, "
    f"{s.r('abs(b.mean - a.mean) / sqrt(mse / 2 * (1.0::DOUBLE / a.n + 1.0::DOUBLE / b.n))', 4)} AS q, CAST(k AS INTEGER) AS k, "
    "CAST(dof AS BIGINT) AS dof FROM g a JOIN g b ON a.grp < b.grp CROSS JOIN w"
)
def tukey_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(grouptests.tukey(tb.load(spark, sf_dir, "orders"), "o_totalprice", "o_orderpriority"), 4)


def _simpson(i: str, n: int) -> str:
    return f"CASE WHEN {i} IN (0, {n}) THEN 1 WHEN {i} % 2 = 1 THEN 4 ELSE 2 END"


# P(range of k normals > q s) over the distribution of s, three nested Simpson sums.
_RANGE = f"""pairs AS (SELECT a.grp AS group1, b.grp AS group2, b.mean - a.mean AS mean_diff, k, dof::DOUBLE AS dof,
  sqrt(mse / 2 * (1.0::DOUBLE / a.n + 1.0::DOUBLE / b.n)) AS std_error FROM g a JOIN g b ON a.grp < b.grp CROSS JOIN w),
ps AS (SELECT *, abs(mean_diff) / std_error AS q FROM pairs),
sg AS (SELECT i, ps.*, 1 + (i - 40) / 40.0::DOUBLE * 9 / sqrt(2 * dof) AS s FROM ps, range(81) t(i)),
sm AS (SELECT *, {_simpson('i', 80)} * exp(ln(2) + dof / 2 * ln(dof / 2) - lgamma(dof / 2) + (dof - 1) * ln(s) - dof * s * s / 2) AS mass FROM sg WHERE s > 0),
iz AS (SELECT group1, group2, i, j, k, mass, -8 + j / 10.0::DOUBLE AS z,
  sum({_simpson('m', 60)} * exp(-pow(-8 + j / 10.0::DOUBLE + q * s * m / 60, 2) / 2)) * q * s / 180 / sqrt(2 * pi()) AS inside
  FROM sm, range(161) zt(j), range(61) mt(m) GROUP BY group1, group2, i, j, k, mass, q, s),
rz AS (SELECT group1, group2, i, mass, 1 - k * sum({_simpson('j', 160)} * exp(-z * z / 2) * pow(inside, k - 1)) * 0.1 / 3 / sqrt(2 * pi()) AS upper
  FROM iz GROUP BY group1, group2, i, k, mass),
pv AS (SELECT group1, group2, greatest(0, sum(mass * upper) / sum(mass)) AS p FROM rz GROUP BY 1, 2)"""


@query(
    f"{_TUKEY}, {_RANGE} SELECT group1, group2, {s.r('mean_diff', 4)} AS mean_diff, {s.r('p', 5)} AS p, p < 0.05 AS reject, "
    "CAST(0.05 AS DOUBLE) AS p_at_critical, true AS bounds_agree FROM ps JOIN pv USING (group1, group2)"
)
def tukey_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs with p, decision, the level that the critical value has, and whether the
    bounds leave out 0 just where the pair is rejected."""
    pairs = grouptests.tukey(tb.load(spark, sf_dir, "orders"), "o_totalprice", "o_orderpriority")
    found = grouptests.with_tukey_p(pairs)
    level = tail("studentized_range_upper", "q_critical", "k", "dof")
    agree = F.col("reject") == ((F.col("lower") > 0) | (F.col("upper") < 0))
    return tidy(found.select("group1", "group2", "mean_diff", "p", "reject", level.alias("p_at_critical"), agree.alias("bounds_agree")), 5, mean_diff=4)


def _grouped_sql(m: str, c: str) -> str:
    """Sums of squares where rows without a group count in the total only."""
    known = "FILTER (WHERE g IS NOT NULL)"
    return (
        f"SELECT '{m}' AS quantitative, '{c}' AS qualitative, CAST(sum(n) {known} AS BIGINT) AS n, count(g) AS n_groups, "
        f"sum(n * pow(mean - inner_mean, 2)) {known} AS between_, sum(n * var) {known} AS ssw, "
        f"sum(n * pow(mean - all_mean, 2)) {known} / sum(n * (var + pow(mean - all_mean, 2))) AS e "
        f"FROM (SELECT {c} AS g, count({m}) AS n, avg({m}) AS mean, var_pop({m}) AS var, (SELECT avg({m}) FROM clean) AS all_mean, "
        f"(SELECT avg({m}) FROM clean WHERE {c} IS NOT NULL) AS inner_mean FROM clean GROUP BY 1)"
    )


_GROUPED = _union([_grouped_sql(m, c) for m, c in TESTED_GROUPS])
_RANKED = _union([_kruskal_sql([(m, c)], f"(SELECT * FROM clean WHERE {c} IS NOT NULL)") for m, c in TESTED_GROUPS])


@query(
    f"WITH {s.clean()}, m AS ({_GROUPED}), f AS (SELECT *, CASE WHEN n_groups > 1 THEN (between_ / (n_groups - 1)) / (ssw / (n - n_groups)) END AS f FROM m), "
    f"k AS ({_RANKED}), "
    f"v AS (SELECT quantitative, qualitative, f.n, f.n_groups, f, h, e, {s.f_upper('f', '(f.n_groups - 1)', '(f.n - f.n_groups)')} AS pv, "
    f"CASE WHEN f.n_groups > 1 THEN {s.chi2_upper('h', '(f.n_groups - 1)')} END AS kp FROM f JOIN k USING (quantitative, qualitative)) "
    f"SELECT quantitative, qualitative, n, n_groups, {s.r('f', 4)} AS anova_f, {s.r('pv', 4)} AS anova_p, {s.r('h', 4)} AS kruskal_h, "
    f"{s.r('kp', 4)} AS kruskal_p, {s.r('e', 4)} AS eta_squared, {_EFFECT} AS effect_size FROM v"
)
def group_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANOVA, Kruskal-Wallis and effect sizes of the cleaned panel."""
    return tidy(testing.group_tests(tb.stored_clean_panel(spark, sf_dir)).drop("stars"), 4)


@query(
    f"WITH {_LINES}, {_PEARSON}, v AS (SELECT {s.t_two_sided('t', '(n - 2)')} AS pv FROM p), "
    f"m AS ({_anova_sql(ORDER_TESTS, 'orders')}), f AS (SELECT *, (ssb / (n_groups - 1)) / (ssw / (n - n_groups)) AS f FROM m), "
    f"w AS (SELECT {s.f_upper('f', '(n_groups - 1)', '(n - n_groups)')} AS pv FROM f), al AS (FROM v UNION ALL FROM w) "
    "SELECT count(*) AS n_tests, count(*) FILTER (WHERE pv < 0.05) AS n_significant FROM al"
)
def significant_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = corr.with_pearson_p(corr.pearson(tb.lines(spark, sf_dir), LINE_PAIRS))
    groups = grouptests.with_anova_p(grouptests.anova(tb.load(spark, sf_dir, "orders"), ORDER_TESTS))
    p = pairs.select("p").unionByName(groups.select(F.col("anova_p").alias("p")))
    return p.agg(F.count("*").alias("n_tests"), grouptests.count_significant("p").alias("n_significant"))


_ALL_P = (
    f"{_LINES}, {_PEARSON}, v AS (SELECT pair, r, {s.t_two_sided('t', '(n - 2)')} AS pv FROM p), "
    f"m AS ({_anova_sql(ORDER_TESTS, 'orders')}), f AS (SELECT *, (ssb / (n_groups - 1)) / (ssw / (n - n_groups)) AS f, ssb / (ssb + ssw) AS e FROM m), "
    f"w AS (SELECT quantitative, qualitative, e, {s.f_upper('f', '(n_groups - 1)', '(n - n_groups)')} AS pv FROM f), "
    "al AS (SELECT pv FROM v UNION ALL SELECT pv FROM w)"
)


@query(
    f"WITH {_ALL_P}, b0 AS (SELECT min(pv) AS lo, max(pv) AS hi FROM al), "
    "b AS (SELECT least(floor((pv - lo) / ((hi - lo) / 20)), 19) AS b, count(*) AS c FROM al, b0 GROUP BY 1) "
    "SELECT CAST(i AS INTEGER) AS bin, coalesce(c, 0) AS count FROM range(20) r(i) LEFT JOIN b ON b = i"
)
def p_value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = corr.with_pearson_p(corr.pearson(tb.lines(spark, sf_dir), LINE_PAIRS))
    groups = grouptests.with_anova_p(grouptests.anova(tb.load(spark, sf_dir, "orders"), ORDER_TESTS))
    return testing.p_values(pairs.withColumnRenamed("p", "pearson_p"), groups).select("bin", "count")


@query(
    f"WITH {_ALL_P} SELECT (SELECT count(*) FROM al) AS n_tests, (SELECT count(*) FROM al WHERE pv < 0.05) AS n_significant, "
    f"(SELECT arg_max(pair, abs(r)) FROM v) AS strongest_pair, {s.r('(SELECT arg_max(r, abs(r)) FROM v)')} AS strongest_r, "
    "(SELECT arg_max(quantitative || ' par ' || qualitative, e) FROM w) AS largest_effect, "
    f"{s.r('(SELECT max(e) FROM w)')} AS largest_eta_squared"
)
def test_conclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of significant tests, strongest pair and largest effect of two tables."""
    pairs = corr.with_pearson_p(corr.pearson(tb.lines(spark, sf_dir), LINE_PAIRS))
    groups = grouptests.with_anova_p(grouptests.anova(tb.load(spark, sf_dir, "orders"), ORDER_TESTS))
    return tidy(testing.conclusions(pairs.withColumnsRenamed({"p": "pearson_p", "r": "pearson_r"}), groups))


@query(
    "WITH l AS (SELECT l_extendedprice, l_quantity, l_discount, l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem), "
    "n AS (SELECT count(*) AS n FROM l), "
    + "c AS (" + _union([
        f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a}, {b}) AS corr FROM l"
        for a in ("l_extendedprice", "l_quantity", "l_discount", "l_tax") for b in ("l_extendedprice", "l_quantity", "l_discount", "l_tax")
    ]) + ") "
    f"SELECT var1, var2, {s.r('CASE WHEN abs(corr) < 1.959964 / sqrt(n - 2 + 1.959964 * 1.959964) THEN 0 ELSE corr END')} AS corr_significant FROM c, n"
)
def masked_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix with insignificant coefficients at 0; with many rows t is close to its normal limit."""
    names = ("l_extendedprice", "l_quantity", "l_discount", "l_tax")
    found = testing.masked_matrix(tb.load(spark, sf_dir, "lineitem"), names)
    return tidy(found.select("var1", "var2", "corr_significant"))


# --- time dependence ------------------------------------------------------------------


def _ljung_sql(part: str, order: str, source: str = "events") -> str:
    key = f"{part}, " if part else ""
    over = f"PARTITION BY {part}" if part else ""
    products = ", ".join(f"sum(e * e{k}) AS c{k}" for k in range(1, 25))
    lagged = ", ".join(f"lag(e, {k}) OVER ({over} ORDER BY {order}) AS e{k}" for k in range(1, 25))
    group = f"GROUP BY {part}" if part else ""
    long = _union([f"SELECT {key}n, {k} AS lag, coalesce(c{k}, 0) / c0 AS rho FROM a" for k in range(1, 25)])
    return f"""WITH d AS (SELECT *, value - avg(value) OVER ({over}) AS e FROM {source}), l AS (SELECT *, {lagged} FROM d),
a AS (SELECT {key}count(*) AS n, sum(e * e) AS c0, {products} FROM l {group}), r AS ({long}),
q AS (SELECT *, n * (n + 2.0::DOUBLE) * sum(rho * rho / (n - lag)) OVER ({over} ORDER BY lag) AS q FROM r)
SELECT {key}n, CAST(lag AS INTEGER) AS lag, {s.r('rho')} AS rho, {s.r('q')} AS q, {s.r(s.chi2_upper('q', 'lag'))} AS p FROM q"""


@query(_ljung_sql("event_type", "ts, event_id"))
def ljung_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per entity at event grain: lag products in chunks."""
    events = tb.load(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")
    return tidy(serial.with_ljung_box_p(serial.ljung_box(events, tb.EVENTS, "value")))


@query(_ljung_sql("", "ts, event_id"))
def ljung_box_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the whole table in time order, entities interleaved as in the original."""
    events = tb.load(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")
    found = serial.ljung_box(events, tb.EVENTS, "value", table_order=["ts", "event_id"])
    return tidy(serial.with_ljung_box_p(found))


_LB = _ljung_sql("event_type", "ts, event_id", "(SELECT event_type, ts, event_id, value + 10 * hour(ts) AS value FROM events)")


@query(
    f"WITH lb AS ({_LB}), h AS (SELECT event_type, lag FROM lb WHERE p < 0.05) SELECT event_type, count(*) AS n_significant, "
    "array_to_string(list_slice(list(lag ORDER BY lag), 1, 5), ',') AS first_lags FROM h GROUP BY 1"
)
def significant_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per entity the number of lags with a Ljung-Box p below 0.05 and the first five, of a value that
    drifts with the hour."""
    drifting = (F.col("value") + 10 * F.hour("ts")).alias("value")
    events = tb.load(spark, sf_dir, "events").select("event_type", "ts", "event_id", drifting)
    found = serial.significant_lags(serial.with_ljung_box_p(serial.ljung_box(events, tb.EVENTS, "value")), ["event_type"])
    return found.withColumn("first_lags", F.array_join(F.col("first_lags").cast("array<string>"), ","))


def _granger(spark: SparkSession, sf_dir: str, max_lag: int) -> DataFrame:
    events = events_hour(spark, sf_dir).select("event_type", "ts", "event_id", "value", "user_id")
    return serial.granger(events, tb.EVENTS, "value", "user_id", max_lag)


@query()
def granger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 24 lags for all entities, over all rows."""
    return serial.with_granger_p(_granger(spark, sf_dir, 24))


@query(
    "WITH l AS (SELECT event_type, value AS y, lag(value) OVER w AS y1, CAST(lag(user_id) OVER w AS DOUBLE) AS x1 FROM events "
    "WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)), "
    "c AS (SELECT event_type, count(*) AS n, corr(y, x1) AS a, corr(y, y1) AS b, corr(x1, y1) AS c FROM l WHERE y1 IS NOT NULL GROUP BY 1), "
    "r AS (SELECT *, pow(a - b * c, 2) / ((1 - b * b) * (1 - c * c)) AS r2 FROM c) "
    f"SELECT event_type, CAST(1 AS INTEGER) AS lag, n, {s.r('(n - 3) * r2 / (1 - r2)')} AS f, CAST(1 AS INTEGER) AS df_num, n - 3 AS df_den FROM r"
)
def granger_lag1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag 1 alone, where F follows from one partial correlation."""
    return tidy(_granger(spark, sf_dir, 1))


def _granger_sql(max_lag: int, source: str = "events") -> str:
    """F of lags 1 to ``max_lag``: regressors are made orthogonal one after the other."""
    lags = ", ".join(f"lag({c}, {k}) OVER w AS {n}{k}" for c, n in (("value", "y"), ("CAST(user_id AS DOUBLE)", "x")) for k in range(1, max_lag + 1))
    parts = [f"l AS (SELECT event_type, value AS y, {lags} FROM {source} WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))"]
    found = []
    for p in range(1, max_lag + 1):
        inputs = [*(f"y{k}" for k in range(1, p + 1)), *(f"x{k}" for k in range(1, p + 1))]
        over, names = "OVER (PARTITION BY event_type)", ["y", *inputs]
        parts.append(f"g{p}_0 AS (SELECT event_type, {', '.join(f'{c} - avg({c}) {over} AS {c}' for c in names)} FROM l WHERE y{p} IS NOT NULL)")
        for i, z in enumerate(inputs):
            rest = ["y", *inputs[i + 1 :]]
            cells = ", ".join(f"{c} - {z} * (sum({c} * {z}) {over} / sum({z} * {z}) {over}) AS {c}" for c in rest)
            parts.append(f"g{p}_{i + 1} AS (SELECT event_type, {cells} FROM g{p}_{i})")
        sums = [f"(SELECT event_type, count(*) AS n, sum(y * y) AS r{s} FROM g{p}_{at} GROUP BY 1)" for s, at in ((1, p), (2, 2 * p))]
        found.append(
            f"SELECT a.event_type, CAST({p} AS INTEGER) AS lag, a.n, (r1 - r2) / {p} / (r2 / (a.n - {2 * p + 1})) AS f, "
            f"CAST({p} AS INTEGER) AS df_num, a.n - {2 * p + 1} AS df_den FROM {sums[0]} a JOIN {sums[1]} b USING (event_type)"
        )
    return f"WITH {', '.join(parts)}, f AS ({_union(found)}) SELECT event_type, lag, n, {s.r('f')} AS f, df_num, df_den, {s.r(s.f_upper('f', 'df_num', 'df_den'))} AS p FROM f"


@query(_granger_sql(3))
def granger_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags 1 to 3 with p; the SQL solves the regressions by orthogonal steps."""
    return tidy(serial.with_granger_p(_granger(spark, sf_dir, 3)))


@query(
    "SELECT lag, n, f, df_num, df_den, p FROM ("
    + _granger_sql(3, "(SELECT 0 AS event_type, ts, event_id, value, user_id FROM events ORDER BY ts, event_id LIMIT 5000)") + ")"
)
def granger_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags 1 to 3 over the first 5000 rows in time order, all types as one series."""
    events = tb.load(spark, sf_dir, "events").select("ts", "event_id", "value", "user_id")
    return tidy(serial.with_granger_p(serial.granger_first(events, ["ts", "event_id"], "value", "user_id", 3)))


_JB_GROUPS = _union([
    f"SELECT '{x} vs {y}' AS pair, event_type, {y} - (intercept + slope * {x}) AS e FROM ev, p WHERE pair = '{x} vs {y}'"
    for x, y in EVENT_PAIRS
])


@query(
    f"WITH {_EVENTS}, p AS ({_pearson_sql(EVENT_PAIRS, 'ev')}), e AS ({_JB_GROUPS}), "
    "c AS (SELECT *, e - avg(e) OVER (PARTITION BY pair, event_type) AS d FROM e), "
    "m AS (SELECT pair, event_type, count(*) AS n, avg(d * d) AS m2, avg(pow(d, 3)) AS m3, avg(pow(d, 4)) AS m4 FROM c GROUP BY 1, 2), "
    "j AS (SELECT *, m3 / pow(m2, 1.5::DOUBLE) AS skewness, m4 / (m2 * m2) - 3 AS kurtosis FROM m) "
    f"SELECT pair, event_type, n, {s.rounded(['skewness', 'kurtosis'])}, {s.r('n / 6.0::DOUBLE * (skewness * skewness + kurtosis * kurtosis / 4)', 4)} AS jb FROM j"
)
def jarque_bera(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = corr.with_residual(events_hour(spark, sf_dir), EVENT_PAIRS)
    found = serial.jarque_bera(rows, "residual", ["pair", "event_type"]).drop("p")
    return tidy(found, jb=4)


@query(
    f"WITH {_EVENTS}, p AS ({_pearson_sql(EVENT_PAIRS, 'ev')}), e AS ({_JB_GROUPS}), " + s.normality("SELECT * FROM e", "pair, event_type")
)
def residual_normality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jarque-Bera and K² per pair and entity over all rows."""
    rows = corr.with_residual(events_hour(spark, sf_dir), EVENT_PAIRS)
    return tidy(serial.normality(rows, "residual", ["pair", "event_type"]), 4)


_QUANTILE = s.normal_quantile("(rk - 0.375::DOUBLE) / (n + 0.25::DOUBLE)")


@query(
    f"WITH {_EVENTS}, p AS ({_pearson_sql(EVENT_PAIRS, 'ev')}), e AS ({_JB_GROUPS}), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY pair, event_type ORDER BY e) AS rk, count(*) OVER (PARTITION BY pair, event_type) AS n FROM e), "
    f"w AS (SELECT pair, event_type, n, pow(corr(e, {_QUANTILE}), 2) AS w FROM k GROUP BY ALL), "
    "z AS (SELECT *, (ln(1 - w) - (-1.2725::DOUBLE + 1.0521::DOUBLE * (ln(ln(n)) - ln(n)))) / (1.0308::DOUBLE - 0.26758::DOUBLE * (ln(ln(n)) + 2 / ln(n))) AS z FROM w), "
    f"t AS (SELECT *, {s.t_two_sided('z', '1e7::DOUBLE')} / 2 AS half FROM z) "
    f"SELECT pair, event_type, n, {s.r('w', 8)} AS w, {s.r('z', 4)} AS z, {s.r('CASE WHEN z >= 0 THEN half ELSE 1 - half END', 4)} AS p, "
    "CASE WHEN z >= 0 THEN half ELSE 1 - half END > 0.05 AS normal FROM t"
)
def shapiro_francia(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W' of every pair's residuals per entity, over all rows."""
    rows = corr.with_residual(events_hour(spark, sf_dir), EVENT_PAIRS)
    return tidy(serial.shapiro_francia(rows, "residual", ["pair", "event_type"]), 4, w=8)
