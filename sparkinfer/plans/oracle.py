"""Equivalent SQL for the registered queries, for an independent engine.

Special functions are summed as series (normal, incomplete beta and gamma), so the
p-values are checked by other formulas than the ones the library uses.
"""

from __future__ import annotations

from sparkinfer.plans.queries import CHANNELS, EVENTS, LOW, SEED, SERIES_START, SPANS, STORES, URGENT

ROW_KEY = """concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
    strftime(l_shipdate, '%Y-%m-%d'), CAST(round(l_extendedprice * 100) AS BIGINT))"""
LINE = f"""l_suppkey AS store, l_quantity AS units, nullif(l_discount, 0) AS discount,
    l_extendedprice AS amount, l_linestatus AS gender, l_returnflag AS flag, {ROW_KEY} AS row_key"""
LINES = f"lines AS (SELECT l_shipdate, {LINE} FROM lineitem)"
SALES = f"""sales AS (SELECT o_orderdate AS ts, o_orderpriority AS channel, c_mktsegment AS segment, {LINE},
    CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS customer_id,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS born, l_shipdate AS shipped,
    date_diff('day', o_orderdate, l_shipdate) / 365.25 AS age_years
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""
PI = "pi()"


# ---- special functions ------------------------------------------------------

def phi(z: str, terms: int = 200) -> str:
    """Normal CDF by its series; fine for |z| < 10."""
    total = (f"list_sum(list_transform(range(0, {terms}), lambda i_: exp(i_ * ln(greatest(({z}) * ({z}), 1e-300))"
             f" - (i_ + 1) * ln(2.0) - lgamma(i_ + 1.5) + 0.5 * ln({PI}))))")
    return (f"(CASE WHEN ({z}) > 9 THEN 1.0 WHEN ({z}) < -9 THEN 0.0 ELSE 0.5 + exp(-0.5 * ({z}) * ({z}))"
            f" / sqrt(2 * {PI}) * ({z}) * {total} END)")


def beta_cdf(a: str, b: str, x: str, terms: int = 600) -> str:
    """Regularised incomplete beta by its power series."""
    return (f"(CASE WHEN ({x}) <= 0 THEN 0.0 ELSE exp(({a}) * ln({x}) + ({b}) * ln(1 - ({x})) - ln({a})"
            f" - lgamma({a}) - lgamma({b}) + lgamma(({a}) + ({b})))"
            f" * list_sum(list_transform(range(0, {terms}), lambda i_: exp(lgamma(({a}) + ({b}) + i_) - lgamma(({a}) + ({b}))"
            f" - lgamma(({a}) + 1 + i_) + lgamma(({a}) + 1) + i_ * ln({x})))) END)")


def t_two_sided(t: str, df: str) -> str:
    return f"(1 - {beta_cdf('0.5', f'({df}) / 2.0', f'(({t}) * ({t})) / (({df}) + ({t}) * ({t}))')})"


def t_greater(t: str, df: str) -> str:
    half = f"0.5 * {t_two_sided(t, df)}"
    return f"(CASE WHEN ({t}) >= 0 THEN {half} ELSE 1 - {half} END)"


def f_upper(f: str, d1: str, d2: str) -> str:
    return f"(1 - {beta_cdf(f'({d1}) / 2.0', f'({d2}) / 2.0', f'(({d1}) * ({f})) / (({d1}) * ({f}) + ({d2}))')})"


def chi2_upper(x: str, df: str, terms: int = 1500) -> str:
    a, h = f"(({df}) / 2.0)", f"(({x}) / 2.0)"
    return (f"(CASE WHEN ({x}) <= 0 THEN 1.0 WHEN {h} > 600 THEN 0.0 ELSE greatest(0.0, 1 -"
            f" list_sum(list_transform(range(0, {terms}), lambda i_:"
            f" exp((i_ + {a}) * ln({h}) - {h} - lgamma({a} + 1 + i_))))) END)")


def label(value: str, kind: str = "r") -> str:
    small, medium, large = (0.01, 0.06, 0.14) if kind == "eta2" else (0.1, 0.3, 0.5)
    return (f"CASE WHEN {value} IS NULL THEN 'undefined' WHEN abs({value}) < {small} THEN 'negligible'"
            f" WHEN abs({value}) < {medium} THEN 'small' WHEN abs({value}) < {large} THEN 'medium' ELSE 'large' END")


def _horner(x: str, coefficients) -> str:
    text = repr(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text} * ({x}) + {c!r})"
    return text


def ppf(p: str) -> str:
    """Normal quantile (AS 241), the same published fit as the library's."""
    from sparkinfer.functions import normal as c
    q = f"(({p}) - 0.5)"
    r = f"sqrt(-ln(least({p}, 1 - ({p}))))"
    mid = f"{q} * {_horner(f'0.180625 - {q} * {q}', c.PPF_MID_NUM)} / {_horner(f'0.180625 - {q} * {q}', c.PPF_MID_DEN)}"
    near = f"{_horner(f'{r} - 1.6', c.PPF_NEAR_NUM)} / {_horner(f'{r} - 1.6', c.PPF_NEAR_DEN)}"
    return f"(CASE WHEN abs{q} <= 0.425 THEN {mid} ELSE sign{q} * {near} END)"


# ---- pieces -----------------------------------------------------------------

def _avg_rank(value: str, partition: str = "") -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    peers = f"PARTITION BY {partition + ', ' if partition else ''}{value}"
    return f"(rank() OVER ({part}ORDER BY {value}) + (count(*) OVER ({peers}) - 1) / 2.0)"


def _digest(key: str = "row_key") -> str:
    return f"md5(concat_ws('|', {key}, '{SEED}'))"


def _melt(columns, source, by=""):
    lead = f"{by}, " if by else ""
    return " UNION ALL ".join(f"SELECT {lead}'{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns)


def _describe_full(columns, by=""):
    lead = f"{by}, " if by else ""
    return f"""WITH {SALES}, long AS ({_melt(columns, 'sales', by)})
    SELECT {lead}"column", CAST(count(value) AS BIGINT) AS n, round(avg(value), 5) AS mean,
        round(quantile_cont(value, 0.5), 5) AS median, round(var_samp(value), 2) AS variance,
        round(stddev_samp(value), 5) AS std, round(min(value), 5) AS min, round(max(value), 5) AS max,
        round(skewness(value), 5) AS skew, round(kurtosis(value), 5) AS kurtosis
    FROM long GROUP BY ALL"""


def _fences(source, value, by=""):
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""SELECT {lead}quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.75) AS q3,
        CAST(count({value}) AS BIGINT) AS n_values FROM {source} {group}"""


SERIES = """daily AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS v FROM orders GROUP BY 1),
    span AS (SELECT min(day) AS a, max(day) AS b FROM daily),
    spine AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
    series AS (SELECT day, CAST(date_diff('day', a, day) AS BIGINT) AS pos, coalesce(v, 0.0) AS value
        FROM spine LEFT JOIN daily USING (day) CROSS JOIN span)"""
EVENT_ROWS = "events_(name, day) AS (VALUES " + ", ".join(f"('{n}', DATE '{d}')" for n, d in EVENTS) + ")"
FLAGGED = f"""{SERIES}, {EVENT_ROWS},
    calendar AS (SELECT name, day, day BETWEEN a AND b AS in_range FROM events_ CROSS JOIN span),
    flagged AS (SELECT s.*, EXISTS (SELECT 1 FROM calendar c WHERE c.in_range
        AND s.day BETWEEN c.day - 7 AND c.day + 7) AS is_special FROM series s)"""


def _chi2(cells, by="", yates=False):
    """Chi-square over a dense table: every row level x every column level."""
    lead = f"{by}, " if by else ""
    using = f"USING ({by})" if by else ""
    group = f"GROUP BY {by}" if by else ""
    join = (lambda t: f"JOIN {t} {using}") if by else (lambda t: f"CROSS JOIN {t}")
    cell_on = f"d.{by} = c.{by} AND " if by else ""
    d_by = f"d.{by}, " if by else ""
    gap = "abs(o - e) - CASE WHEN (n_rows - 1) * (n_cols - 1) = 1 THEN least(0.5, abs(o - e)) ELSE 0 END"
    return f"""cells AS ({cells}),
    rowsum AS (SELECT {lead}a, sum(n) AS r FROM cells GROUP BY {lead}a),
    colsum AS (SELECT {lead}b, sum(n) AS c FROM cells GROUP BY {lead}b),
    totals AS (SELECT {lead}sum(n) AS t, count(DISTINCT a) AS n_rows, count(DISTINCT b) AS n_cols FROM cells {group}),
    dense AS (SELECT * FROM rowsum {join('colsum')} {join('totals')}),
    filled AS (SELECT {d_by}d.t, d.n_rows, d.n_cols, coalesce(c.n, 0) AS o, d.r * d.c / CAST(d.t AS DOUBLE) AS e
        FROM dense d LEFT JOIN cells c ON {cell_on}d.a = c.a AND d.b = c.b),
    tested AS (SELECT {lead}CAST(any_value(t) AS BIGINT) AS n, CAST(any_value(n_rows) AS BIGINT) AS n_rows,
        CAST(any_value(n_cols) AS BIGINT) AS n_cols, sum(({gap}) * ({gap}) / e) AS statistic,
        CAST(any_value((n_rows - 1) * (n_cols - 1)) AS BIGINT) AS df FROM filled {group})"""


def _chi2_columns(by=""):
    v = "sqrt(statistic / (n * least(n_rows - 1, n_cols - 1)))"
    return f"""{by + ', ' if by else ''}n, n_rows, n_cols, round(statistic, 6) AS statistic, df,
        round({chi2_upper('statistic', 'df')}, 6) AS p_value, round({v}, 6) AS cramers_v,
        {label(v, 'v')} AS effect_label, 'ok' AS status"""


def _spearman(x, y, by=""):
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    t = "rho * sqrt((n - 2) / (1 - rho * rho))"
    return f"""WITH {SALES}, ranked AS (SELECT {lead}{_avg_rank(x, by)} AS rx, {_avg_rank(y, by)} AS ry
        FROM sales WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
    c AS (SELECT {lead}CAST(count(*) AS BIGINT) AS n, corr(rx, ry) AS rho FROM ranked {group})
    SELECT {lead}n, round(rho, 6) AS rho, 'ok' AS status, round({t_two_sided(t, 'n - 2')}, 6) AS p_value FROM c"""


def _anova(value, factor, by=""):
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    part = f"PARTITION BY {by}" if by else ""
    return f"""WITH {SALES}, g AS (SELECT {lead}{factor}, count(*) AS m, avg({value}) AS mean, var_samp({value}) AS v
        FROM sales WHERE {value} IS NOT NULL GROUP BY {lead}{factor} HAVING count(*) > 1),
    c AS (SELECT *, sum(m * mean) OVER ({part}) / sum(m) OVER ({part}) AS grand FROM g),
    f AS (SELECT {lead}CAST(sum(m) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS n_groups,
        sum(m * (mean - grand) * (mean - grand)) AS ssb, sum((m - 1) * v) AS ssw FROM c {group}),
    s AS (SELECT *, (ssb / (n_groups - 1)) / (ssw / (n - n_groups)) AS stat, n_groups - 1 AS d1, n - n_groups AS d2 FROM f)
    SELECT {lead}n, n_groups, round(stat, 6) AS statistic, d1 AS df1, d2 AS df2, 'ok' AS status,
        round({f_upper('stat', 'd1', 'd2')}, 6) AS p_value FROM s"""


def _kruskal(value, factor, by=""):
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    peers = f"{by}, {value}" if by else value
    join = f"JOIN ties USING ({by})" if by else "CROSS JOIN ties"
    return f"""WITH {SALES}, ranked AS (SELECT {lead}{factor}, {value}, {_avg_rank(value, by)} AS rk FROM sales
        WHERE {value} IS NOT NULL),
    ties AS (SELECT {lead}sum(CAST(t AS DOUBLE) * t * t - t) AS ties FROM
        (SELECT {lead}count(*) AS t FROM ranked GROUP BY {peers}) {group}),
    g AS (SELECT {lead}{factor}, count(*) AS m, sum(rk) AS r FROM ranked GROUP BY {lead}{factor}),
    f AS (SELECT {lead}CAST(sum(m) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS k, sum(r * r / m) AS s FROM g {group}),
    h AS (SELECT f.*, (12.0 / (CAST(n AS DOUBLE) * (n + 1)) * s - 3.0 * (n + 1))
        / (1 - ties / (CAST(n AS DOUBLE) * n * n - n)) AS stat FROM f {join}),
    e AS (SELECT *, greatest(0.0, (stat - k + 1) / (n - k)) AS eta FROM h)
    SELECT {lead}n, k AS n_groups, round(stat, 6) AS statistic, k - 1 AS df, 'ok' AS status,
        round({chi2_upper('stat', 'k - 1')}, 6) AS p_value, round(eta, 6) AS effect,
        {label('eta', 'eta2')} AS effect_label FROM e"""


def _mann_whitney(source, value, group, first, second, by="", greater=False):
    lead, grouped = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    peers = f"{by}, {value}" if by else value
    join = f"JOIN ties USING ({by})" if by else "CROSS JOIN ties"
    tail = "u" if greater else "greatest(u, n1 * n2 - u)"
    z = f"(({tail}) - n1 * n2 / 2.0 - 0.5) / sqrt(var)"
    p = f"least(1.0, {1 if greater else 2} * (1 - {phi(z)}))"
    r = "1 - 2.0 * u / (CAST(n1 AS DOUBLE) * n2)"
    return f"""ranked AS (SELECT {lead}{group} AS g, {value}, {_avg_rank(value, by)} AS rk FROM {source}
        WHERE {value} IS NOT NULL AND {group} IN ({first}, {second})),
    ties AS (SELECT {lead}sum(CAST(t AS DOUBLE) * t * t - t) AS ties FROM
        (SELECT {lead}count(*) AS t FROM ranked GROUP BY {peers}) {grouped}),
    f AS (SELECT {lead}CAST(count(*) FILTER (WHERE g = {first}) AS BIGINT) AS n1,
        CAST(count(*) FILTER (WHERE g = {second}) AS BIGINT) AS n2,
        sum(rk) FILTER (WHERE g = {first}) AS r1 FROM ranked {grouped}),
    s AS (SELECT f.*, r1 - n1 * (n1 + 1) / 2.0 AS u, n1 * n2 / 12.0 * ((n1 + n2 + 1)
        - ties / (CAST(n1 + n2 AS DOUBLE) * (n1 + n2 - 1))) AS var FROM f {join})""", f"""{lead}n1, n2, round(u, 6) AS statistic,
        round({r}, 6) AS effect, {label(r)} AS effect_label, round({p}, 6) AS p_value, 'ok' AS status"""


def _welch(source, value, group, first, second, by="", greater=False):
    lead, grouped = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    one, two = f"FILTER (WHERE {group} = {first})", f"FILTER (WHERE {group} = {second})"
    p = t_greater("t", "d") if greater else t_two_sided("t", "d")
    return f"""w AS (SELECT {lead}CAST(count({value}) {one} AS BIGINT) AS n1, CAST(count({value}) {two} AS BIGINT) AS n2,
        avg({value}) {one} AS m1, avg({value}) {two} AS m2, var_samp({value}) {one} AS v1, var_samp({value}) {two} AS v2
        FROM {source} {grouped}),
    wt AS (SELECT *, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t, (v1 / n1 + v2 / n2) * (v1 / n1 + v2 / n2)
        / (v1 * v1 / (n1 * n1 * (n1 - 1.0)) + v2 * v2 / (n2 * n2 * (n2 - 1.0))) AS d FROM w)""", f"""{lead}n1, n2,
        round(m1, 4) AS mean1, round(m2, 4) AS mean2, round(t, 4) AS statistic, round(d, 4) AS df, 'ok' AS status,
        round({p}, 4) AS p_value"""


def _line(source, y, x, by="", digits=6):
    lead, grouped = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    where = f"{y} IS NOT NULL AND {x} IS NOT NULL"
    return f"""r AS (SELECT {lead}CAST(count(*) AS BIGINT) AS n, regr_slope({y}, {x}) AS b, regr_intercept({y}, {x}) AS a,
        regr_r2({y}, {x}) AS r2, regr_sxx({y}, {x}) AS sxx, regr_syy({y}, {x}) AS syy FROM {source} WHERE {where} {grouped}),
    rs AS (SELECT *, sqrt(syy * (1 - r2) / (n - 2) / sxx) AS se FROM r)
    """, f"""{lead}n, round(b, {digits}) AS slope, round(a, {digits}) AS intercept, round(r2, {digits}) AS r2,
        round(se, {digits}) AS std_err, round(b / se, {digits}) AS statistic, n - 2 AS df, 'ok' AS status,
        round({t_two_sided('b / se', 'n - 2')}, {digits}) AS p_value"""


def _one_slope(target, condition="TRUE"):
    """Closed form of target ~ units + flag dummies: common slope within the flags."""
    return f"""base AS (SELECT flag, units AS x, {target} AS y, row_key FROM fitsource WHERE {condition}),
    gm AS (SELECT flag, count(*) AS ng, avg(x) AS mx, avg(y) AS my FROM base GROUP BY flag),
    within AS (SELECT sum((x - mx) * (x - mx)) AS sxx, sum((x - mx) * (y - my)) AS sxy, sum((y - my) * (y - my)) AS syy,
        count(*) AS n FROM base JOIN gm USING (flag)),
    tot AS (SELECT var_pop(y) * count(*) AS tss FROM base),
    model AS (SELECT sxy / sxx AS b, sxx, n, syy - sxy * sxy / sxx AS rss, tss, (syy - sxy * sxy / sxx) / (n - 4) AS s2
        FROM within CROSS JOIN tot),
    g0 AS (SELECT ng AS n0, mx AS x0, my AS y0 FROM gm WHERE flag = 'N')"""


MODEL = f"WITH {LINES}, fitsource AS (SELECT * FROM lines), {_one_slope('amount')}"
FITTED = f"""{MODEL}, fitted AS (SELECT base.row_key, base.flag, x, y, my + b * (x - mx) AS predicted,
    y - (my + b * (x - mx)) AS residual FROM base JOIN gm USING (flag) CROSS JOIN model)"""
SPLIT_MODEL = f"""WITH {LINES}, fitsource AS (SELECT *, {_digest()} < '4ccccccd' AS is_test FROM lines),
    {_one_slope('amount', 'NOT is_test')}"""


def _shapiro(source, value, size, by=""):
    """Shapiro-Wilk W on the digest sample, as one ordered sum per group."""
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    part = f"PARTITION BY {by} " if by else ""
    c1 = "(0.221157 * u - 0.147981 * u * u - 2.071190 * u ** 3 + 4.434685 * u ** 4 - 2.706056 * u ** 5)"
    c2 = "(0.042981 * u - 0.293762 * u * u - 1.752461 * u ** 3 + 5.682633 * u ** 4 - 3.582633 * u ** 5)"
    return f"""picked AS (SELECT {lead}{value} AS x, row_number() OVER ({part}ORDER BY {_digest()}) AS pick
        FROM {source} WHERE {value} IS NOT NULL),
    placed AS (SELECT {lead}x, row_number() OVER ({part}ORDER BY x) AS i, count(*) OVER ({part.strip()}) AS n
        FROM picked WHERE pick <= {size}),
    scored AS (SELECT *, {ppf('(i - 0.375) / (n + 0.25)')} AS m, 1 / sqrt(n) AS u FROM placed),
    sums AS (SELECT {lead}any_value(n) AS n, any_value(u) AS u, sum(m * m) AS mm, max(m) AS m1,
        max(m) FILTER (WHERE i = n - 1) AS m2 FROM scored {group}),
    ends AS (SELECT *, {c1} + m1 / sqrt(mm) AS a1, {c2} + m2 / sqrt(mm) AS a2 FROM sums),
    scale AS (SELECT *, sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)) AS f FROM ends),
    weights AS (SELECT {('s.' + by + ', ') if by else ''}x, s.n, CASE WHEN i = 1 THEN -a1 WHEN i = s.n THEN a1 WHEN i = 2 THEN -a2
        WHEN i = s.n - 1 THEN a2 ELSE m / f END AS a FROM scored s JOIN scale k ON {f's.{by} = k.{by}' if by else 'TRUE'}),
    w AS (SELECT {lead}CAST(any_value(n) AS BIGINT) AS n, sum(a * x) * sum(a * x) / (var_pop(x) * count(*)) AS w FROM weights {group})"""


def _shapiro_p(w="w", n="n"):
    z = (f"(ln(1 - {w}) - (0.0038915 * ln({n}) ** 3 - 0.083751 * ln({n}) ** 2 - 0.31082 * ln({n}) - 1.5861))"
         f" / exp(0.0030302 * ln({n}) ** 2 - 0.082676 * ln({n}) - 0.4803)")
    return f"(1 - {phi(z)})"


def _ks(source, value, by=""):
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    part = f"PARTITION BY {by} " if by else ""
    peers = f"PARTITION BY {by + ', ' if by else ''}x"
    return f"""z AS (SELECT {lead}{value} AS x, count(*) OVER ({part.strip()}) AS n, rank() OVER ({part}ORDER BY {value}) - 1 AS lt,
        count(*) OVER (PARTITION BY {by + ', ' if by else ''}{value}) AS t,
        ({value} - avg({value}) OVER ({part.strip()})) / stddev_samp({value}) OVER ({part.strip()}) AS z
        FROM {source} WHERE {value} IS NOT NULL),
    distinct_z AS (SELECT DISTINCT * FROM z),
    cdf AS (SELECT *, {phi('z')} AS c FROM distinct_z),
    ks AS (SELECT {lead}CAST(any_value(n) AS BIGINT) AS n,
        max(greatest((lt + t) / CAST(n AS DOUBLE) - c, c - lt / CAST(n AS DOUBLE))) AS d FROM cdf {group})"""


_KS_P = """least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101), lambda k:
    (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * (sqrt(n) * d + 1 / (6 * sqrt(n))) ** 2)))))"""

def _histogram(select_bins, value="v"):
    return f"""CAST(least(floor(({value} - lo) / (hi - lo) * {select_bins}), {select_bins} - 1) AS BIGINT)"""


def _hypotheses() -> str:
    """The five questions as one union; each part keeps its own WITH."""
    def part(name, test, ctes, source, n, stat, p, decides, effect="CAST(NULL AS DOUBLE)", text="CAST(NULL AS VARCHAR)"):
        return (f"SELECT * FROM (WITH {ctes} SELECT '{name}' AS hypothesis, '{test}' AS test, CAST({n} AS BIGINT) AS n, "
                f"round({stat}, 6) AS statistic, round({p}, 6) AS p_value, round({effect}, 6) AS effect, {text} AS effect_label, "
                f"'ok' AS status, {decides} AS decides, CASE WHEN {p} < 0.05 THEN 'reject H0' ELSE 'do not reject H0' END AS verdict FROM {source})")
    urgent, low = f"'{URGENT}'", f"'{LOW}'"
    r = "(1 - 2.0 * u / (CAST(n1 AS DOUBLE) * n2))"
    z = "((greatest(u, n1 * n2 - u)) - n1 * n2 / 2.0 - 0.5) / sqrt(var)"
    zg = "(u - n1 * n2 / 2.0 - 0.5) / sqrt(var)"
    kr = _kruskal("discount", "channel").split(", ranked AS", 1)[1].rsplit("SELECT n, k AS n_groups", 1)[0]
    an = _anova("discount", "channel").split(", g AS", 1)[1].rsplit("SELECT n, n_groups", 1)[0]
    rho = "rho * sqrt((n - 2) / (1 - rho * rho))"
    parts = [
        part("app_over_web", "welch_t", _welch("sales", "amount", "channel", urgent, low)[0], "wt", "n1 + n2", "t",
             t_greater("t", "d"), "FALSE"),
        part("app_over_web", "mann_whitney", _mann_whitney("sales", "amount", "channel", urgent, low)[0], "s", "n1 + n2",
             "u", f"least(1.0, 1 - {phi(zg)})", "TRUE", r, label(r)),
        part("discount_moves_units", "slope", _line("sales", "units", "discount")[0], "rs", "n", "b / se",
             t_two_sided("b / se", "n - 2"), "TRUE"),
        part("gender_amount", "welch_t", _welch("sales", "amount", "gender", "'F'", "'O'")[0], "wt", "n1 + n2", "t",
             t_two_sided("t", "d"), "TRUE"),
        part("gender_amount", "mann_whitney", _mann_whitney("sales", "amount", "gender", "'F'", "'O'")[0], "s", "n1 + n2",
             "u", f"least(1.0, 2 * (1 - {phi(z)}))", "FALSE", r, label(r)),
        part("age_frequency", "spearman", f"""rk AS (SELECT {_avg_rank('age_years')} AS rx, {_avg_rank('frequency')} AS ry FROM counted),
            c AS (SELECT count(*) AS n, corr(rx, ry) AS rho FROM rk)""", "c", "n", "rho", t_two_sided(rho, "n - 2"), "TRUE"),
        part("discount_by_channel", "anova", "g AS" + an, "s", "n", "stat", f_upper("stat", "d1", "d2"), "FALSE"),
        part("discount_by_channel", "kruskal", "ranked AS" + kr, "e", "n", "stat", chi2_upper("stat", "k - 1"), "TRUE",
             "eta", label("eta", "eta2")),
    ]
    return f"""WITH {SALES}, freq AS (SELECT customer_id AS c, count(*) AS m FROM sales WHERE customer_id IS NOT NULL GROUP BY 1),
        counted AS (SELECT sales.*, coalesce(m, 1) AS frequency FROM sales LEFT JOIN freq ON customer_id = c)
        {' UNION ALL '.join(parts)}"""


def _study() -> str:
    """The study's figures, one union over the cleaned table (named sales, so that the pieces above read it)."""
    numeric = ["units", "discount", "amount", "amount_per_unit", "age_years", "frequency"]
    ranked, drawn = ["units", "discount", "amount", "age_years", "frequency"], ["discount", "amount", "age_years"]
    clean = f"""{SALES.replace("sales AS (", "raw AS (", 1)},
    freq AS (SELECT customer_id AS c, count(*) AS m FROM raw WHERE customer_id IS NOT NULL GROUP BY 1),
    aged AS (SELECT *, date_diff('day', born, shipped) / 365.25 AS a FROM raw),
    mid AS (SELECT coalesce(quantile_cont(a, 0.5), 35.0) AS mid FROM aged WHERE a BETWEEN 0 AND 110),
    sales AS (SELECT channel, store, units, least(greatest(coalesce(discount, 0.0), 0.0), 1.0) AS discount, amount, gender, row_key,
        amount / units AS amount_per_unit, CASE WHEN a BETWEEN 0 AND 110 THEN a ELSE mid END AS age_years, coalesce(m, 1) AS frequency
        FROM aged CROSS JOIN mid LEFT JOIN freq ON customer_id = c)"""

    def rows(section, label_, values, source, ctes="", where=""):
        lead = f"WITH {ctes} " if ctes else ""
        return " UNION ALL ".join(
            f"SELECT * FROM ({lead}SELECT '{section}' AS section, {label_} || ' {name}' AS metric, CAST(round({value}, {digits}) AS DOUBLE) AS value "
            f"FROM {source} {where})" for name, value, digits in values)

    def tail(sql, first):  # the CTEs of a piece that starts from sales
        return first + sql.split(f", {first}", 1)[1].rsplit("SELECT n, ", 1)[0]

    long = f"SELECT * FROM ({_melt(numeric, 'sales')})"
    moments = f"""SELECT "column" AS c, count(value) AS n, avg(value) AS mean, quantile_cont(value, 0.5) AS median, stddev_samp(value) AS std,
        stddev_pop(value) AS pop, min(value) AS min, max(value) AS max, skewness(value) AS skew, kurtosis(value) AS kurtosis FROM ({long}) GROUP BY 1"""
    parts = [
        rows("describe", "c", [(x, x, 5) for x in ("n", "mean", "median", "std", "min", "max", "skew", "kurtosis")], f"({moments})"),
        rows("scaling", "c", [("mean", "mean", 5), ("std", "pop", 5)], f"({moments})", where="WHERE c <> 'units'"),
        rows("outliers", "'amount'", [("n", "n", 6), ("n_outliers", "o", 6), ("outlier_rate", "o / CAST(n AS DOUBLE)", 6)],
             f"""(SELECT count(*) AS n, count(*) FILTER (amount < q1 - 1.5 * (q3 - q1) OR amount > q3 + 1.5 * (q3 - q1)) AS o
                 FROM sales CROSS JOIN ({_fences('sales', 'amount')}))"""),
        rows("unexpected", "'rows'", [("n", "count(*)", 0), ("n_rejected", f"count(*) FILTER (NOT (channel IN {CHANNELS} AND store BETWEEN {STORES[0]} AND {STORES[1]}))", 0)], "sales"),
    ]
    for c in drawn:
        parts.append(rows("kolmogorov", f"'{c}'", [("n", "n", 6), ("ks_d", "d", 6)], "ks", _ks("sales", c)))
    for section, columns in (("correlations", ranked), ("trio", ["units", "amount", "discount"])):
        parts += [rows(section, f"'{a} {b}'", [("rho", "corr(x, y)", 6)], f"(SELECT {_avg_rank(a)} AS x, {_avg_rank(b)} AS y FROM sales)")
                  for a in columns for b in columns if a < b]
    valid = f"channel IN {CHANNELS} AND store BETWEEN {STORES[0]} AND {STORES[1]}"
    parts.append(rows("channel_store", "'chi2'", [("statistic", "statistic", 6), ("df", "df", 6)], "tested",
                      _chi2(f"SELECT channel AS a, store AS b, count(*) AS n FROM sales WHERE {valid} GROUP BY ALL")))
    inside = "amount >= q1 - 1.5 * (q3 - q1) AND amount <= q3 + 1.5 * (q3 - q1)"
    parts.append(rows("boxplot", "channel", [("n", "n", 6), ("q1", "q1", 6), ("median", "q2", 6), ("q3", "q3", 6), ("whisker_low", "lo", 6),
                                             ("whisker_high", "hi", 6), ("n_fliers", "fl", 6)],
                      f"""(SELECT channel, count(*) AS n, any_value(q1) AS q1, any_value(q2) AS q2, any_value(q3) AS q3, min(amount) FILTER ({inside}) AS lo,
                          max(amount) FILTER ({inside}) AS hi, count(*) FILTER (NOT ({inside})) AS fl FROM sales JOIN (SELECT channel, quantile_cont(amount, 0.25) AS q1,
                          quantile_cont(amount, 0.5) AS q2, quantile_cont(amount, 0.75) AS q3 FROM sales GROUP BY channel) USING (channel) GROUP BY channel)"""))
    for factor in ("channel", "store"):
        parts.append(rows(f"anova by {factor}", "'amount'", [("n", "n", 5), ("statistic", "stat", 5)], "s", tail(_anova("amount", factor), "g AS")))
        parts.append(rows(f"kruskal by {factor}", "'amount'", [("n", "n", 5), ("statistic", "stat", 5)], "e", tail(_kruskal("amount", factor), "ranked AS")))
    urgent, low = f"'{URGENT}'", f"'{LOW}'"
    for name, column, one, two in (("app_over_web", "channel", urgent, low), ("gender_amount", "gender", "'F'", "'O'")):
        parts.append(rows("hypotheses", f"'{name} welch_t'", [("n", "n1 + n2", 4), ("statistic", "t", 4)], "wt", _welch("sales", "amount", column, one, two)[0]))
        parts.append(rows("hypotheses", f"'{name} mann_whitney'", [("n", "n1 + n2", 4), ("statistic", "u", 4)], "s",
                          _mann_whitney("sales", "amount", column, one, two)[0]))
    parts.append(rows("hypotheses", "'age_frequency spearman'", [("n", "count(*)", 4), ("statistic", "corr(x, y)", 4)],
                      f"(SELECT {_avg_rank('age_years')} AS x, {_avg_rank('frequency')} AS y FROM sales)"))
    parts.append(rows("hypotheses", "'discount_by_channel anova'", [("n", "n", 4), ("statistic", "stat", 4)], "s", tail(_anova("discount", "channel"), "g AS")))
    parts.append(rows("hypotheses", "'discount_by_channel kruskal'", [("n", "n", 4), ("statistic", "stat", 4)], "e",
                      tail(_kruskal("discount", "channel"), "ranked AS")))
    gone = "count(*) FILTER (raw.discount IS NULL)"  # birth dates are text that never lacks, only fails to be a date
    parts.append(rows("missing", "f", [("least", "least(d, b)", 0), ("most", "greatest(d, b)", 0)],
                      f"(SELECT 'channel' AS f, {gone} AS d, 0 AS b FROM raw UNION ALL SELECT 'store', 0, 0)"))
    for c in drawn:
        parts.append(rows(f"histogram {c}", "CAST(bin AS VARCHAR)", [("n", "coalesce(m, 0)", 0)], f"""(
            WITH lim AS (SELECT min({c}) AS lo, max({c}) AS hi, CAST(greatest(ceil(log2(count(*)) + 1), coalesce(ceil((max({c}) - min({c})) / nullif(2 *
                (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) / count(*) ** (1.0 / 3), 0)), 0)) AS BIGINT) AS k FROM sales),
            c AS (SELECT {_histogram('k', c)} AS bin, count(*) AS m FROM sales CROSS JOIN lim GROUP BY 1)
            SELECT b.bin, m FROM (SELECT unnest(range(0, k)) AS bin FROM lim) b LEFT JOIN c USING (bin))"""))
    fit = f"""r AS (SELECT *, row_number() OVER (ORDER BY {_digest()}) <= ceil(0.3 * count(*) OVER ()) AS is_test FROM sales),
        t AS (SELECT channel, avg(discount) AS mx, avg(amount) AS my FROM r WHERE NOT is_test GROUP BY 1),
        w AS (SELECT sum((discount - mx) * (amount - my)) / sum((discount - mx) * (discount - mx)) AS b FROM r JOIN t USING (channel) WHERE NOT is_test),
        e AS (SELECT is_test, amount, amount - (my + b * (discount - mx)) AS e FROM r JOIN t USING (channel) CROSS JOIN w)"""
    parts.append(rows("fit", "'train'", [("n", "count(*)", 6), ("r2", "1 - sum(e * e) / (var_pop(amount) * count(*))", 6)], "e", fit, "WHERE NOT is_test"))
    parts.append(rows("holdout", "'test'", [("n", "count(*)", 4), ("rmse", "sqrt(avg(e * e))", 4), ("mae", "avg(abs(e))", 4)], "e", fit, "WHERE is_test"))
    return f"WITH {clean} " + " UNION ALL ".join(parts)


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    disc = "least(greatest(coalesce(discount, 0.0), 0.0), 1.0)"
    q["clean_derive"] = f"""WITH {SALES} SELECT row_key, round({disc}, 6) AS discount,
        round(amount / nullif(units, 0), 8) AS amount_per_unit,
        round(date_diff('day', born, shipped) / 365.25, 6) AS age_from_text FROM sales"""
    fixed = """valid AS (SELECT coalesce(quantile_cont(age_years, 0.5), 35.0) AS med FROM sales WHERE age_years BETWEEN 0 AND 110),
        fixed AS (SELECT row_key, CASE WHEN age_years BETWEEN 0 AND 110 THEN age_years ELSE med END AS age,
            age_years NOT BETWEEN 0 AND 110 AS bad, med FROM sales CROSS JOIN valid)"""
    q["invalid_range_impute"] = f"""WITH {SALES}, {fixed} SELECT round(min(age), 6) AS min_age, round(max(age), 6) AS max_age,
        round(avg(age), 6) AS mean_age, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS n_invalid,
        round(any_value(med), 6) AS median_age FROM fixed"""
    q["invalid_range_count"] = f"""WITH {SALES}, {fixed} SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS n_invalid FROM fixed"""
    q["imputed_rows"] = f"WITH {SALES}, {fixed} SELECT row_key, round(age, 6) AS age_years FROM fixed"
    cols = "round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS low, round(q3 + 1.5 * (q3 - q1), 6) AS high, n_values"
    q["iqr_fences"] = f"WITH {LINES}, f AS ({_fences('lines', 'amount')}) SELECT {cols} FROM f"
    q["iqr_fences_by_channel"] = f"WITH {SALES}, f AS ({_fences('sales', 'amount', 'channel')}) SELECT channel, {cols} FROM f"
    unit = f"{LINES}, u AS (SELECT *, amount / nullif(units, 0) AS unit FROM lines)"
    out = "unit < q1 - 1.5 * (q3 - q1) OR unit > q3 + 1.5 * (q3 - q1)"
    q["outlier_flag_summary"] = f"""WITH {unit}, f AS ({_fences('u', 'unit')}) SELECT CAST(count(*) AS BIGINT) AS n,
        CAST(count(*) FILTER (WHERE {out}) AS BIGINT) AS n_outliers,
        round(count(*) FILTER (WHERE {out}) / CAST(count(*) AS DOUBLE), 6) AS outlier_rate FROM u CROSS JOIN f"""
    q["outlier_flag_by_group"] = f"""WITH {unit}, f AS ({_fences('u', 'unit', 'flag')}) SELECT flag, CAST(count(*) AS BIGINT) AS n,
        CAST(count(*) FILTER (WHERE {out}) AS BIGINT) AS n_outliers FROM u JOIN f USING (flag) GROUP BY flag"""
    numeric = ["units", "discount", "amount", "age_years"]
    q["zscore_params"] = f"""WITH {SALES}, long AS ({_melt(numeric, 'sales')}) SELECT "column", round(avg(value), 6) AS mean,
        round(stddev_pop(value), 6) AS std FROM long GROUP BY 1"""
    z = ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}_scaled" for c in ("units", "discount", "amount"))
    q["zscore_rows"] = f"WITH {LINES} SELECT row_key, {z} FROM lines"
    chan = ", ".join(f"'{c}'" for c in CHANNELS)
    q["whitelist_reject_count"] = f"""WITH {SALES} SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE NOT
        (channel IN ({chan}) AND store BETWEEN {STORES[0]} AND {STORES[1]})) AS BIGINT) AS n_rejected FROM sales"""
    nulls = " UNION ALL ".join(f"""SELECT '{c}' AS "column", CAST(count(*) AS BIGINT) AS n, CAST(count(*) - count({c}) AS BIGINT) AS n_null,
        round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 6) AS null_rate FROM sales""" for c in ("discount", "customer_id", "amount"))
    q["null_rates"] = f"WITH {SALES} {nulls}"
    q["customer_frequency"] = f"""WITH {SALES}, k AS (SELECT customer_id AS c, count(*) AS m FROM sales WHERE customer_id IS NOT NULL GROUP BY 1)
        SELECT row_key, customer_id, CAST(coalesce(m, 1) AS BIGINT) AS frequency FROM sales LEFT JOIN k ON customer_id = c"""
    q["distinct_customers"] = f"WITH {SALES} SELECT CAST(count(DISTINCT customer_id) AS BIGINT) AS n_keys FROM sales"
    q["group_sizes"] = f"WITH {SALES} SELECT channel, store, CAST(count(*) AS BIGINT) AS n FROM sales GROUP BY ALL"
    q["contingency_long"] = f"WITH {SALES} SELECT channel, segment, CAST(count(*) AS BIGINT) AS n FROM sales GROUP BY ALL"
    q["contingency_wide"] = f"""WITH {SALES} SELECT channel, CAST(count(*) FILTER (WHERE gender = 'F') AS BIGINT) AS n_f,
        CAST(count(*) FILTER (WHERE gender = 'O') AS BIGINT) AS n_o FROM sales GROUP BY channel"""
    q["describe_population"] = f"""WITH {SALES}, long AS ({_melt(numeric, 'sales')}), moments AS (SELECT "column" AS c, avg(value) AS m FROM long GROUP BY 1),
        p AS (SELECT "column", count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max,
            avg((value - m) ** 2) AS m2, avg((value - m) ** 3) AS m3, avg((value - m) ** 4) AS m4 FROM long JOIN moments ON "column" = c GROUP BY 1)
        SELECT "column", CAST(n AS BIGINT) AS n, round(mean, 5) AS mean, round(std, 5) AS std, round(min, 5) AS min, round(max, 5) AS max,
            round(m3 / m2 ** 1.5, 5) AS skew, round(m4 / (m2 * m2) - 3, 5) AS kurtosis FROM p"""
    q["describe_sample"] = _describe_full(numeric)
    q["describe_by_segment"] = _describe_full(["amount", "age_years"], "segment")
    points = {"p01": 0.01, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p999": 0.999}
    q["quantiles_exact"] = f"""WITH {LINES} SELECT {', '.join(f'round(quantile_cont(amount, {p}), 6) AS {n}' for n, p in points.items())},
        CAST(count(amount) AS BIGINT) AS n_values FROM lines"""
    q["quantiles_by_store"] = f"""WITH {LINES} SELECT store, round(quantile_cont(amount, 0.25), 6) AS p25, round(quantile_cont(amount, 0.5), 6) AS p50,
        round(quantile_cont(amount, 0.75), 6) AS p75, CAST(count(amount) AS BIGINT) AS n_values FROM lines GROUP BY store"""
    q["group_summary"] = f"""WITH {SALES} SELECT channel, gender, CAST(count(amount) AS BIGINT) AS n, round(avg(amount), 5) AS mean,
        round(quantile_cont(amount, 0.5), 5) AS median FROM sales GROUP BY ALL"""
    q["avg_rank_ties"] = f"""WITH {LINES}, r AS (SELECT amount AS value, {_avg_rank('amount')} AS rk FROM lines WHERE amount IS NOT NULL)
        SELECT value, CAST(count(*) AS BIGINT) AS n, any_value(rk) AS avg_rank, CAST(count(*) AS DOUBLE) ** 3 - count(*) AS tie_term FROM r GROUP BY value"""
    q["avg_rank_ties_by_flag"] = f"""WITH {LINES}, r AS (SELECT flag, discount AS value, {_avg_rank('discount', 'flag')} AS rk FROM lines WHERE discount IS NOT NULL)
        SELECT flag, value, CAST(count(*) AS BIGINT) AS n, any_value(rk) AS avg_rank, CAST(count(*) AS DOUBLE) ** 3 - count(*) AS tie_term FROM r GROUP BY ALL"""
    q["daily_series_filled"] = f"WITH {SERIES} SELECT day, pos, round(value, 2) AS value FROM series"
    q["daily_series_by_status"] = """WITH daily AS (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS v FROM orders GROUP BY ALL),
        span AS (SELECT o_orderstatus, min(day) AS a, max(day) AS b FROM daily GROUP BY 1),
        spine AS (SELECT o_orderstatus, a, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span)
        SELECT o_orderstatus, day, CAST(date_diff('day', a, day) AS BIGINT) AS pos, round(coalesce(v, 0.0), 2) AS value
        FROM spine LEFT JOIN daily USING (o_orderstatus, day)"""
    q["seasonal_decompose_7"] = f"""WITH {SERIES}, t AS (SELECT *, CASE WHEN count(*) OVER w = 7 THEN avg(value) OVER w END AS trend, pos % 7 AS phase
            FROM series WINDOW w AS (ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
        p AS (SELECT phase, avg(value - trend) AS m FROM t GROUP BY phase),
        s AS (SELECT phase, m - avg(m) OVER () AS seasonal FROM p)
        SELECT day, pos, round(value, 2) AS value, round(trend, 2) AS trend, round(seasonal, 2) AS seasonal,
            round(value - trend - seasonal, 2) AS residual FROM t JOIN s USING (phase)"""
    acf = f"""{SERIES}, d AS (SELECT pos, value - avg(value) OVER () AS d FROM series), v AS (SELECT sum(d * d) AS s0, count(*) AS n FROM d),
        lags AS (SELECT unnest(range(0, 31)) AS k),
        r AS (SELECT k, sum(a.d * b.d) / any_value(s0) AS acf, any_value(n) AS n FROM lags JOIN d a ON TRUE JOIN d b ON b.pos = a.pos + k CROSS JOIN v GROUP BY k)"""
    q["acf_30"] = f"""WITH {acf} SELECT CAST(k AS BIGINT) AS lag, CAST(n AS BIGINT) AS n, round(acf, 6) AS acf,
        round(CASE WHEN k = 0 THEN 0.0 ELSE 1.959963984540054 * sqrt((1 + 2 * coalesce(sum(CASE WHEN k > 0 THEN acf * acf END)
            OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END, 6) AS band FROM r"""
    # Durbin's recursion over lists: phi_k,k = (r_k - sum phi_j r_{{k-j}}) / (1 - sum phi_j r_j)
    q["pacf_30"] = f"""WITH RECURSIVE {acf}, rs AS (SELECT list(acf ORDER BY k) AS r, CAST(any_value(n) AS BIGINT) AS n FROM r),
        rec AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS DOUBLE[]) AS ph, CAST(1.0 AS DOUBLE) AS last, r, n FROM rs
            UNION ALL
            SELECT k + 1, list_append(list_transform(range(1, k + 1), lambda j: ph[j] - nxt * ph[k + 1 - j]), nxt), nxt, r, n
            FROM (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: ph[j] * r[k + 2 - j])), 0.0))
                / (1 - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: ph[j] * r[j + 1])), 0.0)) AS nxt FROM rec WHERE k < 30))
        SELECT k AS lag, n, round(last, 6) AS pacf, round(CASE WHEN k > 0 THEN 1.959963984540054 / sqrt(n) ELSE 0.0 END, 6) AS band FROM rec"""
    q["event_calendar_status"] = f"WITH {FLAGGED} SELECT name, day, in_range FROM calendar"
    q["event_window_flag"] = f"WITH {FLAGGED} SELECT day, pos, round(value, 2) AS value, is_special FROM flagged"
    mw, columns = _mann_whitney("valid_days", "value", "is_special", "TRUE", "FALSE")
    columns = columns.replace("n1, n2, round(u, 6) AS statistic", "n1 AS n_special, n2 AS n_normal, round(u, 4) AS statistic")
    columns = columns.replace(", 6) AS", ", 4) AS")
    q["event_impact"] = f"""WITH {FLAGGED}, valid_days AS (SELECT day, round(value, 6) AS value, is_special FROM flagged WHERE day >= DATE '{SERIES_START}'),
        {mw}, sides AS (SELECT avg(value) FILTER (WHERE is_special) AS a, avg(value) FILTER (WHERE NOT is_special) AS b,
            quantile_cont(value, 0.5) FILTER (WHERE is_special) AS c, quantile_cont(value, 0.5) FILTER (WHERE NOT is_special) AS d FROM valid_days)
        SELECT round(a, 4) AS mean_special, round(b, 4) AS mean_normal, round(c, 4) AS median_special, round(d, 4) AS median_normal,
            {columns} FROM s CROSS JOIN sides"""
    mw, columns = _mann_whitney("valid_days", "value", "is_special", "TRUE", "FALSE", "s")
    columns = columns.replace(", 6) AS", ", 4) AS").replace("n1, n2,", "n1 AS n_special, n2 AS n_normal,")
    mw = mw[:-1] if mw.endswith(",") else mw
    q["event_impact_by_status"] = f"""WITH daily AS (SELECT o_orderstatus AS s, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2),
        span AS (SELECT s, min(day) AS a, max(day) AS b FROM daily GROUP BY s),
        spine AS (SELECT s, a, b, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span), {EVENT_ROWS},
        flagged AS (SELECT spine.s, spine.day, coalesce(v, 0.0) AS value, EXISTS (SELECT 1 FROM events_ e WHERE e.day BETWEEN a AND b
            AND spine.day BETWEEN e.day - 7 AND e.day + 7) AS is_special FROM spine LEFT JOIN daily USING (s, day)),
        valid_days AS (SELECT s, day, round(value, 6) AS value, is_special FROM flagged WHERE day >= DATE '{SERIES_START}'),
        {mw.replace("s AS (SELECT f.*", "st AS (SELECT f.*")}, sides AS (SELECT s, avg(value) FILTER (WHERE is_special) AS a, avg(value) FILTER (WHERE NOT is_special) AS b,
            quantile_cont(value, 0.5) FILTER (WHERE is_special) AS c, quantile_cont(value, 0.5) FILTER (WHERE NOT is_special) AS d FROM valid_days GROUP BY s)
        SELECT s AS o_orderstatus, round(a, 4) AS mean_special, round(b, 4) AS mean_normal, round(c, 4) AS median_special, round(d, 4) AS median_normal,
            {columns.removeprefix("s, ")} FROM st JOIN sides USING (s)"""
    q["chi2_independence"] = f"""WITH {SALES}, {_chi2("SELECT channel AS a, store AS b, count(*) AS n FROM sales GROUP BY ALL")}
        SELECT {_chi2_columns()} FROM tested"""
    q["chi2_yates_by_segment"] = f"""WITH {SALES}, {_chi2("SELECT segment, gender AS a, amount < 30000 AS b, count(*) AS n FROM sales GROUP BY ALL", "segment")}
        SELECT {_chi2_columns('segment')} FROM tested"""
    long = " UNION ALL ".join(f"SELECT '{f}' AS factor, CAST({f} AS VARCHAR) AS a, customer_id IS NULL AS b FROM sales" for f in ("channel", "store"))
    q["missingness_chi2"] = f"""WITH {SALES}, {_chi2(f"SELECT factor, a, b, count(*) AS n FROM ({long}) GROUP BY ALL", "factor")},
        m AS (SELECT factor, CAST(sum(n) FILTER (WHERE b) AS BIGINT) AS n_null FROM cells GROUP BY factor)
        SELECT {_chi2_columns('factor')}, n_null, round(n_null / CAST(n AS DOUBLE), 6) AS null_rate,
            CASE WHEN {chi2_upper('statistic', 'df')} < 0.05 THEN 'MAR' ELSE 'MCAR' END AS mechanism FROM tested JOIN m USING (factor)"""
    long = " UNION ALL ".join(f"SELECT segment || '|{f}' AS k, CAST({f} AS VARCHAR) AS a, customer_id IS NULL AS b FROM sales" for f in ("channel", "gender"))
    q["missingness_by_segment"] = f"""WITH {SALES}, {_chi2(f"SELECT k, a, b, count(*) AS n FROM ({long}) GROUP BY ALL", "k")},
        m AS (SELECT k, CAST(sum(n) FILTER (WHERE b) AS BIGINT) AS n_null FROM cells GROUP BY k),
        o AS (SELECT {_chi2_columns('k')}, n_null, round(n_null / CAST(n AS DOUBLE), 6) AS null_rate,
            CASE WHEN {chi2_upper('statistic', 'df')} < 0.05 THEN 'MAR' ELSE 'MCAR' END AS mechanism FROM tested JOIN m USING (k))
        SELECT split_part(k, '|', 1) AS segment, split_part(k, '|', 2) AS factor, o.* EXCLUDE (k) FROM o"""
    three = ["units", "discount", "amount"]
    t3 = "CAST(rho AS DOUBLE) * sqrt((n - 2) / (1 - CAST(rho AS DOUBLE) * CAST(rho AS DOUBLE)))"
    pairs3 = " UNION ALL ".join(f"SELECT flag, '{a}' AS a, '{b}' AS b, count(*) AS n, {'1.0' if a == b else f'corr(k_{a}, k_{b})'} AS rho FROM k GROUP BY flag"
                                for a in three for b in three)
    q["spearman_matrix_by_flag"] = f"""WITH {LINES}, k AS (SELECT flag, {', '.join(f"{_avg_rank(v, 'flag')} AS k_{v}" for v in three)} FROM lines WHERE discount IS NOT NULL),
        l AS ({pairs3}), p AS (SELECT *, CASE WHEN a <> b THEN {t_two_sided(t3, 'n - 2')} END AS p FROM l)
        SELECT flag, a, b, n, round(CAST(rho AS DOUBLE), 6) AS rho, CASE WHEN a = b THEN '' WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**'
            WHEN p < 0.05 THEN '*' ELSE ' ns' END AS stars FROM p"""
    q["spearman_pair"] = _spearman("amount", "age_years")
    q["spearman_by_segment"] = _spearman("units", "discount", "segment")
    vs = ["constant", "units", "discount", "amount"]
    pairs = []
    for a in vs:
        for b in vs:
            if a == b:
                pairs.append(f"SELECT '{a}' AS a, '{b}' AS b, n, 1.0 AS rho, 0.0 AS p FROM c")
            elif "constant" in (a, b):
                pairs.append(f"SELECT '{a}' AS a, '{b}' AS b, n, CAST(NULL AS DOUBLE) AS rho, CAST(NULL AS DOUBLE) AS p FROM c")
            else:
                lo, hi = sorted((a, b))
                t = f"r_{lo}_{hi} * sqrt((n - 2) / (1 - r_{lo}_{hi} * r_{lo}_{hi}))"
                pairs.append(f"SELECT '{a}' AS a, '{b}' AS b, n, r_{lo}_{hi} AS rho, {t_two_sided(t, 'n - 2')} AS p FROM c")
    real = sorted(vs[1:])
    corrs = ", ".join(f"corr(k_{a}, k_{b}) AS r_{a}_{b}" for a in real for b in real if a < b)
    q["spearman_matrix"] = f"""WITH {SALES}, k AS (SELECT {', '.join(f'{_avg_rank(v)} AS k_{v}' for v in real)} FROM sales WHERE discount IS NOT NULL),
        c AS (SELECT CAST(count(*) AS BIGINT) AS n, {corrs} FROM k), l AS ({' UNION ALL '.join(pairs)})
        SELECT a, b, n, round(CAST(rho AS DOUBLE), 6) AS rho, round(CAST(p AS DOUBLE), 6) AS p_value, CASE WHEN a = b OR p IS NULL THEN '' WHEN p < 0.001 THEN '***'
            WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE ' ns' END AS stars FROM l"""
    q["anova_oneway"] = _anova("amount", "store")
    q["anova_by_segment"] = _anova("amount", "channel", "segment")
    q["kruskal_wallis"] = _kruskal("amount", "store")
    q["kruskal_by_segment"] = _kruskal("discount", "channel", "segment")
    mw, columns = _mann_whitney("sales", "amount", "channel", f"'{URGENT}'", f"'{LOW}'", greater=True)
    q["mann_whitney"] = f"WITH {SALES}, {mw} SELECT {columns} FROM s"
    mw, columns = _mann_whitney("sales", "discount", "gender", "'F'", "'O'", "segment")
    q["mann_whitney_by_segment"] = f"WITH {SALES}, {mw} SELECT {columns} FROM s"
    w, columns = _welch("sales", "amount", "channel", f"'{URGENT}'", f"'{LOW}'", greater=True)
    q["welch_t"] = f"WITH {SALES}, {w} SELECT {columns} FROM wt"
    w, columns = _welch("lines", "amount", "gender", "'F'", "'O'", "store")
    q["welch_t_by_store"] = f"WITH {LINES}, {w} SELECT {columns} FROM wt"
    r, columns = _line("sales", "units", "discount")
    q["simple_regression"] = f"WITH {SALES}, {r} SELECT {columns} FROM rs"
    r, columns = _line("lines", "amount", "units", "store", 4)
    q["simple_regression_by_store"] = f"WITH {LINES}, {r} SELECT {columns} FROM rs"
    q["shapiro"] = f"WITH {LINES}, {_shapiro('lines', 'amount', 5000)} SELECT n, round(w, 6) AS statistic, 'ok' AS status, round({_shapiro_p()}, 6) AS p_value, (SELECT count(amount) FROM lines) AS n_total FROM w"
    q["shapiro_by_flag"] = f"""WITH {LINES}, {_shapiro('lines', 'discount', 1000, 'flag')}
        SELECT flag, n, round(w, 6) AS statistic, 'ok' AS status, round({_shapiro_p()}, 6) AS p_value,
            (SELECT count(discount) FROM lines WHERE lines.flag = w.flag) AS n_total FROM w"""
    q["ks_normal"] = f"WITH {LINES}, {_ks('lines', 'amount')} SELECT n, round(d, 6) AS statistic, 'ok' AS status, round({_KS_P}, 6) AS p_value FROM ks"
    q["ks_normal_by_flag"] = f"WITH {LINES}, {_ks('lines', 'units', 'flag')} SELECT flag, n, round(d, 6) AS statistic, 'ok' AS status, round({_KS_P}, 6) AS p_value FROM ks"
    sample = f"picked_rows AS (SELECT * FROM lines ORDER BY {_digest()} LIMIT 5000)"
    long3 = " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS value, row_key FROM picked_rows" for c in ("units", "discount", "amount"))
    q["normality_report"] = f"""WITH {LINES}, {sample}, long AS ({long3}), whole AS ({long3.replace('picked_rows', 'lines')}), {_shapiro('long', 'value', 5000, 'col')}, {_ks('whole', 'value', 'col')},
        both_ AS (SELECT col, ks.n, w.n AS n_sampled, w, d, {_shapiro_p('w', 'w.n')} AS wp, {_KS_P.replace('sqrt(n)', 'sqrt(ks.n)')} AS dp FROM w JOIN ks USING (col))
        SELECT col AS "column", n, n_sampled, round(w, 6) AS shapiro_w, round(wp, 6) AS shapiro_p, 'ok' AS status, round(d, 6) AS ks_d, round(dp, 6) AS ks_p,
            CASE WHEN least(wp, dp) < 0.05 THEN 'not normal' ELSE 'compatible with normal' END AS verdict FROM both_"""
    q["one_hot_counts"] = f"""WITH {SALES}, c AS (SELECT channel, count(*) AS n FROM sales GROUP BY channel)
        SELECT 'channel_' || channel AS dummy, CAST(n AS BIGINT) AS n FROM c
        WHERE channel <> (SELECT channel FROM c ORDER BY n DESC, channel LIMIT 1)"""
    terms = """terms AS (SELECT 'const' AS term, y0 - b * x0 AS coef, sqrt(s2 * (1.0 / n0 + x0 * x0 / sxx)) AS se, n FROM model CROSS JOIN g0
        UNION ALL SELECT 'units', b, sqrt(s2 / sxx), n FROM model
        UNION ALL SELECT 'flag_' || flag, (my - b * mx) - (y0 - b * x0), sqrt(s2 * (1.0 / ng + 1.0 / n0 + (mx - x0) * (mx - x0) / sxx)), n
            FROM gm CROSS JOIN g0 CROSS JOIN model WHERE flag <> 'N')"""
    # 97.5% t quantile by the Cornish-Fisher expansion in 1/df
    zq = "1.959963984540054"
    tq = (f"({zq} + ({zq} ** 3 + {zq}) / (4 * d) + (5 * {zq} ** 5 + 16 * {zq} ** 3 + 3 * {zq}) / (96 * d * d)"
          f" + (3 * {zq} ** 7 + 19 * {zq} ** 5 + 17 * {zq} ** 3 - 15 * {zq}) / (384 * d * d * d))")
    q["ols_coefficients"] = f"""{MODEL}, {terms}, td AS (SELECT *, CAST(n - 4 AS DOUBLE) AS d FROM terms)
        SELECT term, round(coef, 5) AS coef, round(se, 5) AS std_err, round(coef / se, 5) AS statistic,
            round({t_two_sided('least(abs(coef / se), 30)', 'd')}, 5) AS p_value,
            round(coef - se * {tq}, 5) AS ci_low, round(coef + se * {tq}, 5) AS ci_high, 'ok' AS status FROM td"""
    q["ols_fit"] = f"""{MODEL} SELECT CAST(n AS BIGINT) AS n, CAST(3 AS BIGINT) AS rank, CAST(n - 4 AS BIGINT) AS df_resid, round(1 - rss / tss, 8) AS r2,
        round(1 - rss / tss * (n - 1) / (n - 4), 8) AS r2_adj, round(s2, 1) AS sigma2, 'ok' AS status FROM model"""
    # two predictors: normal equations solved by Cramer's rule
    q["ols_by_store"] = f"""WITH {LINES}, c AS (SELECT store, count(*) AS n, avg(units) AS m1, avg(discount) AS m2, avg(amount) AS my,
            var_pop(units) * count(*) AS s11, var_pop(discount) * count(*) AS s22, covar_pop(units, discount) * count(*) AS s12,
            covar_pop(units, amount) * count(*) AS s1y, covar_pop(discount, amount) * count(*) AS s2y, var_pop(amount) * count(*) AS syy
            FROM lines WHERE discount IS NOT NULL GROUP BY store),
        s AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2,
            s11 * s22 - s12 * s12 AS det FROM c),
        e AS (SELECT *, (syy - b1 * s1y - b2 * s2y) / (n - 3) AS s2 FROM s),
        t AS (SELECT store, n, 'const' AS term, my - b1 * m1 - b2 * m2 AS coef,
                sqrt(s2 * (1.0 / n + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / det)) AS se FROM e
            UNION ALL SELECT store, n, 'units', b1, sqrt(s2 * s22 / det) FROM e
            UNION ALL SELECT store, n, 'discount', b2, sqrt(s2 * s11 / det) FROM e),
        d AS (SELECT *, CAST(n - 3 AS DOUBLE) AS d FROM t)
        SELECT store, term, round(coef, 3) AS coef, round(se, 3) AS std_err, round(coef / se, 3) AS statistic,
            round({t_two_sided('coef / se', 'd')}, 3) AS p_value, round(coef - se * {tq}, 3) AS ci_low,
            round(coef + se * {tq}, 3) AS ci_high, 'ok' AS status FROM d"""
    q["ols_diagnostics_by_store"] = f"""WITH {LINES}, r AS (SELECT *, {_digest()} < '4ccccccd' AS is_test FROM lines WHERE discount IS NOT NULL),
        c AS (SELECT store, avg(units) AS m1, avg(discount) AS m2, avg(amount) AS my, count(*) AS n, corr(units, discount) AS rho,
            var_pop(units) * count(*) AS s11, var_pop(discount) * count(*) AS s22, covar_pop(units, discount) * count(*) AS s12,
            covar_pop(units, amount) * count(*) AS s1y, covar_pop(discount, amount) * count(*) AS s2y FROM r WHERE NOT is_test GROUP BY store),
        s AS (SELECT *, s11 * s22 - s12 * s12 AS det, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
            (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM c),
        f AS (SELECT r.*, amount - (my + b1 * (units - m1) + b2 * (discount - m2)) AS e FROM r JOIN s USING (store)),
        l AS (SELECT *, lag(e) OVER (PARTITION BY store ORDER BY row_key) AS before FROM f WHERE NOT is_test),
        a AS (SELECT store, sum((e - before) * (e - before)) / sum(e * e) AS durbin_watson, covar_pop(units, e * e) * count(*) AS s1e,
            covar_pop(discount, e * e) * count(*) AS s2e, var_pop(e * e) * count(*) AS see FROM l GROUP BY store),
        b AS (SELECT store, n, durbin_watson, 1 / (1 - rho * rho) AS vif,
            n * (s1e * (s1e * s22 - s2e * s12) + s2e * (s2e * s11 - s1e * s12)) / det / see AS bp FROM a JOIN s USING (store)),
        h AS (SELECT store, count(*) AS n_test, avg(e * e) AS mse, avg(abs(e)) AS mae, var_pop(amount) AS v FROM f WHERE is_test GROUP BY store)
        SELECT store, CAST(n AS BIGINT) AS n, round(bp, 4) AS bp, round(exp(-bp / 2), 5) AS bp_p, CAST(2 AS BIGINT) AS bp_df,
            round(durbin_watson, 5) AS durbin_watson, round(vif, 5) AS vif, CAST(2 AS BIGINT) AS n_vif, CAST(n_test AS BIGINT) AS n_test,
            round(sqrt(mse), 3) AS rmse, round(mae, 3) AS mae, round(1 - mse / v, 4) AS r2_test FROM b LEFT JOIN h USING (store)"""
    r, _ = _line("lines", "amount", "units")
    q["ols_collinear"] = f"""WITH {LINES}, {r}, m AS (SELECT avg(units) AS mx FROM lines),
        t AS (SELECT 'const' AS term, a AS coef, se * sqrt(sxx * (1.0 / n + mx * mx / sxx)) AS se, CAST(n - 2 AS DOUBLE) AS d FROM rs CROSS JOIN m
            UNION ALL SELECT 'units', b, se, CAST(n - 2 AS DOUBLE) FROM rs)
        SELECT term, round(coef, 5) AS coef, round(se, 5) AS std_err, round(coef / se, 5) AS statistic,
            round({t_two_sided('least(abs(coef / se), 30)', 'd')}, 5) AS p_value, round(coef - se * {tq}, 5) AS ci_low, round(coef + se * {tq}, 5) AS ci_high, 'ok' AS status FROM t
        UNION ALL SELECT unnest(['twice', 'one']), NULL, NULL, NULL, NULL, NULL, NULL, 'constant or collinear'"""
    q["split_sizes"] = f"WITH {LINES} SELECT {_digest()} < '4ccccccd' AS is_test, CAST(count(*) AS BIGINT) AS n FROM lines GROUP BY 1"
    q["split_sizes_exact"] = f"""WITH {LINES}, r AS (SELECT amount, row_number() OVER (ORDER BY {_digest()}) AS i, count(*) OVER () AS n FROM lines)
        SELECT i <= ceil(0.3 * n) AS is_test, CAST(count(*) AS BIGINT) AS n, round(sum(amount), 2) AS total FROM r GROUP BY 1"""
    q["ols_holdout"] = f"""{SPLIT_MODEL}, held AS (SELECT amount AS y, my + b * (units - mx) AS p FROM fitsource JOIN gm USING (flag) CROSS JOIN model WHERE is_test)
        SELECT CAST(count(*) AS BIGINT) AS n, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae,
            round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2 FROM held"""
    q["breusch_pagan"] = f"""{FITTED}, e AS (SELECT flag, x, residual * residual AS y FROM fitted),
        em AS (SELECT flag, avg(x) AS ex, avg(y) AS ey FROM e GROUP BY flag),
        ew AS (SELECT sum((x - ex) * (x - ex)) AS sxx, sum((x - ex) * (y - ey)) AS sxy, sum((y - ey) * (y - ey)) AS syy, count(*) AS n FROM e JOIN em USING (flag)),
        et AS (SELECT var_pop(y) * count(*) AS tss FROM e),
        bp AS (SELECT n, n * (1 - (syy - sxy * sxy / sxx) / tss) AS lm FROM ew CROSS JOIN et)
        SELECT CAST(n AS BIGINT) AS n, round(lm, 4) AS statistic, CAST(3 AS BIGINT) AS df, 'ok' AS status, round({chi2_upper('lm', '3')}, 4) AS p_value FROM bp"""
    q["durbin_watson"] = f"""{FITTED}, l AS (SELECT residual, lag(residual) OVER (ORDER BY row_key) AS before FROM fitted)
        SELECT CAST(count(*) AS BIGINT) AS n, round(sum((residual - before) * (residual - before)) / sum(residual * residual), 6) AS durbin_watson FROM l"""
    q["vif"] = f"""WITH {LINES}, c AS (SELECT corr(units, amount) AS r FROM lines)
        SELECT CAST(position AS BIGINT) AS position, term, round(1 / (1 - r * r), 6) AS vif, 'ok' AS status
        FROM c CROSS JOIN (VALUES (1, 'units'), (2, 'amount')) t(position, term)"""
    q["residual_shapiro"] = f"""{FITTED}, {_shapiro('fitted', 'residual', 5000)} SELECT n, round(w, 5) AS statistic, 'ok' AS status, round({_shapiro_p()}, 5) AS p_value, (SELECT count(*) FROM fitted) AS n_total FROM w"""
    q["qq_points"] = f"""{FITTED}, v AS (SELECT round(residual, 6) AS e FROM fitted),
        r AS (SELECT row_number() OVER (ORDER BY e) AS k, count(*) OVER () AS n, (e - avg(e) OVER ()) / stddev_pop(e) OVER () AS z FROM v),
        g AS (SELECT unnest(range(1, 201)) AS point), d AS (SELECT point, (point - 0.5) / 200 AS p, z
            FROM g JOIN r ON k = ((2 * point - 1) * n + 399) // 400)
        SELECT CAST(point AS BIGINT) AS point, round({ppf('p')}, 5) AS theoretical, round(z, 5) AS sample FROM d"""
    q["seeded_sample"] = f"WITH {LINES} SELECT row_key, amount FROM lines ORDER BY {_digest()} LIMIT 500"
    q["seeded_sample_by_flag"] = f"""WITH {LINES}, r AS (SELECT flag, row_key, amount, row_number() OVER (PARTITION BY flag ORDER BY {_digest()}) AS i FROM lines)
        SELECT flag, row_key, amount FROM r WHERE i <= 200"""
    q["head_sample"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000"
    hist = """b AS (SELECT {slot} AS bin, count(*) AS n FROM src CROSS JOIN lim GROUP BY 1),
        grid AS (SELECT unnest(range(0, CAST((SELECT k FROM lim) AS BIGINT))) AS bin)"""
    hist_cols = """CAST(bin AS BIGINT) AS bin, round(lo + bin * (hi - lo) / k, {d}) AS low, round(lo + (bin + 1) * (hi - lo) / k, {d}) AS high,
        CAST(coalesce(n, 0) AS BIGINT) AS n, round(coalesce(n, 0) / (total * ((hi - lo) / k)), {d}) AS density FROM grid LEFT JOIN b USING (bin) CROSS JOIN lim"""
    q["hist_density"] = f"""WITH {LINES}, src AS (SELECT amount AS v FROM lines), lim AS (SELECT min(v) AS lo, max(v) AS hi, count(v) AS total, 40 AS k FROM src),
        {hist.format(slot=_histogram('k'))} SELECT {hist_cols.format(d=10)}"""
    q["hist_auto_bins"] = f"""WITH {SALES}, src AS (SELECT age_years AS v FROM sales), lim0 AS (SELECT min(v) AS lo, max(v) AS hi, count(v) AS total,
            quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM src),
        lim AS (SELECT *, greatest(ceil(log2(total) + 1), ceil((hi - lo) / (2 * iqr / total ** (1.0 / 3.0)))) AS k FROM lim0),
        {hist.format(slot=_histogram('k'))} SELECT {hist_cols.format(d=8)}"""
    q["kde_curve"] = f"""WITH {LINES}, src AS (SELECT amount AS v FROM lines), lim AS (SELECT min(v) AS lo, max(v) AS hi, count(v) AS total,
            stddev_samp(v) * count(v) ** (-0.2) AS h FROM src),
        grid AS (SELECT point, lo + point * (hi - lo) / 99 AS x FROM lim CROSS JOIN (SELECT unnest(range(0, 100)) AS point))
        SELECT CAST(point AS BIGINT) AS point, round(any_value(x), 9) AS x,
            round(any_value(hi - lo) * sum(exp(-0.5 * ((x - v) / h) * ((x - v) / h)) / sqrt(2 * {PI}) / (total * h)), 6) AS scaled_density
        FROM grid CROSS JOIN src CROSS JOIN lim GROUP BY point"""
    inside = "unit >= q1 - 1.5 * (q3 - q1) AND unit <= q3 + 1.5 * (q3 - q1)"
    q["boxplot_stats"] = f"""WITH {unit}, f AS (SELECT flag, quantile_cont(unit, 0.25) AS q1, quantile_cont(unit, 0.5) AS q2, quantile_cont(unit, 0.75) AS q3 FROM u GROUP BY flag)
        SELECT flag, CAST(count(unit) AS BIGINT) AS n, round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
            round(min(unit) FILTER (WHERE {inside}), 6) AS whisker_low, round(max(unit) FILTER (WHERE {inside}), 6) AS whisker_high,
            CAST(count(*) FILTER (WHERE NOT ({inside})) AS BIGINT) AS n_fliers FROM u JOIN f USING (flag) GROUP BY flag"""
    q["residual_bins"] = f"""{FITTED}, src AS (SELECT residual AS v FROM fitted), lim AS (SELECT min(v) AS lo, max(v) AS hi, 50 AS k FROM src),
        {hist.format(slot=_histogram('k'))} SELECT CAST(bin AS BIGINT) AS bin, CAST(coalesce(n, 0) AS BIGINT) AS n FROM grid LEFT JOIN b USING (bin)"""
    q["residual_vs_fitted"] = f"""{FITTED}, lx AS (SELECT min(predicted) AS lo, max(predicted) AS hi FROM fitted), ly AS (SELECT min(residual) AS lo2, max(residual) AS hi2 FROM fitted)
        SELECT CAST(least(floor((predicted - lo) / (hi - lo) * 20), 19) AS BIGINT) AS x_bin,
            CAST(least(floor((residual - lo2) / (hi2 - lo2) * 20), 19) AS BIGINT) AS y_bin, CAST(count(*) AS BIGINT) AS n
        FROM fitted CROSS JOIN lx CROSS JOIN ly GROUP BY 1, 2"""
    metrics = lambda col, factor="": f"""SELECT unnest(['row_count', 'mean', 'min', 'max', 'store_count']) AS metric,
        unnest([CAST(count(*) AS DOUBLE), avg({col}{factor}), min({col}{factor}), max({col}{factor}), CAST(count(DISTINCT store) AS DOUBLE)]) AS value FROM lines"""  # noqa: E731
    q["reconcile_metrics"] = f"""WITH {LINES}, a AS (SELECT * FROM ({metrics('amount')}) WHERE metric <> 'max'),
        x AS (SELECT metric, CASE WHEN metric = 'store_count' THEN value + 1 ELSE value END AS value, metric IN ('row_count', 'store_count') AS is_count
            FROM ({metrics('amount', ' * 1.0005')}))
        SELECT x.metric, round(x.value, 6) AS expected, round(a.value, 6) AS actual, round(abs(a.value - x.value) / greatest(abs(x.value), 1e-10), 6) AS relative_error,
            CASE WHEN a.metric IS NULL THEN 'MISSING' WHEN is_count AND floor(a.value) = floor(x.value) THEN 'PASS'
                WHEN NOT is_count AND abs(a.value - x.value) / greatest(abs(x.value), 1e-10) < 0.001 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM x LEFT JOIN a ON x.metric = a.metric"""
    q["determinism_diff"] = f"""WITH {LINES}, a AS (SELECT * FROM ({metrics('amount')}) WHERE metric <> 'min'), b AS ({metrics('units')})
        SELECT coalesce(a.metric, b.metric) AS metric, round(a.value, 6) AS value_a, round(b.value, 6) AS value_b, round(abs(a.value - b.value), 6) AS difference,
            CASE WHEN a.metric IS NULL OR b.metric IS NULL THEN 'MISSING_IN_ONE' WHEN a.value = b.value OR abs(a.value - b.value) < 1e-12 THEN 'IDENTICAL' ELSE 'DIFFERS' END AS status
        FROM a FULL OUTER JOIN b ON a.metric = b.metric"""
    q["hypothesis_report"] = _hypotheses()
    gap = "gap AS (SELECT * REPLACE (nullif(flag, 'R') AS flag) FROM lines)"
    q["seeded_sample_null_group"] = f"""WITH {LINES}, {gap}, r AS (SELECT flag, row_key, amount,
            row_number() OVER (PARTITION BY flag ORDER BY {_digest()}) AS i FROM gap)
        SELECT flag, row_key, amount FROM r WHERE i <= 200"""
    q["outlier_flag_null_group"] = f"""WITH {LINES}, u AS (SELECT coalesce(nullif(flag, 'R'), '') AS flag, amount / units AS unit FROM lines),
        f AS ({_fences('u', 'unit', 'flag')}) SELECT nullif(flag, '') AS flag, CAST(count(*) AS BIGINT) AS n,
        CAST(count(*) FILTER (WHERE {out}) AS BIGINT) AS n_outliers FROM u JOIN f USING (flag) GROUP BY flag"""
    q["one_hot_unlisted"] = f"""WITH {LINES}, {gap} SELECT flag, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE flag = 'N') AS BIGINT) AS n_known,
        CASE WHEN flag = 'N' THEN CAST(count(*) AS DOUBLE) END AS n_hot FROM gap GROUP BY flag"""
    w, columns = _welch("lines7", "units", "gender", "'F'", "'O'")
    q["welch_constant_sample"] = f"""WITH {LINES}, lines7 AS (SELECT * REPLACE (CASE WHEN gender = 'F' THEN 25.0 ELSE units END AS units) FROM lines),
        {w} SELECT {columns} FROM wt"""
    q["typed_text_rows"] = """WITH t AS (SELECT l_returnflag AS part, l_orderkey % 7 AS k, l_orderkey % 11 = 0 AS broken, l_quantity, l_suppkey FROM lineitem),
        b AS (SELECT *, concat_ws('+', CASE WHEN k IN (0, 3) THEN 'UNIDADES' END, CASE WHEN broken THEN 'malformed row' END) AS why FROM t)
        SELECT part, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE k <> 1) AS BIGINT) AS n_units,
            CAST(sum(l_quantity) FILTER (WHERE k <> 1) AS BIGINT) AS units, CAST(sum(l_suppkey) AS BIGINT) AS stores
        FROM b WHERE why = '' GROUP BY part
        UNION ALL SELECT why, CAST(count(*) AS BIGINT), NULL, NULL, NULL FROM b WHERE why <> '' GROUP BY why"""
    q["quantiles_rank_error"] = "SELECT unnest(['p25', 'p50', 'p75']) AS quantile, true AS within"

    trio = ["units", "discount", "amount"]
    pairs = ", ".join(f"corr(k_{a}, k_{b}) AS r_{a}_{b}" for a, b in (("units", "discount"), ("units", "amount"), ("discount", "amount")))
    cells = []
    for i, a in enumerate(trio):
        for j, b in enumerate(trio):
            r = "r_" + "_".join([a, b] if i < j else [b, a])
            t = f"{r} * sqrt((n - 2) / (1 - {r} * {r}))"
            cells.append(f"SELECT '{a}' AS a, '{b}' AS b, 1.0 AS rho, 0.0 AS p FROM c" if a == b else
                         f"SELECT '{a}' AS a, '{b}' AS b, {r} AS rho, {t_two_sided(t, 'n - 2')} AS p FROM c")
    q["spearman_cells"] = f"""WITH {LINES}, k AS (SELECT {', '.join(f'{_avg_rank(v)} AS k_{v}' for v in trio)} FROM lines WHERE discount IS NOT NULL),
        c AS (SELECT CAST(count(*) AS BIGINT) AS n, {pairs} FROM k), l AS ({' UNION ALL '.join(cells)})
        SELECT a, b, CASE WHEN a = b THEN '1.0' ELSE printf('%.3f', rho) || CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**'
            WHEN p < 0.05 THEN '*' ELSE ' ns' END END AS cell FROM l"""
    kept = ["age_years", "amount", "amount_per_unit", "channel", "discount", "flag", "frequency", "gender", "is_outlier", "row_key",
            "segment", "shipped", "store", "ts", "units"]
    q["clean_columns"] = f"""WITH {SALES} SELECT "column", n FROM (SELECT unnest({kept}) AS "column"), (SELECT CAST(count(*) AS BIGINT) AS n FROM sales)"""

    def long(section, name, metric, values):
        return " UNION ALL ".join(
            f"SELECT '{section}' AS section, {metric} || ' {v}' AS metric, CAST({v} AS DOUBLE) AS value FROM ({q[name]})" for v in values)

    q["regression_report"] = " UNION ALL ".join(part.replace(MODEL, SPLIT_MODEL) for part in [  # fitted on the training rows
        long("coefficients", "ols_coefficients", "term", ["coef", "std_err"]),
        long("fit", "ols_fit", "'train'", ["n", "r2", "r2_adj"]),
        long("holdout", "ols_holdout", "'test'", ["n", "rmse", "mae", "r2"]),
        long("durbin_watson", "durbin_watson", "'train'", ["n", "durbin_watson"]),
        long("breusch_pagan", "breusch_pagan", "'train'", ["statistic", "df"]),
        long("residual_shapiro", "residual_shapiro", "'sample'", ["n", "n_total", "statistic"])])
    q["association_report"] = " UNION ALL ".join([
        long("channel_store", "chi2_independence", "'chi2'", ["statistic", "df"]),
        long("store_anova", "anova_oneway", "'anova'", ["statistic"]),
        long("store_kruskal", "kruskal_wallis", "'kruskal'", ["statistic"])])
    q["temporal_report"] = " UNION ALL ".join([
        long("daily_series", "daily_series_filled", "strftime(day, '%Y-%m-%d')", ["value"]),
        long("acf", "acf_30", "CAST(lag AS VARCHAR)", ["acf"]), long("pacf", "pacf_30", "CAST(lag AS VARCHAR)", ["pacf"])])
    q["study_summary"] = _study()
    summary = """SELECT l_returnflag AS CANAL, count(*) AS n, count(*) FILTER (l_linenumber % 5 <> 0) AS n_units,
        CAST(sum(CAST(l_quantity AS INTEGER)) FILTER (l_linenumber % 5 <> 0) AS BIGINT) AS units, count(*) FILTER (l_discount > 0) AS n_discount,
        round(sum(l_discount) FILTER (l_discount > 0), 4) AS discount, CAST(sum(l_suppkey) AS BIGINT) AS stores,
        strftime(max(l_shipdate), '%Y-%m-%d') AS latest, 'a;"' || l_returnflag AS product"""
    q["text_scan_blocks"] = f"{summary}, 'GENERO' AS missing FROM lineitem GROUP BY l_returnflag"
    q["gzip_landing_and_sink"] = f"{summary}, TRUE AS kept, (SELECT count(*) FROM lineitem) AS all_rows FROM lineitem GROUP BY l_returnflag"
    q["seed_from_environment"] = f"""WITH {LINES}, s AS (SELECT row_key FROM lines ORDER BY {_digest()} LIMIT 100)
        SELECT unnest(['explicit', 'environment', 'no number']) AS "case", row_key FROM s"""
    quarters = "(VALUES ('p25'), ('p50'), ('p75')) q(quantile)"
    q["quantiles_approximate"] = f"""WITH {LINES} SELECT store, quantile, n, TRUE AS within
        FROM (SELECT store, count(amount) AS n FROM lines GROUP BY store) CROSS JOIN {quarters}"""
    q["quantiles_sketch_rollup"] = f"""WITH {LINES}, c AS (SELECT coalesce(flag, 'all') AS flag, count(amount) AS n FROM lines GROUP BY ROLLUP (flag))
        SELECT flag, quantile, n, TRUE AS within FROM c CROSS JOIN (VALUES ('p10'), ('p50'), ('p90'), ('p99')) q(quantile)"""
    q["distinct_customers_rollup"] = f"""WITH {SALES} SELECT coalesce(channel, 'all') AS channel, CAST(grouping(channel) AS INTEGER) AS level,
        count(DISTINCT customer_id) AS n_exact, TRUE AS within FROM sales GROUP BY ROLLUP (channel)"""
    def francia(value, by=""):
        lead, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
        group = f"GROUP BY {by}" if by else ""
        u, v = "ln(n)", "ln(ln(n))"
        z = f"((ln(1 - w) - (-1.2725 + 1.0521 * ({v} - {u}))) / (1.0308 - 0.26758 * ({v} + 2 / {u})))"
        return f"""WITH {LINES}, o AS (SELECT {lead}{value} AS x, row_number() OVER ({part} ORDER BY {value}) AS i, count(*) OVER ({part}) AS n
            FROM lines WHERE {value} IS NOT NULL),
            m AS (SELECT *, {ppf('(i - 0.375) / (n + 0.25)')} AS m FROM o),
            w AS (SELECT {lead}CAST(count(*) AS BIGINT) AS n, corr(x, m) ** 2 AS w FROM m {group})
            SELECT {lead}n, round(w, 6) AS statistic, 'ok' AS status, round(1 - {phi(z)}, 6) AS p_value FROM w"""
    q["shapiro_francia"], q["shapiro_francia_by_flag"] = francia("amount"), francia("units", "flag")
    # the same plane through (units, discount in cents), where nothing is nearly dependent
    q["ols_illconditioned"] = f"""WITH {LINES}, r AS (SELECT amount AS y, units AS u, round(discount * 100) AS d FROM lines WHERE discount IS NOT NULL),
        c AS (SELECT count(*) AS n, avg(u) AS mu, avg(d) AS md, avg(y) AS my, var_pop(u) * count(*) AS suu, var_pop(d) * count(*) AS sdd,
            covar_pop(u, d) * count(*) AS sud, covar_pop(u, y) * count(*) AS suy, covar_pop(d, y) * count(*) AS sdy, var_pop(y) * count(*) AS syy FROM r),
        b AS (SELECT *, suu * sdd - sud * sud AS det, (suy * sdd - sdy * sud) / (suu * sdd - sud * sud) AS bu,
            (sdy * suu - suy * sud) / (suu * sdd - sud * sud) AS bd FROM c),
        s AS (SELECT *, (syy - bu * suy - bd * sdy) / (n - 3) AS s2 FROM b),
        t AS (SELECT 'const' AS term, my - bu * mu - bd * md AS coef,
                sqrt(s2 * (1.0 / n + (mu * mu * sdd - 2 * mu * md * sud + md * md * suu) / det)) AS se, n, 'ok' AS m FROM s
            UNION ALL SELECT 'units', bu / 1e7 - bd, sqrt(s2 / det * (sdd / 1e14 + suu + 2 * sud / 1e7)), n, 'ok' FROM s
            UNION ALL SELECT 'nearly', bd, sqrt(s2 * suu / det), n, 'constant or collinear' FROM s)
        SELECT term, CAST(n AS BIGINT) AS n, round(coef, 2) AS coef, round(se, 2) AS std_err, 'ok' AS status, m AS by_moments FROM t"""
    spans = "spans(a, b) AS (VALUES " + ", ".join(f"(DATE '{a}', DATE '{b}')" for _, a, b in SPANS) + ")"
    q["event_interval_flag"] = f"""WITH {SERIES}, {spans} SELECT day, pos, round(value, 2) AS value,
        EXISTS (SELECT 1 FROM spans WHERE series.day BETWEEN spans.a AND spans.b) AS is_special FROM series"""
    q["order_spans_by_status"] = """WITH daily AS (SELECT o_orderstatus AS s, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2),
        spine AS (SELECT s, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT s, min(day) AS a, max(day) AS b FROM daily GROUP BY s)),
        spans AS (SELECT o_orderstatus AS s, CAST(o_orderdate AS DATE) AS a, CAST(max(l_shipdate) AS DATE) AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey
            WHERE o_totalprice > 400000 GROUP BY o_orderkey, o_orderstatus, o_orderdate)
        SELECT spine.s AS o_orderstatus, spine.day, round(coalesce(v, 0.0), 2) AS value,
            EXISTS (SELECT 1 FROM spans WHERE spans.s = spine.s AND spine.day BETWEEN a AND b) AS is_special FROM spine LEFT JOIN daily USING (s, day)"""
    z = "((greatest(u, n1 * n2 - u)) - n1 * n2 / 2.0 - 0.5) / sqrt(var)"
    exact = "ties = 0 AND n1 > 0 AND n2 > 0 AND n1 + n2 <= 40"
    # subsets of the ranks 1..i by size and rank sum, one rank at a time
    q["mann_whitney_exact_by_store"] = f"""WITH RECURSIVE {LINES}, src AS (SELECT store, strftime(l_shipdate, '%Y-%m') AS month, amount,
            coalesce(discount, 0.0) > 0.055 AS high FROM lines WHERE amount IS NOT NULL),
        ranked AS (SELECT *, {_avg_rank('amount', 'store, month')} AS rk, count(*) OVER (PARTITION BY store, month, amount) AS t FROM src),
        f AS (SELECT store, month, CAST(count(*) FILTER (high) AS BIGINT) AS n1, CAST(count(*) FILTER (NOT high) AS BIGINT) AS n2,
            coalesce(sum(rk) FILTER (high), 0) AS r1, sum(CAST(t AS DOUBLE) * t - 1) AS ties FROM ranked GROUP BY store, month),
        s AS (SELECT *, CASE WHEN n1 > 0 AND n2 > 0 THEN r1 - n1 * (n1 + 1) / 2.0 END AS u,
            CASE WHEN n1 + n2 > 1 THEN n1 * n2 / 12.0 * ((n1 + n2 + 1) - ties / (CAST(n1 + n2 AS DOUBLE) * (n1 + n2 - 1))) END AS var FROM f),
        top AS (SELECT coalesce(max(n1 + n2), 0) AS n, coalesce(max(n1), 0) AS k FROM s WHERE {exact}),
        ways(i, k, r, c) AS (SELECT 0, 0, 0, 1::DOUBLE UNION ALL
            SELECT i + 1, ways.k + b, r + b * (i + 1), sum(c) FROM ways CROSS JOIN top CROSS JOIN (VALUES (0), (1)) v(b)
            WHERE i < top.n AND ways.k + b <= top.k GROUP BY 1, 2, 3),
        tails AS (SELECT store, month, sum(c) FILTER (r <= r1) / sum(c) AS low, sum(c) FILTER (r >= r1) / sum(c) AS high
            FROM s JOIN ways ON i = n1 + n2 AND ways.k = n1 WHERE {exact} GROUP BY store, month, r1)
        SELECT store, month, n1, n2, round(u, 6) AS statistic,
            CASE WHEN n1 = 0 OR n2 = 0 THEN NULL WHEN {exact} THEN round(least(1.0, 2 * least(low, high)), 6)
                 WHEN var > 0 THEN round(least(1.0, 2 * (1 - {phi(z)})), 6) END AS p_value,
            CASE WHEN {exact} THEN 'exact' ELSE 'normal' END AS method,
            CASE WHEN n1 = 0 OR n2 = 0 THEN 'too few rows' WHEN {exact} OR var > 0 THEN 'ok' ELSE 'degenerate' END AS status
        FROM s LEFT JOIN tails USING (store, month)"""
    return q
