"""DuckDB SQL giving the expected result of every query, on views named like the tables."""

from __future__ import annotations

LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"

# (name, label column, SQL condition) of the thirteen rules, in order.
RULES = [
    ("o_orderdate >= 1996-01-01", "o_orderdate", "o_orderdate >= TIMESTAMP '1996-01-01'"),
    ("o_orderdate < 2001-01-01", "o_orderdate", "o_orderdate < TIMESTAMP '2001-01-01'"),
    ("l_shipdate >= 1996-01-01", "l_shipdate", "l_shipdate >= TIMESTAMP '1996-01-01'"),
    ("l_shipdate < 2001-01-01", "l_shipdate", "l_shipdate < TIMESTAMP '2001-01-01'"),
    ("o_orderdate < l_shipdate", "order_ship", "o_orderdate < l_shipdate"),
    ("l_linenumber between 1 and 6", "l_linenumber", "l_linenumber BETWEEN 1 AND 6"),
    ("l_returnflag in ('A', 'R')", "l_returnflag", "l_returnflag IN ('A', 'R')"),
    ("o_orderstatus in ('F', 'O')", "o_orderstatus", "o_orderstatus IN ('F', 'O')"),
    (
        "l_discount in list",
        "l_discount",
        "COALESCE(l_discount, 0e0) IN (0e0, 0.02::DOUBLE, 0.04::DOUBLE, 0.05::DOUBLE, 0.06::DOUBLE, 0.08::DOUBLE, 0.1::DOUBLE)",
    ),
    ("l_quantity > 2.0", "l_quantity", "l_quantity > 2"),
    (
        "shifted l_extendedprice > 0",
        "l_extendedprice",
        "(CASE WHEN l_tax >= 0.05::DOUBLE THEN l_extendedprice - 2500 ELSE l_extendedprice END) > 0",
    ),
    ("o_totalprice >= 10000.0", "o_totalprice", "o_totalprice >= 10000"),
    (
        "low priority without high discount",
        "priority_discount",
        "NOT (o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') AND l_discount > 0.08::DOUBLE)",
    ),
]


def pct(part: str, total: str) -> str:
    return f"CASE WHEN ({total}) = 0 THEN 0e0 ELSE CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE) * 100e0 END"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# --- rules ---------------------------------------------------------------------------------------------------------

ALL_RULES = " AND ".join(f"({condition})" for _, _, condition in RULES)
FAIL_FLAGS = ", ".join(f"CASE WHEN {condition} THEN 0 ELSE 1 END AS f{k}" for k, (_, _, condition) in enumerate(RULES))
FAIL_SUM = " + ".join(f"f{k}" for k in range(len(RULES)))
FLAGGED = f"flags AS (SELECT {FAIL_FLAGS} FROM {LINES}), summed AS (SELECT *, {FAIL_SUM} AS fails FROM flags)"


def rule_rows() -> str:
    parts = [
        f"""SELECT {k} AS rule_index, {text(name)} AS rule_name, {text(column)} AS column_name,
            COUNT(*) FILTER (f{k} = 1) AS invalid_count, COUNT(*) FILTER (f{k} = 1 AND fails = 1) AS exclusive_removed_count,
            COUNT(*) AS raw_count FROM summed"""
        for k, (name, column, _) in enumerate(RULES)
    ]
    shared = "(invalid_count - exclusive_removed_count)"
    return f"""WITH {FLAGGED}, per_rule AS ({' UNION ALL '.join(parts)})
        SELECT rule_index, rule_name, column_name, invalid_count, exclusive_removed_count,
            {shared} AS shared_removed_count,
            {pct('invalid_count', 'raw_count')} AS invalid_percentage,
            {pct('exclusive_removed_count', 'raw_count')} AS exclusive_removed_percentage,
            {pct(shared, 'raw_count')} AS shared_removed_percentage
        FROM per_rule"""


TRIP_COLUMNS = (
    "l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_shipdate, o_orderdate, "
    "o_orderstatus, o_orderpriority, o_totalprice"
)

# --- profiles ------------------------------------------------------------------------------------------------------

CHART_QUANTILE = "0.990099009901"


def stats_sql(name: str, column: str) -> str:
    """Numeric statistics of one column as a one-row SELECT."""
    value = f"CASE WHEN NOT isnan({column}::DOUBLE) THEN {column}::DOUBLE END"
    return f"""SELECT '{column}' AS column_name, MIN(v) AS min_value, MAX(v) AS max_value,
        COUNT(*) FILTER (v < 0) AS negative_count, COUNT(*) FILTER (v = 0) AS zero_count,
        COUNT(*) AS total_rows, quantile_cont(v, {CHART_QUANTILE}) FILTER (v > 0) AS chart_max
        FROM (SELECT {value} AS v FROM {name})"""


def summary_sql(name: str, column: str) -> str:
    return f"""SELECT s.column_name, s.min_value, s.negative_count, s.zero_count, s.chart_max AS chart_max_value,
        (SELECT COUNT(*) FROM {name} WHERE {column}::DOUBLE > s.chart_max AND NOT isnan({column}::DOUBLE))
            AS above_chart_max_value_count,
        s.max_value, CAST(CASE WHEN s.chart_max IS NULL THEN 2 ELSE 102 END AS BIGINT) AS range_count, s.total_rows
        FROM ({stats_sql(name, column)}) s"""


def bins_sql(name: str, column: str, upper: str, count: int, total: str) -> str:
    """Bins of one column; ``upper`` and ``total`` are scalar SQL."""
    return f"""SELECT '{column}' AS column_name, CAST(i AS INTEGER) AS bucket, i * (u / {count}) AS bin_edge,
            COALESCE(n, 0) AS bin_count, {pct('COALESCE(n, 0)', 't')} AS bin_percentage
        FROM (SELECT CAST({upper} AS DOUBLE) AS u, {total} AS t) p, range(1, {count + 1}) r(i)
        LEFT JOIN (
            SELECT LEAST({count}, GREATEST(1, CAST(CEIL({column} / q.u * {count}) AS INTEGER))) AS b, COUNT(*) AS n
            FROM {name}, (SELECT CAST({upper} AS DOUBLE) AS u) q WHERE {column} > 0 AND {column} <= q.u GROUP BY 1
        ) c ON c.b = i"""


def chart_max_sql(name: str, column: str) -> str:
    return f"(SELECT chart_max FROM ({stats_sql(name, column)}))"


def total_sql(name: str) -> str:
    return f"(SELECT COUNT(*) FROM {name})"


NUMBER = "regexp_replace(printf('%.2f', ROUND({}, 2)), '\\.?0+$', '')"


def range_label(left: str, right: str) -> str:
    return f"printf('(%.2f, %.2f]', ROUND({left}, 2), ROUND({right}, 2))"


def labeled_bin_rows(name: str, column: str) -> str:
    left = "(bucket - 1) * (bin_edge / bucket)"
    bins = bins_sql(name, column, chart_max_sql(name, column), 100, total_sql(name))
    return f"""SELECT column_name, bucket AS row_order, {range_label(left, 'bin_edge')} AS label, bin_count AS count,
        bin_percentage AS percent FROM ({bins})"""


def labeled_sql(name: str, column: str) -> str:
    summary = f"({summary_sql(name, column)})"
    low, chart, high = (NUMBER.format(x) for x in ("min_value", "chart_max_value", "max_value"))
    return f"""SELECT column_name, -2 AS row_order, '[' || {low} || ', 0)' AS label, negative_count AS count,
            {pct('negative_count', 'total_rows')} AS percent FROM {summary} WHERE NOT (negative_count = 0 AND min_value >= 0)
        UNION ALL SELECT column_name, -1, '0', zero_count, {pct('zero_count', 'total_rows')} FROM {summary}
        UNION ALL SELECT column_name, 0, '(' || {chart} || ', ' || {high} || ']', above_chart_max_value_count,
            {pct('above_chart_max_value_count', 'total_rows')} FROM {summary}
        UNION ALL {labeled_bin_rows(name, column)}"""


def chart_sql(name: str, column: str) -> str:
    summary = f"({summary_sql(name, column)})"
    zero = pct("zero_count", "total_rows")
    return f"""SELECT column_name, 0 AS row_order, '0' AS label, zero_count AS count, {zero} AS percent FROM {summary}
            WHERE NOT (range_count > 15 AND {zero} > 50)
        UNION ALL SELECT column_name, CAST(range_count AS INTEGER), {NUMBER.format('max_value')},
            above_chart_max_value_count, {pct('above_chart_max_value_count', 'total_rows')} FROM {summary}
        UNION ALL {labeled_bin_rows(name, column)}"""


TABLE_COLUMNS = {
    "lineitem": (
        "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus"
        " l_shipdate"
    ).split(),
    "events": "event_id ts user_id event_type value props".split(),
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice".split(),
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split(),
}


def distinct_rows(names: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, {k} AS column_index, '{column}' AS column_name,
            (SELECT COUNT(*) FROM (SELECT DISTINCT {column} FROM {name} LIMIT 301)) AS unique_count"""
        for name in names
        for k, column in enumerate(TABLE_COLUMNS[name])
    )


def value_count_rows() -> str:
    parts = []
    for column in TABLE_COLUMNS["lineitem"]:
        numeric = column not in ("l_returnflag", "l_linestatus", "l_shipdate")
        number = f"CAST({column} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"""SELECT '{column}' AS column_name, {number} AS numeric_value, CAST({column} AS VARCHAR) AS value, COUNT(*) AS n
            FROM lineitem GROUP BY {column}
            HAVING (SELECT COUNT(*) FROM (SELECT DISTINCT {column} FROM lineitem LIMIT 301)) <= 300"""
        )
    return f"""SELECT column_name, numeric_value, value, n AS count, {pct('n', total_sql('lineitem'))} AS percentage
        FROM ({' UNION ALL '.join(parts)})"""


def other_bucket_sql(name: str, column: str, numeric: bool, shown: str) -> str:
    number = f"CAST({column} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
    return f"""(WITH counted AS (
            SELECT CAST({column} AS VARCHAR) AS value, {number} AS num, COUNT(*) AS count,
                ROUND({pct('COUNT(*)', total_sql(name))}, 2) AS percent FROM {name} GROUP BY {column}),
        flagged AS (SELECT *, ({shown}) AND ((SELECT COUNT(*) FROM counted) <= 20 OR percent > 0) AS shown FROM counted)
        SELECT '{column}' AS column_name, COALESCE(value, 'null') AS label, count, percent,
            CASE WHEN value IS NULL THEN 2 WHEN num IS NULL THEN 1 ELSE 0 END AS row_kind FROM flagged WHERE shown
        UNION ALL SELECT '{column}', printf('Other (%d values)', COUNT(*)), CAST(SUM(count) AS BIGINT),
            ROUND(SUM(percent), 5), 3 FROM flagged WHERE NOT shown HAVING COUNT(*) > 0)"""


def validity_rows(name: str, casts: list[tuple[str, str, str]]) -> str:
    """(column, DuckDB type, reported type) rows."""
    return " UNION ALL ".join(
        f"""SELECT '{column}' AS column_name, '{reported}' AS data_type, COUNT(TRY_CAST({column} AS {kind})) AS valid_count,
            ROUND({pct(f'COUNT(TRY_CAST({column} AS {kind}))', 'COUNT(*)')}, 2) AS valid_type_percent FROM {name}"""
        for column, kind, reported in casts
    )


MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def month_rows() -> str:
    year = "o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'"
    return " UNION ALL ".join(
        f"""SELECT 'o_orderdate' AS column_name, {m} AS month, '{label}' AS month_label,
            COUNT(*) FILTER ({year} AND EXTRACT(MONTH FROM o_orderdate) = {m}) AS month_count,
            {pct(f'COUNT(*) FILTER ({year} AND EXTRACT(MONTH FROM o_orderdate) = {m})', 'COUNT(*)')} AS month_percentage
        FROM orders"""
        for m, label in enumerate(MONTHS, start=1)
    )


def profile_sql() -> str:
    kinds = {
        "o_orderkey": "BIGINT",
        "o_custkey": "BIGINT",
        "o_orderstatus": "STRING",
        "o_totalprice": "DOUBLE",
        "o_orderdate": "TIMESTAMP_NTZ",
        "o_orderpriority": "STRING",
    }
    parts = []
    for k, (column, kind) in enumerate(kinds.items()):
        base = f"""(SELECT {k} AS column_index, '{column}' AS column_name, '{kind}' AS data_type,
            (SELECT COUNT(*) FROM (SELECT DISTINCT {column} FROM orders LIMIT 301)) AS unique_count,
            ROUND({pct(f'COUNT({column})', 'COUNT(*)')}, 2) AS valid_type_percent FROM orders) f"""
        group = "CASE WHEN f.unique_count <= 300 THEN 'low' ELSE 'high' END AS column_group"
        if kind in ("BIGINT", "DOUBLE"):
            extra = f"LEFT JOIN ({summary_sql('orders', column)}) s ON f.unique_count > 300"
            numbers = """s.min_value, s.negative_count, s.zero_count, ROUND(s.chart_max_value, 6) AS chart_max_value, s.above_chart_max_value_count,
                s.max_value, s.range_count"""
        else:
            extra = ""
            numbers = ", ".join(
                f"CAST(NULL AS {kind}) AS {name}"
                for name, kind in (
                    ("min_value", "DOUBLE"),
                    ("negative_count", "BIGINT"),
                    ("zero_count", "BIGINT"),
                    ("chart_max_value", "DOUBLE"),
                    ("above_chart_max_value_count", "BIGINT"),
                    ("max_value", "DOUBLE"),
                    ("range_count", "BIGINT"),
                )
            )
        if kind == "TIMESTAMP_NTZ":
            extra += f""" LEFT JOIN (SELECT MIN({column}) AS first_time, MAX({column}) AS last_time,
                COUNT(*) FILTER ({column} < TIMESTAMP '1998-01-01') AS before_year_count,
                COUNT(*) FILTER ({column} >= TIMESTAMP '1999-01-01') AS after_year_count FROM orders) d
                ON f.unique_count > 300"""
            dates = "d.first_time, d.last_time, d.before_year_count, d.after_year_count"
        else:
            dates = """CAST(NULL AS TIMESTAMP) AS first_time, CAST(NULL AS TIMESTAMP) AS last_time,
                CAST(NULL AS BIGINT) AS before_year_count, CAST(NULL AS BIGINT) AS after_year_count"""
        parts.append(f"SELECT f.*, {group}, {numbers}, {dates} FROM {base} {extra}")
    return " UNION ALL ".join(parts)


# --- trim ----------------------------------------------------------------------------------------------------------


def trim_ctes(sources: list[tuple[str, str]]) -> str:
    """CTEs of the two-pass trim as a recursive query; ``steps`` holds every state, ``final`` the last per column."""
    values = " UNION ALL ".join(
        f"SELECT '{column}' AS column_name, CAST({column} AS DOUBLE) AS v FROM {name}" for name, column in sources
    )
    return f"""RECURSIVE vals AS ({values}),
    freq AS (SELECT column_name, v, COUNT(*) AS w FROM vals WHERE v > 0 AND NOT isnan(v) GROUP BY ALL),
    stats AS (
        SELECT column_name, COALESCE(MAX(v) FILTER (v > 0 AND NOT isnan(v)), 1e0) AS max_value,
            COUNT(*) FILTER (v = 0) AS zero_count, COUNT(*) AS total_rows FROM vals GROUP BY column_name),
    steps AS (
        SELECT column_name, 0 AS step, 1 AS pass, max_value AS m, CAST(NULL AS DOUBLE) AS p1,
            total_rows - zero_count AS nz FROM stats
        UNION ALL
        SELECT column_name, step + 1, CASE WHEN stop THEN pass + 1 ELSE pass END, CASE WHEN stop THEN m ELSE edge END,
            CASE WHEN stop AND pass = 1 THEN m ELSE p1 END, nz
        FROM (
            SELECT *, (nz <= 0 OR last_share >= t OR ABS(m - edge) <= 1e-12) AS stop
            FROM (
                SELECT column_name, step, pass, m, p1, nz, t, COALESCE(MAX(share) FILTER (b = bins), 0e0) AS last_share,
                    COALESCE(MAX(b) FILTER (share >= t), 1) * (m / bins) AS edge
                FROM (
                    SELECT column_name, step, pass, m, p1, nz, bins, t, b, CAST(SUM(w) AS DOUBLE) / nz * 100 AS share
                    FROM (
                        SELECT s.*, k.bins, k.t, f.w,
                            LEAST(k.bins, GREATEST(1, CAST(CEIL(f.v / s.m * k.bins) AS INTEGER))) AS b
                        FROM steps s JOIN (VALUES (1, 100, 0.05::DOUBLE), (2, 10, 0.5::DOUBLE)) k(no, bins, t)
                            ON k.no = s.pass
                        LEFT JOIN freq f ON f.column_name = s.column_name AND f.v <= s.m
                    ) GROUP BY column_name, step, pass, m, p1, nz, bins, t, b
                ) GROUP BY column_name, step, pass, m, p1, nz, bins, t
            )
        )
    ),
    final AS (
        SELECT s.column_name, t.max_value, s.p1, s.m, t.zero_count, t.total_rows
        FROM steps s JOIN stats t USING (column_name) WHERE s.pass = 3)"""


TRIM_SOURCES = [("events", "value"), ("documents", "n_chars"), ("lineitem", "l_extendedprice"), ("lineitem", "l_quantity")]


def final_bins() -> str:
    return f"""WITH {trim_ctes(TRIM_SOURCES)},
        counted AS (
            SELECT f.column_name, LEAST(10, GREATEST(1, CAST(CEIL(q.v / f.m * 10) AS INTEGER))) AS b,
                CAST(SUM(q.w) AS BIGINT) AS n
            FROM final f JOIN freq q ON q.column_name = f.column_name AND q.v <= f.m GROUP BY ALL)
        SELECT f.column_name, CAST(i AS INTEGER) AS bucket, i * (f.m / 10) AS bin_edge, COALESCE(c.n, 0) AS bin_count,
            {pct('COALESCE(c.n, 0)', 'f.total_rows')} AS bin_percentage
        FROM final f CROSS JOIN range(1, 11) r(i) LEFT JOIN counted c ON c.column_name = f.column_name AND c.b = i"""


# --- checks and impact ---------------------------------------------------------------------------------------------

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def category_rows() -> str:
    parts = [
        f"""SELECT '{p}' AS category, COUNT(*) FILTER (o_orderpriority = '{p}' AND l_discount = 0) AS zero_count,
            COUNT(*) FILTER (o_orderpriority = '{p}') AS total_count FROM {LINES}"""
        for p in PRIORITIES
    ]
    return f"SELECT *, {pct('zero_count', 'total_count')} AS percent FROM ({' UNION ALL '.join(parts)})"


def zero_column_rows() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{p}' AS category, '{c}' AS column_name, COUNT(*) FILTER ({c} = 0) AS count,
            {pct(f'COUNT(*) FILTER ({c} = 0)', 'COUNT(*)')} AS percent FROM {LINES} WHERE o_orderpriority = '{p}'"""
        for p in ("1-URGENT", "5-LOW")
        for c in ("l_discount", "l_tax", "l_quantity", "l_extendedprice")
    )


DAILY = """daily AS (
    SELECT CAST(o_orderdate AS DATE) AS date, 0.75::DOUBLE * COUNT(*) FILTER (o_orderpriority = '1-URGENT') AS prcp,
        (AVG(o_totalprice) - 200000) / 8000 AS avg_temp,
        (MAX(o_totalprice) - MIN(o_totalprice)) / 25000 AS temp_range
    FROM orders GROUP BY 1)"""
FEAT = f"""{DAILY}, feat AS (
    SELECT d.date, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, prcp, avg_temp, temp_range
    FROM lineitem JOIN daily d ON d.date = CAST(l_shipdate AS DATE))"""
MEANS = """COUNT(*) AS trip_count, AVG(l_quantity) AS avg_quantity, AVG(l_extendedprice) AS avg_price,
    AVG(l_discount) AS avg_discount"""


def settled(value: str) -> str:
    """Rounded to 6 places, exact halves moved up first."""
    return f"ROUND({value} + 1e-8, 6)"


METRICS = ["avg_trip_count", "avg_quantity", "avg_price", "avg_discount"]


def second_level(digits: int) -> str:
    sources = {"avg_trip_count": "trip_count"}
    return ", ".join(f"ROUND(AVG({sources.get(m, m)}), {digits}) AS {m}" for m in METRICS)


STATUS = "CASE WHEN prcp > 0 THEN 'rain' ELSE 'no_rain' END"
DAY_TYPE = "CASE WHEN date_part('dayofweek', date) IN (0, 6) THEN 'weekend' ELSE 'weekday' END"
BANDS = {
    "rain_level": (
        "prcp",
        [("= 0", "no_rain", "0"), ("<= 0.75", "light_rain", "(0, 0.75]"), ("<= 1.5", "medium_rain", "(0.75, 1.5]"),
         (None, "heavy_rain", "> 1.5")],
    ),
    "avg_temp_level": (
        "avg_temp",
        [("<= 0", "very_cold_temp", "<= 0"), ("<= 5", "cold_temp", "(0, 5]"), ("<= 10", "cool_temp", "(5, 10]"),
         ("<= 15", "mild_low_temp", "(10, 15]"), ("<= 20", "mild_high_temp", "(15, 20]"),
         ("<= 25", "warm_temp", "(20, 25]"), (None, "hot_temp", "> 25")],
    ),
    "temp_range_level": (
        "temp_range",
        [("<= 5", "low_range", "<= 5"), ("<= 10", "medium_range", "(5, 10]"), ("<= 15", "high_range", "(10, 15]"),
         (None, "very_high_range", "> 15")],
    ),
}


def status_sql(digits: int) -> str:
    return f"""SELECT rain_status, COUNT(*) AS day_count, {second_level(digits)}
        FROM (SELECT date, {STATUS} AS rain_status, {MEANS} FROM feat GROUP BY 1, 2) GROUP BY rain_status"""


def day_type_sql(digits: int) -> str:
    return f"""SELECT day_type, rain_status, COUNT(*) AS day_count, {second_level(digits)}
        FROM (SELECT date, {STATUS} AS rain_status, {DAY_TYPE} AS day_type, {MEANS} FROM feat GROUP BY 1, 2, 3)
        GROUP BY day_type, rain_status"""


def level_sql(name: str, digits: int) -> str:
    factor, bands = BANDS[name]

    def case(entry) -> str:
        whens = " ".join(f"WHEN w {test} THEN {entry(k)}" for k, (test, _, _) in enumerate(bands) if test)
        return f"CASE {whens} ELSE {entry(len(bands) - 1)} END"

    return f"""SELECT {name}, value_range, level_order, COUNT(*) AS day_count, {second_level(digits)}
        FROM (SELECT *, {case(lambda k: text(bands[k][1]))} AS {name}, {case(lambda k: text(bands[k][2]))} AS value_range,
                {case(lambda k: str(k + 1))} AS level_order
            FROM (SELECT date, AVG({factor}) AS w, {MEANS} FROM feat GROUP BY date))
        GROUP BY {name}, value_range, level_order"""


def difference(value: str, base: str) -> str:
    return f"CASE WHEN ({base}) <> 0 THEN (({value}) - ({base})) / ({base}) * 100e0 END"


def summary_rows() -> str:
    def pick(section: str, test: str, metric: str) -> str:
        return f"(SELECT {metric} FROM {section} WHERE {test})"

    parts = []
    for metric in METRICS:
        columns = [
            ("rain_pct", "by_status", "rain_status = 'rain'", "rain_status = 'no_rain'"),
            *[
                (f"{kind}_rain_pct", "by_type", f"day_type = '{kind}' AND rain_status = 'rain'",
                 f"day_type = '{kind}' AND rain_status = 'no_rain'")
                for kind in ("weekday", "weekend")
            ],
            *[
                (f"{level}_pct", "by_level", f"rain_level = '{level}'", "rain_level = 'no_rain'")
                for level in ("light_rain", "medium_rain", "heavy_rain")
            ],
        ]
        differences = ", ".join(
            f"{difference(pick(section, group, metric), pick(section, base, metric))} AS {name}"
            for name, section, group, base in columns
        )
        parts.append(f"SELECT '{metric}' AS metric, {differences}")
    return f"""WITH {FEAT}, by_status AS ({status_sql(2)}), by_type AS ({day_type_sql(2)}), by_level AS ({level_sql('rain_level', 2)})
        {' UNION ALL '.join(parts)}"""


def baseline_rows() -> str:
    baselines = {"rain_level": "no_rain", "avg_temp_level": "mild_low_temp", "temp_range_level": "low_range"}
    ctes = [f"s_{name} AS ({level_sql(name, 2)})" for name in BANDS]
    parts = []
    for metric in METRICS:
        def row(section: str, source: str, group: str, base: str) -> str:
            diff = f"CASE WHEN ABS(({base})) >= 1e-12 THEN (a.{metric} - ({base})) / ({base}) * 100e0 END"
            return f"""SELECT '{section}' AS section, {group} AS group_name, '{metric}' AS metric, a.{metric} AS value,
                {diff} AS diff_from_baseline FROM {source} a"""

        for name, level in baselines.items():
            parts.append(row(name, f"s_{name}", f"a.{name}", f"SELECT {metric} FROM s_{name} WHERE {name} = '{level}'"))
        parts.append(row("rain_status", "by_status", "a.rain_status", f"SELECT {metric} FROM by_status WHERE rain_status = 'no_rain'"))
        parts.append(row("rain_weekend", "by_type", "a.day_type || '/' || a.rain_status",
                         f"SELECT b.{metric} FROM by_type b WHERE b.rain_status = 'no_rain' AND b.day_type = a.day_type"))
    return f"""WITH {FEAT}, {', '.join(ctes)}, by_status AS ({status_sql(2)}), by_type AS ({day_type_sql(2)})
        {' UNION ALL '.join(parts)}"""


SPANS = """spans AS (
    SELECT user_id, event_type, CAST(FLOOR(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) / 2) AS BIGINT) AS block,
        MIN(ts) AS a, MAX(ts) AS b FROM events GROUP BY 1, 2, 3)"""

FAMILY = """CASE WHEN column_type IN ('BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT', 'DOUBLE', 'FLOAT') THEN 'numeric'
    WHEN column_type LIKE 'TIMESTAMP%' OR column_type = 'DATE' THEN 'datetime'
    WHEN column_type = 'BOOLEAN' THEN 'boolean' WHEN column_type = 'VARCHAR' THEN 'text' ELSE 'other' END"""
FILE_TYPE = """CASE column_type WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'DOUBLE' THEN 'double'
    WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp[us]' ELSE column_type END"""


def inventory_rows() -> str:
    parts = []
    for name in ("lineitem", "orders", "events"):
        for k, column in enumerate(TABLE_COLUMNS[name]):
            parts.append(
                f"""SELECT '{name}' AS table_name, {k} AS column_index, '{column}' AS column_name,
                (SELECT {FAMILY} FROM (DESCRIBE {name}) WHERE column_name = '{column}') AS type_family,
                (SELECT COUNT({column}) FROM {name}) AS non_null_count"""
            )
    return " UNION ALL ".join(parts)


def drift_rows() -> str:
    bare = "regexp_replace(column_name, '^[a-z]+_', '')"
    return f"""WITH a AS (SELECT {bare} AS column_name, {FILE_TYPE} AS parquet_type FROM (DESCRIBE lineitem)),
        b AS (SELECT {bare} AS column_name, {FILE_TYPE} AS parquet_type FROM (DESCRIBE orders))
        SELECT 'orders.parquet' AS file, mismatch, column_name, parquet_type, (SELECT COUNT(*) FROM orders) AS row_count
        FROM (SELECT 'missing' AS mismatch, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
            UNION ALL SELECT 'extra', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a))"""


def type_match_rows() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{column}' AS column_name,
            (SELECT {FILE_TYPE} FROM (DESCRIBE orders) WHERE column_name = '{column}') AS file_type,
            (SELECT {FILE_TYPE} IN ('int64', 'double', 'string', 'timestamp[us]', 'date32[day]', 'boolean')
                FROM (DESCRIBE orders) WHERE column_name = '{column}') AS match,
            (SELECT COUNT({column}) FROM orders) AS non_null_count"""
        for column in TABLE_COLUMNS["orders"]
    )


PROFILED = (("customer", "c_acctbal"), ("lineitem", "l_discount"), ("lineitem", "l_extendedprice"), ("events", "value"))
CHARTED = (("customer", "c_acctbal"), ("events", "value"))

ORACLE_SQL: dict[str, str] = {
    "ingest_pinned_schema": "SELECT event_id, user_id, event_type, value FROM events",
    "schema_inventory": inventory_rows(),
    "schema_drift": drift_rows(),
    "schema_type_match": type_match_rows(),
    "business_rules_filter": f"SELECT {TRIP_COLUMNS} FROM {LINES} WHERE {ALL_RULES}",
    "conditional_adjust_filter": f"SELECT l_orderkey, l_linenumber, l_extendedprice, l_tax FROM lineitem WHERE {RULES[10][2]}",
    "null_default_membership": """SELECT l_orderkey, l_linenumber, NULLIF(l_discount, 0.07::DOUBLE) AS discount FROM lineitem
        WHERE COALESCE(NULLIF(l_discount, 0.07::DOUBLE), 0e0) IN (0e0, 0.02::DOUBLE, 0.05::DOUBLE)""",
    "unit_conversion_filter": """SELECT 'customer' AS source, c_custkey AS id,
            ROUND((c_acctbal - 32.0) * 5.0 / 9.0, 2) AS metric_value FROM customer WHERE c_acctbal > -459.67
        UNION ALL SELECT 'part', p_partkey, ROUND(CAST(p_size AS DOUBLE) * 2.54::DOUBLE, 2) FROM part WHERE p_size >= 0""",
    "narrow_types": """SELECT l_orderkey, CAST(CAST(l_linenumber AS UTINYINT) AS SMALLINT) AS l_linenumber,
            CAST(CAST(l_quantity / 2 AS USMALLINT) AS INTEGER) AS half_quantity,
            CAST(l_extendedprice AS FLOAT) AS l_extendedprice, CAST(l_discount AS FLOAT) AS l_discount,
            CAST(l_tax AS FLOAT) AS l_tax, CAST(l_shipdate AS TIMESTAMP) AS l_shipdate FROM lineitem""",
    "flag_to_boolean": """SELECT l_orderkey, l_linenumber,
            CASE WHEN l_linestatus = 'F' THEN true WHEN l_linestatus = 'O' THEN false END AS is_final,
            CASE WHEN l_returnflag = 'A' THEN true WHEN l_returnflag = 'R' THEN false END AS is_accepted FROM lineitem""",
    "same_day_filter": f"""WITH {SPANS} SELECT user_id, event_type, a, b FROM spans
        WHERE a < b AND CAST(a AS DATE) = CAST(b AS DATE)""",
    "derived_daily_features": """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
            (MIN(o_totalprice) + MAX(o_totalprice)) / 2.0 AS mid_value, MAX(o_totalprice) - MIN(o_totalprice) AS value_range
        FROM orders GROUP BY CAST(o_orderdate AS DATE) HAVING COUNT(*) FILTER (o_orderpriority = '1-URGENT') = 0""",
    "join_daily_features": f"WITH {FEAT} SELECT * REPLACE (CAST(date AS VARCHAR) AS date, {settled('avg_temp')} AS avg_temp) FROM feat",
    "step_removal_audit": f"""SELECT COUNT(*) AS input_rows, COUNT(*) FILTER ({ALL_RULES}) AS output_rows,
            COUNT(*) - COUNT(*) FILTER ({ALL_RULES}) AS removed_rows,
            {pct(f'(COUNT(*) - COUNT(*) FILTER ({ALL_RULES}))', 'COUNT(*)')} AS removed_percent FROM {LINES}""",
    "rule_impact_totals": f"""WITH {FLAGGED} SELECT COUNT(*) AS raw_count, COUNT(*) FILTER (fails = 0) AS clean_count,
            COUNT(*) FILTER (fails > 0) AS removed_count, {pct('COUNT(*) FILTER (fails > 0)', 'COUNT(*)')} AS removed_percentage,
            CAST({len(RULES)} AS BIGINT) AS rule_count FROM summed""",
    "rule_impact_audit": f"{rule_rows()} ORDER BY exclusive_removed_count DESC, rule_index",
    "rule_top_removed": f"""SELECT * EXCLUDE (rule_index),
            exclusive_removed_count + shared_removed_count AS total_removed_count FROM ({rule_rows()})
        ORDER BY exclusive_removed_count + shared_removed_count DESC, exclusive_removed_count DESC, rule_index LIMIT 8""",
    "type_validity": validity_rows(
        "events",
        [("event_id", "TINYINT", "tinyint"), ("ts", "TIMESTAMP", "timestamp_ntz"), ("user_id", "BIGINT", "bigint"),
         ("event_type", "DOUBLE", "double"), ("value", "DOUBLE", "double"), ("props", "DOUBLE", "double")],
    )
    + " UNION ALL "
    + validity_rows(
        "lineitem",
        [("l_extendedprice", "SMALLINT", "smallint"), ("l_returnflag", "VARCHAR", "string"), ("l_linenumber", "INTEGER", "int")],
    ),
    "capped_distinct_count": f"""SELECT table_name, column_name, unique_count
        FROM ({distinct_rows(('lineitem', 'events', 'part'))})""",
    "column_cardinality_split": f"""SELECT *, CASE WHEN unique_count <= 300 THEN 'low' ELSE 'high' END AS column_group
        FROM ({distinct_rows(('lineitem', 'events', 'part'))})""",
    "value_counts": value_count_rows(),
    "value_counts_other_bucket": " UNION ALL ".join(
        f"SELECT * FROM {part}"
        for part in (
            other_bucket_sql("lineitem", "l_suppkey", True, "percent > 1"),
            other_bucket_sql("part", "p_brand", False, "true"),
        )
    ),
    "numeric_profile": " UNION ALL ".join(
        f"SELECT * EXCLUDE (total_rows) REPLACE (ROUND(chart_max_value, 6) AS chart_max_value) FROM ({summary_sql(name, column)})"
        for name, column in PROFILED
    ),
    "datetime_profile": """SELECT 'o_orderdate' AS column_name, MIN(o_orderdate) AS min_value,
            COUNT(*) FILTER (o_orderdate < TIMESTAMP '1998-01-01') AS before_year_count,
            COUNT(*) FILTER (o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01') AS in_year_count,
            COUNT(*) FILTER (o_orderdate >= TIMESTAMP '1999-01-01') AS after_year_count, MAX(o_orderdate) AS max_value,
            CAST(12 AS BIGINT) AS month_count FROM orders""",
    "month_counts": month_rows(),
    "date_coverage": """SELECT y AS filter_year, COUNT(d) AS row_count, COUNT(DISTINCT d) AS unique_count,
            CAST(MIN(d) AS VARCHAR) AS min_date, CAST(MAX(d) AS VARCHAR) AS max_date, COUNT(d) = COUNT(DISTINCT d) AS is_unique,
            COUNT(DISTINCT d) = date_diff('day', make_date(y, 1, 1), make_date(y + 1, 1, 1)) AS full_year
        FROM (VALUES (1995), (1996), (1997), (1998), (1999), (2000), (2001), (2030)) AS asked(y)
        LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) ON year(d) = y GROUP BY y""",
    "profile_table": profile_sql(),
    "histogram_right_closed": " UNION ALL ".join(
        f"SELECT * FROM ({bins_sql(name, column, upper, count, total_sql(name))})"
        for name, column, upper, count in (("customer", "c_acctbal", "10000", 100), ("events", "value", "500", 50))
    ),
    "histogram_labeled": " UNION ALL ".join(f"SELECT * FROM ({labeled_sql(name, column)})" for name, column in CHARTED),
    "histogram_chart_rows": " UNION ALL ".join(f"SELECT * FROM ({chart_sql(name, column)})" for name, column in CHARTED),
    "positive_max_zero_count": " UNION ALL ".join(
        f"""SELECT '{column}' AS column_name, COALESCE(MAX(CAST({column} AS DOUBLE)) FILTER ({column} > 0), 1e0) AS max_value,
            COUNT(*) FILTER ({column} = 0) AS zero_count FROM lineitem"""
        for column in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
    ),
    "iterative_trim_bounds": f"""WITH {trim_ctes(TRIM_SOURCES)}
        SELECT column_name, max_value, p1 AS first_pass_value, m AS second_pass_value, zero_count FROM final""",
    "upper_bound_bins": final_bins(),
    "apply_upper_bounds": f"""WITH {trim_ctes(TRIM_SOURCES[:2])}
        SELECT 'events' AS source, event_id AS id, value AS kept_value FROM events
            WHERE value <= (SELECT ROUND(m, 2) FROM final WHERE column_name = 'value')
        UNION ALL SELECT 'documents', doc_id, CAST(n_chars AS DOUBLE) FROM documents
            WHERE n_chars <= (SELECT ROUND(m, 2) FROM final WHERE column_name = 'n_chars')""",
    "zero_rate_by_category": category_rows(),
    "zero_rate_by_column": zero_column_rows(),
    "minute_boundary_duration": f"""WITH {SPANS} SELECT event_type, COUNT(*) AS span_count,
            CAST(SUM(date_diff('minute', a, b)) AS BIGINT) AS total_minutes, MAX(date_diff('minute', a, b)) AS longest_minutes
        FROM spans GROUP BY event_type""",
    "daily_metrics": f"""WITH {FEAT}, days AS (SELECT date, prcp, avg_temp, temp_range, {MEANS} FROM feat GROUP BY ALL)
        SELECT CAST(date AS VARCHAR) AS date, prcp, temp_range, trip_count,
            {', '.join(f'{settled(m)} AS {m}' for m in ('avg_temp', 'avg_quantity', 'avg_price', 'avg_discount'))} FROM days""",
    "impact_by_status": f"WITH {FEAT} {status_sql(6)}",
    "impact_by_daytype_status": f"WITH {FEAT} {day_type_sql(6)}",
    "impact_by_rain_level": f"WITH {FEAT} {level_sql('rain_level', 6)}",
    "impact_by_temp_level": f"WITH {FEAT} {level_sql('avg_temp_level', 6)}",
    "impact_by_range_level": f"WITH {FEAT} {level_sql('temp_range_level', 6)}",
    "impact_summary": summary_rows(),
    "impact_diff_from_baseline": baseline_rows(),
}

# The same results by the ways that large tables take.
ORACLE_SQL["numeric_profile_searched"] = ORACLE_SQL["numeric_profile"]
ORACLE_SQL["iterative_trim_bounds_rescanned"] = ORACLE_SQL["iterative_trim_bounds"]
