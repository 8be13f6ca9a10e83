"""The registered queries in SQL, written independently of the Spark plans.

Tables are bound again here, order statistics use the engine's own aggregates, grand totals
are a union, ranks are windows: nothing follows the way the Spark plans compute them.
"""

from __future__ import annotations

DIGITS = 6
QUANTILES = {"q1": 0.25, "q2": 0.5, "q3": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}

ENVIRONMENT = """environment AS (
  SELECT event_type AS experiment_id, event_type || '_' || (user_id % 5) AS trial_id,
         'app' || (user_id % 5) AS container_id, 'app' AS container_name,
         'h' || ((user_id // 5) % 5) AS host_id, ts AS at_time, value AS x
  FROM events)"""
CORES = """cores AS (
  SELECT 'e' || label AS experiment_id, 'e' || label || '_' || (vec_id % 5) AS trial_id,
         'app' || (vec_id % 5) AS container_id, 'app' AS container_name, 'h' || (label % 5) AS host_id,
         vec_id AS at_time, unnest(range(len(embedding))) AS core, CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings)"""
HOSTS = """hosts AS (
  SELECT 'h' || n_nationkey AS host_id, CAST(16 * (n_nationkey % 5 + 1) AS INTEGER) AS n_cpu,
         (CAST(n_nationkey AS BIGINT) + 1) * 1073741824 AS mem_total
  FROM nation)"""
# Limits as the numbers that the texts in the Spark binding stand for.
CONTAINERS = """containers AS (
  SELECT *, CASE container_id WHEN 'app0' THEN 5 WHEN 'app1' THEN 1 WHEN 'app3' THEN 4 END AS set_size,
         CASE container_id WHEN 'app0' THEN 2147483648 WHEN 'app1' THEN 536870912
                           WHEN 'app4' THEN 2099945472 END AS limit_bytes
  FROM (SELECT DISTINCT experiment_id, trial_id, container_id, host_id FROM environment
        UNION SELECT DISTINCT experiment_id, trial_id, container_id, host_id FROM cores))"""
PROCESS = """process_rows AS (
  SELECT 'p' || (user_id % 3) AS experiment_id, 'p' || (user_id % 3) || '_' || (user_id % 5) AS trial_id,
         CAST(event_id AS VARCHAR) AS id, event_type AS process_definition_id, ts AS started,
         ts + CAST(round(value * 100) AS BIGINT) * INTERVAL 10 MILLISECOND AS ended,
         CAST(nullif(CAST(round(value * 100) AS BIGINT), 1000) AS DOUBLE) AS x,
         CASE WHEN CAST(round(value * 100) AS BIGINT) <> 200 THEN value < 1 END AS to_ignore
  FROM events),
process_all AS (
  SELECT * FROM process_rows WHERE NOT to_ignore
  UNION ALL SELECT * REPLACE ('all' AS process_definition_id) FROM process_rows WHERE NOT to_ignore)"""
CONSTRUCT = """construct_rows AS (
  SELECT l_returnflag AS experiment_id, l_returnflag || '_' || l_linenumber AS trial_id,
         coalesce(nullif(p_type, 'ECONOMY'), 'Unspecified') AS construct_type, p_brand AS construct_name,
         CAST(l_quantity AS DOUBLE) AS x
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE NOT (l_tax = 0)),
construct_all AS (
  SELECT * FROM construct_rows
  UNION ALL SELECT * REPLACE ('all' AS construct_type, 'all' AS construct_name) FROM construct_rows)"""
IO = """io_rows AS (
  SELECT l_linestatus AS experiment_id, l_linestatus || '_' || l_linenumber AS trial_id,
         'app' || l_linenumber AS container_id, 'app' AS container_name, 'h' || (l_suppkey % 5) AS host_id,
         l_returnflag AS device,
         CASE WHEN NOT (l_quantity = 50 AND l_discount > 0.095 AND l_tax > 0.075)
              THEN CAST(floor(l_quantity) AS BIGINT) END AS reads,
         CAST(floor(l_extendedprice) AS BIGINT) AS writes
  FROM lineitem),
trial_io AS (
  SELECT experiment_id, trial_id, container_id, container_name, host_id, device,
         CASE WHEN bool_or(reads IS NULL) THEN NULL ELSE max(reads) END AS reads, max(writes) AS writes,
         CASE WHEN bool_or(reads IS NULL) THEN NULL ELSE max(reads + writes) END AS total
  FROM io_rows GROUP BY ALL)"""
SIZES = """trial_size AS (
  SELECT o_orderstatus AS experiment_id, o_orderstatus || '_' || o_orderpriority AS trial_id,
         CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS size
  FROM orders GROUP BY ALL)"""
DRIVER = """driver AS (
  SELECT o_orderstatus AS experiment_id, o_orderstatus || '_' || l_linenumber AS trial_id,
         CASE s_nationkey WHEN 7 THEN 'aggregate' ELSE 'n' || s_nationkey END AS host,
         l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, o_orderpriority
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey)"""

TRIAL = ["experiment_id", "trial_id"]
CONTAINER = [*TRIAL, "container_id", "container_name", "host_id"]
PROCESS_KEYS = [*TRIAL, "process_definition_id"]
CONSTRUCT_KEYS = [*TRIAL, "construct_type", "construct_name"]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _list(keys: list[str], alias: str = "") -> str:
    return ", ".join(f"{alias}{k}" for k in keys)


def summary(name: str, source: str, keys: list[str], x: str = "x", order: str | None = None) -> str:
    """CTE ``name``: unrounded summary of ``x`` per keys, with modes and integral."""
    k = _list(keys)
    quantiles = ", ".join(f"quantile_cont({x}, {q}) AS {n}" for n, q in QUANTILES.items())
    integral = ""
    if order:
        integral = (
            f", sum(x0) - (min(CASE WHEN at0 = first_at THEN x0 END) + max(CASE WHEN at0 = last_at THEN x0 END)) / 2"
            " AS integral"
        )
    quantiles = quantiles.replace(f"quantile_cont({x},", "quantile_cont(x0,")
    window = f"PARTITION BY {k}"
    ends = ""
    if order:
        ends = (
            f", {order} AS at0, min(CASE WHEN {x} IS NOT NULL THEN {order} END) OVER ({window}) AS first_at"
            f", max(CASE WHEN {x} IS NOT NULL THEN {order} END) OVER ({window}) AS last_at"
        )
    match = " AND ".join(f"c.{key} IS NOT DISTINCT FROM b.{key}" for key in keys) or "TRUE"
    return f"""{name}_in AS (SELECT {k}, CAST({x} AS DOUBLE) AS x0{ends} FROM {source}),
{name}_freq AS (SELECT {k}, x0, count(*) AS c FROM {name}_in WHERE x0 IS NOT NULL GROUP BY {k}, x0),
{name}_best AS (SELECT {k}, max(c) AS c FROM {name}_freq GROUP BY {k}),
{name}_mode AS (
  SELECT {_list(keys, "b.")}, b.c AS mode_freq, min(x0) AS mode_min, max(x0) AS mode_max, count(*) AS mode_ties
  FROM {name}_freq c JOIN {name}_best b ON {match} AND c.c = b.c GROUP BY {_list(keys, "b.")}, b.c),
{name}_flat AS (
  SELECT {k}, count(x0) AS num_data_points, min(x0) AS min, max(x0) AS max, avg(x0) AS mean,
         var_pop(x0) AS variance, stddev_pop(x0) AS sd, {quantiles},
         2 * stddev_pop(x0) / sqrt(nullif(count(x0), 0)) AS me{integral}
  FROM {name}_in GROUP BY {k}),
{name} AS (
  SELECT c.*, mean - me AS ci095_min, mean + me AS ci095_max, mode_freq, mode_min, mode_max,
         coalesce(mode_ties, 0) AS mode_ties
  FROM {name}_flat c LEFT JOIN {name}_mode b ON {match})"""


STATS = ["min", "max", "mean", "variance", "sd", *QUANTILES, "me", "ci095_min", "ci095_max"]


def shown(prefix: str, digits: int = DIGITS, modes: bool = False, integral: bool = False,
          drop: tuple[str, ...] = (), significant: tuple[str, ...] = (), unit: float = 1.0, n: bool = True, alias: str = "") -> str:
    """Output columns of a summary."""
    p = f"{prefix}_" if prefix else ""
    out = [f"CAST({alias}num_data_points AS BIGINT) AS {p}num_data_points"] if n else []
    names = [*STATS, *(["mode_min", "mode_max"] if modes else []), *(["integral"] if integral else [])]
    for s in names:
        if s in drop:
            continue
        if s in significant:
            tiny = f"{alias}{s} <= 1e-12 * {alias}mean * {alias}mean"
            out.append(f"CASE WHEN {alias}{s} IS NOT NULL THEN printf('%.8e', CASE WHEN {tiny} THEN 0.0::DOUBLE ELSE {alias}{s} END) END AS {p}{s}")
            continue
        scale = unit * unit if s == "variance" else unit
        value = f"{alias}{s}" if scale == 1.0 else f"{alias}{s} / {scale}"
        out.append(f"round({value}, {digits}) AS {p}{s}")
    if modes:
        out += [f"CAST({alias}{s} AS BIGINT) AS {p}{s}" for s in ("mode_freq", "mode_ties")]
    return ", ".join(out)


def _close(a: str, b: str) -> str:
    return f"abs({a} - {b}) <= 1e-9 * greatest(abs({a}), abs({b}))"


def ranking(name: str, source: str, keys: list[str]) -> str:
    """CTE ``name``: rows (keys, ranking, trial_id) from a summary CTE."""
    k = _list(keys)
    return f"""{name}_w AS (
  SELECT {k}, trial_id, rank() OVER (PARTITION BY {k} ORDER BY mean, me) AS b,
         rank() OVER (PARTITION BY {k} ORDER BY mean DESC, me DESC) AS w, mean AS m,
         avg(mean) OVER (PARTITION BY {k}) AS centre
  FROM {source} WHERE mean IS NOT NULL),
{name}_n AS (
  SELECT *, min(CASE WHEN m >= centre OR {_close("m", "centre")} THEN m END) OVER (PARTITION BY {k}) AS u,
         max(CASE WHEN m <= centre OR {_close("m", "centre")} THEN m END) OVER (PARTITION BY {k}) AS l FROM {name}_w),
{name} AS (
  SELECT {k}, 'best' AS ranking, trial_id FROM {name}_n WHERE b = 1
  UNION ALL SELECT {k}, 'worst', trial_id FROM {name}_n WHERE w = 1
  UNION ALL SELECT {k}, 'average', trial_id FROM {name}_n WHERE {_close("m", "u")} OR {_close("m", "l")})"""


def rolled(name: str, source: str, keys: list[str]) -> str:
    """CTE ``name``: unrounded roll-up of a summary CTE whose trials are ``trial_id``."""
    k = _list(keys)
    ends = ", ".join(f"min({s}) AS {s}_min, max({s}) AS {s}_max" for s in ["mean", *QUANTILES])
    same = " AND ".join(f"t.{key} IS NOT DISTINCT FROM g.{key}" for key in keys)
    return f"""{name}_g AS (
  SELECT {k}, min(min) AS min, max(max) AS max, {ends},
         sum(mean * num_data_points) / sum(num_data_points) AS weighted_avg,
         stddev_pop(mean) / avg(mean) * 100 AS variation_coefficient,
         CASE WHEN sum(num_data_points) = 1 THEN 'nan'::DOUBLE ELSE
           (sum((num_data_points - 1) * variance + num_data_points * mean * mean)
            - sum(num_data_points) * pow(sum(num_data_points * mean) / sum(num_data_points), 2))
           / (sum(num_data_points) - 1) END AS combined_variance,
         min(mode_min) AS mode_min, max(mode_max) AS mode_max
  FROM {source} GROUP BY {k}),
{name} AS (
  SELECT g.*,
    (SELECT min(mode_freq) FROM {source} t WHERE t.mode_min = g.mode_min AND {same}) AS mode_min_freq,
    (SELECT max(mode_freq) FROM {source} t WHERE t.mode_max = g.mode_max AND {same}) AS mode_max_freq
  FROM {name}_g g)"""


def shown_roll(prefix: str, modes: bool, unit: float = 1.0, alias: str = "") -> str:
    names = ["min", "max", *[f"{s}_{e}" for s in ["mean", *QUANTILES] for e in ("min", "max")],
             "weighted_avg", "variation_coefficient", "combined_variance"]
    if modes:
        names += ["mode_min", "mode_max"]
    out = []
    for s in names:
        scale = {"variation_coefficient": 1.0, "combined_variance": unit * unit}.get(s, unit)
        value = f"{alias}{s}" if scale == 1.0 else f"{alias}{s} / {scale}"
        out.append(f"round({value}, {DIGITS}) AS {prefix}_{s}")
    if modes:
        out += [f"CAST({alias}{s} AS BIGINT) AS {prefix}_{s}" for s in ("mode_min_freq", "mode_max_freq")]
    return ", ".join(out)


def _tail(alias: str) -> str:
    """Upper tail of F for four degrees of freedom, a closed form: all experiments here have five trials."""
    x = f"({alias}.d2 / ({alias}.d2 + 4.0 * {alias}.w))"
    tail = f"pow({x}, {alias}.d2 / 2.0) * (1 + {alias}.d2 / 2.0 * (1 - {x}))"
    return f"CASE WHEN {alias}.d1 = 4 AND {alias}.w IS NOT NULL THEN {tail} END"


def levene(name: str, source: str, keys: list[str], trial: str, x: str = "x") -> str:
    """CTE ``name``: W and p for the three centres."""
    k, kt = _list(keys), _list([*keys, trial])
    parts = []
    for c in ("mean", "median", "trimmed"):
        sample = f"{name}_s"
        centre = "avg(x0)" if c != "median" else "median(x0)"
        keep = "WHERE rn > floor(0.05 * n) AND rn <= n - floor(0.05 * n)" if c == "trimmed" else ""
        parts.append(f"""{name}_{c}_z AS (
  SELECT {kt}, abs(x0 - {centre} OVER (PARTITION BY {kt})) AS z FROM {sample} {keep}),
{name}_{c}_t AS (
  SELECT {kt}, count(*) AS n, avg(z) AS zbar, var_pop(z) * count(*) AS ss FROM {name}_{c}_z GROUP BY {kt}),
{name}_{c}_m AS (SELECT *, sum(n * zbar) OVER (PARTITION BY {k}) / sum(n) OVER (PARTITION BY {k}) AS grand FROM {name}_{c}_t),
{name}_{c} AS (
  SELECT {k}, CASE WHEN count(*) > 1 THEN (sum(n) - count(*)) * sum(n * (zbar - grand) * (zbar - grand))
         / nullif((count(*) - 1) * sum(ss), 0) END AS w, sum(n) - count(*) AS d2, count(*) - 1 AS d1
  FROM {name}_{c}_m GROUP BY {k})""")
    using = ", ".join(keys)
    return f"""{name}_s AS (
  SELECT {kt}, CAST({x} AS DOUBLE) AS x0, row_number() OVER (PARTITION BY {kt} ORDER BY {x}) AS rn,
         count(*) OVER (PARTITION BY {kt}) AS n
  FROM {source} WHERE {x} IS NOT NULL),
{",".join(parts)},
{name} AS (
  SELECT {k}, a.w AS mean_stat, m.w AS median_stat, t.w AS trimmed_stat,
         {_tail("a")} AS mean, {_tail("m")} AS median, {_tail("t")} AS trimmed
  FROM {name}_mean a JOIN {name}_median m USING ({using}) JOIN {name}_trimmed t USING ({using}))"""


def _usage_job(prefix: str, unit: float, modes: bool) -> str:
    """Roll-up, integrals and spread test of a usage measure; ``unit`` scales the report."""
    keys = ["experiment_id", "container_name", "host_id"]
    using = _list(keys)
    spread = ", ".join(
        f"round(l.{c}{s}, {DIGITS}) AS {prefix}_levene_test_{c}{s}" for c in ("mean", "median", "trimmed") for s in ("", "_stat")
    )
    ctes = [ENVIRONMENT if unit == 1.0 else ENVIRONMENT.replace("value AS x", f"value * {unit} AS x")]
    active = join = ""
    if prefix == "cpu":
        ctes += [CORES, HOSTS, CONTAINERS]
        active = ", CAST(a.cpu_cores AS BIGINT) AS cpu_cores"
        join = f"JOIN active a USING ({using})"
    ctes.append(summary("trials", "environment", CONTAINER, order="at_time"))
    if prefix == "cpu":
        ctes.append(f"""active AS (
  SELECT {_list(keys, "t.")}, min(coalesce(set_size, n_cpu)) AS cpu_cores
  FROM trials t LEFT JOIN containers USING (experiment_id, trial_id, container_id, host_id)
  LEFT JOIN hosts USING (host_id) GROUP BY ALL)""")
    ctes += [
        rolled("rolled", "trials", keys),
        summary("integrals", "trials", keys, x="integral"),
        levene("lev", "environment", keys, "trial_id"),
    ]
    integrals = shown(f"{prefix}_integral", drop=("variance",), unit=unit, n=False, alias="i.")
    return _with(*ctes) + f"""SELECT {_list(keys, "r.")}, {shown_roll(prefix, modes, unit, "r.")}, {integrals}, {spread}{active}
FROM rolled r JOIN integrals i USING ({using}) JOIN lev l USING ({using}) {join}"""


def _describe_job(ctes: list[str], source: str, keys: list[str], x: str, prefix: str,
                  digits: int = DIGITS, significant: tuple[str, ...] = ()) -> str:
    present = f"present AS (SELECT * FROM {source} WHERE {x} IS NOT NULL)"
    return _with(*ctes, present, summary("s", "present", keys, x=x)) + (
        f"SELECT {_list(keys)}, {shown(prefix, digits, modes=True, significant=significant)} FROM s"
    )


def _measures_job(ctes: list[str], source: str, keys: list[str], measures: list[str], prefixes: list[str],
                  digits: int, significant: dict[str, tuple[str, ...]]) -> str:
    parts = [summary(f"m{i}", source, keys, x=m) for i, m in enumerate(measures)]
    columns = ", ".join(
        shown(p, digits, modes=True, significant=significant.get(m, ()), alias=f"m{i}.")
        for i, (m, p) in enumerate(zip(measures, prefixes))
    )
    joins = " ".join(f"JOIN m{i} USING ({_list(keys)})" for i in range(1, len(measures)))
    return _with(*ctes, *parts) + f"SELECT {_list(keys, 'm0.')}, {columns} FROM m0 {joins}"


EXECUTION = """execution AS (
  SELECT experiment_id, trial_id, process_definition_id,
         (epoch_us(max(ended)) - epoch_us(min(started))) / 1e6 AS execution_time, count(*) AS instances
  FROM process_all GROUP BY ALL),
throughput AS (
  SELECT e.experiment_id, e.trial_id, e.process_definition_id,
         e.instances / nullif(t.execution_time, 0) AS throughput
  FROM execution e JOIN execution t ON t.experiment_id = e.experiment_id AND t.trial_id = e.trial_id
       AND t.process_definition_id = 'all')"""
CONSTRUCT_COUNT = """construct_count AS (
  SELECT experiment_id, trial_id, construct_type, construct_name, count(*) AS instances
  FROM construct_all GROUP BY ALL)"""

ROLLED_CORE = ["mean", "min", "max", "q1", "q2", "q3", "p90", "p95", "p99"]
CORE_TRIAL = f"""{CORES},
{HOSTS},
{ENVIRONMENT},
{CONTAINERS},
{summary("core_stats", "cores", [*CONTAINER, "core"], order="at_time")},
core_rows AS (
  SELECT c.*, coalesce(set_size, n_cpu) AS cpu_cores,
         max(num_data_points) OVER (PARTITION BY experiment_id, trial_id, container_id, host_id) AS readings
  FROM core_stats c JOIN hosts USING (host_id)
  LEFT JOIN containers USING (experiment_id, trial_id, container_id, host_id) WHERE core < n_cpu),
core_places AS (
  SELECT DISTINCT {_list(CONTAINER)}, cpu_cores, n_cpu, readings FROM core_rows JOIN hosts USING (host_id)),
core_grid AS (
  SELECT p.*, unnest(range(n_cpu)) AS core FROM core_places p),
core_exp AS (
  SELECT g.experiment_id, g.container_name, g.host_id, g.core, min(g.cpu_cores) AS cpu_cores,
         min(r.min) AS min, max(r.max) AS max,
         {", ".join(f"min(r.{s}) AS {s}_min, max(r.{s}) AS {s}_max" for s in ["mean", *QUANTILES])},
         CASE WHEN count(r.mean) = count(*) THEN sum(r.mean * g.readings) / sum(g.readings) END AS weighted_avg,
         CASE WHEN count(r.mean) = count(*) THEN
           (sum((g.readings - 1) * r.variance + g.readings * r.mean * r.mean)
            - sum(g.readings) * pow(sum(g.readings * r.mean) / sum(g.readings), 2)) / (sum(g.readings) - 1)
         END AS combined_variance
  FROM core_grid g LEFT JOIN core_rows r ON r.experiment_id = g.experiment_id AND r.trial_id = g.trial_id
       AND r.container_id = g.container_id AND r.host_id = g.host_id AND r.core = g.core
  GROUP BY g.experiment_id, g.container_name, g.host_id, g.core)"""
CORE_RESULTS = [
    "min", "max", *[f"{s}_{e}" for s in QUANTILES for e in ("min", "max")], "weighted_avg", "combined_variance",
]


MODE_ENDS = """SELECT experiment_id, trial_id, mode_freq, round(mode_min, 6) AS mode_min,
  round(mode_max, 6) AS mode_max, CAST(mode_ties AS BIGINT) AS mode_ties FROM s"""
P_VALUES = """SELECT experiment_id, round(mean_stat, 6) AS mean_stat, round(median_stat, 6) AS median_stat,
  round(trimmed_stat, 6) AS trimmed_stat, round(mean, 6) AS mean, round(median, 6) AS median,
  round(trimmed, 6) AS trimmed FROM l"""


def modes(ctes: list[str], source: str, keys: list[str], x: str = "x", value: str = "f.x0", digits: int = DIGITS,
          names: dict[str, str] | None = None) -> str:
    """Rows (keys, mode, mode_freq) with all ties."""
    same = " AND ".join(f"f.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    shown_keys = ", ".join(f"f.{k} AS {(names or {}).get(k, k)}" for k in keys)
    return _with(*ctes, summary("s", source, keys, x=x)) + (
        f"SELECT {shown_keys}, round({value}, {digits}) AS mode, f.c AS mode_freq FROM s_freq f JOIN s_best b ON {same} AND f.c = b.c"
    )


def measure_modes(ctes: list[str], source: str, keys: list[str], measures: list[str]) -> str:
    """The same for several measures, each as rows of its name."""
    rows = " UNION ALL ".join(f"SELECT {_list(keys)}, '{m}' AS measure, CAST({m} AS DOUBLE) AS x FROM {source}" for m in measures)
    return modes([*ctes, f"long_rows AS ({rows})"], "long_rows", [*keys, "measure"])


def ranked(ctes: list[str], source: str, trial_keys: list[str], keys: list[str]) -> str:
    """Rows (keys, ranking, trial_id) of a job."""
    return _with(*ctes, summary("s", source, trial_keys), ranking("r", "s", keys)) + f"SELECT {_list(keys)}, ranking, trial_id FROM r"


def oracle_sql() -> dict[str, str]:
    """SQL for every registered query that SQL can express."""
    by_trial = _with(ENVIRONMENT, summary("s", "environment", TRIAL, order="at_time"))
    single = "experiment_id"
    rolled_cpu = by_trial.rstrip() + ",\n" + rolled("rolled", "s", [single]) + "\n"
    named_process = PROCESS.replace("process_definition_id", "process_name")
    detail_keys = [*TRIAL, "host", "section", "op_name"]
    driver_op = {
        "faban_driver_host": "host", "faban_driver_name": "l_returnflag", "faban_op_name": "l_linestatus",
    }
    op_columns = ", ".join(f"{v} AS {k}" for k, v in driver_op.items())
    op_keys = ["experiment_id", *driver_op]
    custom = """custom AS (
  SELECT experiment_id, host AS faban_driver_host, l_returnflag AS faban_driver_name,
         l_linestatus AS faban_stat_name, o_orderpriority AS faban_stat_description, l_quantity AS x FROM driver)"""
    custom_keys = [
        "experiment_id", "faban_driver_host", "faban_driver_name", "faban_stat_name", "faban_stat_description",
    ]
    out = {
        "describe_by_trial": by_trial + f"SELECT {_list(TRIAL)}, {shown('')} FROM s",
        "percentile_curve": _with(ENVIRONMENT) + f"""SELECT experiment_id, trial_id, CAST(p.p AS BIGINT) AS percentile,
  round(q[p.p + 1], 6) AS value
FROM (SELECT experiment_id, trial_id, quantile_cont(x, [{", ".join(str(p / 100) for p in range(101))}]) AS q
      FROM environment GROUP BY ALL), range(101) p(p)""",
        "integral_by_trial": by_trial + "SELECT experiment_id, trial_id, round(integral, 6) AS integral FROM s",
        "mode_by_trial": by_trial + """SELECT f.experiment_id, f.trial_id, round(f.x0, 6) AS mode, f.c AS mode_freq
FROM s_freq f JOIN s_best b ON f.experiment_id = b.experiment_id AND f.trial_id = b.trial_id AND f.c = b.c""",
        "mode_list": by_trial + MODE_ENDS,
        "mode_cut": by_trial + MODE_ENDS,
        "describe_cut": by_trial + f"SELECT {_list(TRIAL)}, {shown('')} FROM s",
        "mode_min_max": rolled_cpu + """SELECT experiment_id, round(mode_min, 6) AS cpu_mode_min,
  round(mode_max, 6) AS cpu_mode_max, mode_min_freq AS cpu_mode_min_freq, mode_max_freq AS cpu_mode_max_freq
FROM rolled""",
        "describe_with_total": _with(named_process, summary("s", "process_all", [*TRIAL, "process_name"]))
        + f"SELECT {_list([*TRIAL, 'process_name'])}, {shown('')} FROM s",
        "count_with_total": _with(named_process)
        + "SELECT experiment_id, trial_id, process_name, count(*) AS instances FROM process_all GROUP BY ALL",
        "trial_ranking": by_trial.rstrip() + ",\n" + ranking("r", "s", [single])
        + "\nSELECT experiment_id, ranking, trial_id FROM r",
        "experiment_rollup": rolled_cpu + f"SELECT experiment_id, {shown_roll('cpu', False)} FROM rolled",
        "combined_variance": rolled_cpu
        + "SELECT experiment_id, round(combined_variance, 6) AS combined_variance FROM rolled",
        "integral_describe": by_trial.rstrip() + ",\n" + summary("i", "s", [single], x="integral")
        + f"\nSELECT experiment_id, {shown('', 4)} FROM i",
        "core_describe": _with(CORES, summary("s", "cores", [*TRIAL, "core"], order="at_time"))
        + f"SELECT experiment_id, trial_id, core, {shown('', integral=True)} FROM s",
        "core_rollup": _with(CORE_TRIAL) + f"""SELECT experiment_id, container_name, host_id, core,
  CAST(cpu_cores AS BIGINT) AS cpu_cores, {", ".join(f"round({s}, 6) AS cpu_{s}" for s in ["mean_min", "mean_max", *CORE_RESULTS])}
FROM core_exp""",
        "levene_statistics": _with(ENVIRONMENT, levene("l", "environment", [single], "trial_id")) + """SELECT
  experiment_id, round(mean_stat, 6) AS mean_stat, round(median_stat, 6) AS median_stat,
  round(trimmed_stat, 6) AS trimmed_stat FROM l""",
        "levene_order_lines": _with(levene("l", "lineitem", ["l_returnflag", "l_linestatus"], "l_linenumber", "l_quantity"))
        + """SELECT l_returnflag, l_linestatus, round(mean_stat, 6) AS mean_stat,
  round(median_stat, 6) AS median_stat, round(trimmed_stat, 6) AS trimmed_stat FROM l""",
        "warmup_trim": _with(PROCESS, """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY experiment_id, trial_id, process_definition_id ORDER BY started, id) AS rn
  FROM process_rows),
nth AS (
  SELECT *, max(started) OVER (PARTITION BY experiment_id, trial_id) AS latest FROM numbered WHERE rn = 20),
cut AS (
  SELECT n.experiment_id, n.trial_id, n.latest AS started, min(p.id) AS id
  FROM nth n JOIN process_rows p USING (experiment_id, trial_id, process_definition_id, started)
  WHERE n.started = n.latest GROUP BY n.experiment_id, n.trial_id, n.latest)""") + """
SELECT p.experiment_id, p.trial_id, p.process_definition_id, p.id AS source_process_instance_id
FROM process_rows p LEFT JOIN cut c USING (experiment_id, trial_id)
WHERE c.id IS NULL OR p.started > c.started OR (p.started = c.started AND p.id > c.id)""",
        "active_cores": _with(ENVIRONMENT, CORES, HOSTS, CONTAINERS) + """SELECT experiment_id, trial_id,
  container_id, host_id, CAST(coalesce(set_size, n_cpu) AS BIGINT) AS cores,
  coalesce(limit_bytes, mem_total) AS bytes FROM containers LEFT JOIN hosts USING (host_id)""",
        "trial_cpu": _with(ENVIRONMENT, CORES, HOSTS, CONTAINERS, summary("s", "environment", CONTAINER, order="at_time"))
        + f"""SELECT {_list(CONTAINER)}, {shown("cpu", 8, integral=True)},
  CAST(coalesce(set_size, n_cpu) AS BIGINT) AS cpu_cores,
  round(integral / nullif(max * num_data_points, 0), 12) AS relative_efficency,
  round(integral / (100.0 * num_data_points), 12) AS absolute_efficency
FROM s LEFT JOIN containers USING (experiment_id, trial_id, container_id, host_id) LEFT JOIN hosts USING (host_id)""",
        "trial_cpu_core": _with(CORE_TRIAL) + f"""SELECT {_list(CONTAINER, "g.")}, CAST(g.cpu_cores AS BIGINT) AS cpu_cores,
  g.readings AS cpu_num_data_points, g.core, {shown("cpu", integral=True, n=False, alias="r.")}
FROM core_grid g LEFT JOIN core_rows r ON r.experiment_id = g.experiment_id AND r.trial_id = g.trial_id
  AND r.container_id = g.container_id AND r.host_id = g.host_id AND r.core = g.core""",
        "trial_ram": _with(ENVIRONMENT, CORES, HOSTS, CONTAINERS, summary("s", "environment", CONTAINER, order="at_time"))
        + f"""SELECT {_list(CONTAINER)}, {shown("ram", 8, modes=True, integral=True)},
  round(integral / nullif(max * num_data_points, 0), 8) AS relative_efficency,
  round(integral * 1048576 / (coalesce(limit_bytes, mem_total) * CAST(num_data_points AS DOUBLE)), 8) AS absolute_efficency
FROM s LEFT JOIN containers USING (experiment_id, trial_id, container_id, host_id) LEFT JOIN hosts USING (host_id)""",
        "trial_io": _with(IO) + "SELECT * FROM trial_io",
        "trial_byte_size": _with(SIZES) + "SELECT * FROM trial_size",
        "trial_execution_time": _with(PROCESS, EXECUTION)
        + f"SELECT {_list(PROCESS_KEYS)}, round(execution_time, 6) AS execution_time FROM execution",
        "trial_process_duration": _with(PROCESS, summary("s", "process_all", PROCESS_KEYS))
        + f"SELECT {_list(PROCESS_KEYS)}, {shown('process_duration', modes=True)} FROM s",
        "trial_number_of_process_instances": _with(PROCESS, EXECUTION)
        + f"SELECT {_list(PROCESS_KEYS)}, instances AS number_of_process_instances FROM execution",
        "trial_throughput": _with(PROCESS, EXECUTION)
        + f"SELECT {_list(PROCESS_KEYS)}, round(throughput, 12) AS throughput FROM throughput",
        "trial_process_totals": _with(PROCESS, EXECUTION) + f"""SELECT {_list(PROCESS_KEYS)}, round(execution_time, 6) AS execution_time,
  instances AS number_of_process_instances, round(throughput, 12) AS throughput
FROM execution JOIN throughput USING ({_list(PROCESS_KEYS)})""",
        "trial_construct_duration": _with(CONSTRUCT, summary("s", "construct_all", CONSTRUCT_KEYS))
        + f"SELECT {_list(CONSTRUCT_KEYS)}, {shown('construct_duration', modes=True)} FROM s",
        "trial_number_of_construct_instances": _with(CONSTRUCT, CONSTRUCT_COUNT)
        + f"SELECT {_list(CONSTRUCT_KEYS)}, instances AS number_of_construct_instances FROM construct_count",
        "trial_driver_details": _with(DRIVER, """details AS (
  SELECT experiment_id, trial_id, host, o_orderpriority AS op_name,
         CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linestatus = 'O' THEN 'WebDriver Throughput'
              ELSE 'WebDriver Response Times' END AS section,
         l_shipdate AS at_time, CASE WHEN l_tax < 0.075 THEN l_quantity END AS x FROM driver),
cells AS (SELECT * FROM details WHERE section IS NOT NULL AND x IS NOT NULL),
grid AS (
  SELECT h.experiment_id, h.trial_id, host, section, op_name
  FROM (SELECT DISTINCT experiment_id, trial_id, host FROM details
        UNION SELECT DISTINCT experiment_id, trial_id, 'aggregate' FROM details) h
  JOIN (SELECT DISTINCT experiment_id, trial_id, op_name FROM details) o
    ON o.experiment_id = h.experiment_id AND o.trial_id = h.trial_id,
  (VALUES ('WebDriver Throughput'), ('WebDriver Response Times')) v(section))""",
            summary("s", "cells", detail_keys, order="at_time")) + f"""SELECT experiment_id, trial_id,
  host AS faban_details_host, section AS faban_details_section, op_name AS faban_details_op_name,
  coalesce(num_data_points, 0) AS faban_details_num_data_points, coalesce(mode_ties, 0) AS faban_details_mode_ties,
  {shown("faban_details", modes=True, integral=True, n=False).replace(", CAST(mode_ties AS BIGINT) AS faban_details_mode_ties", "")}
FROM grid LEFT JOIN s USING ({_list(detail_keys)})""",
        "exp_cpu": _usage_job("cpu", 1.0, False),
        "exp_cpu_core": _with(CORE_TRIAL) + f"""SELECT experiment_id, container_name, host_id,
  min(CAST(cpu_cores AS BIGINT)) OVER (PARTITION BY experiment_id, container_name, host_id) AS cpu_cores, core,
  {", ".join(f"round({s}, 6) AS cpu_{s}" for s in CORE_RESULTS)} FROM core_exp""",
        "exp_ram": _usage_job("ram", 1048576, True),
        "exp_io": _measures_job(
            [IO], "trial_io", ["experiment_id", "container_name", "host_id", "device"],
            ["reads", "writes", "total"], ["reads", "writes", "total"], 3,
            {"writes": ("variance",), "total": ("variance",)},
        ),
        "exp_byte_size": _describe_job([SIZES], "trial_size", [single], "size", "size", 1, ("variance",)),
        "exp_execution_time": _describe_job(
            [PROCESS, EXECUTION], "execution", [single, "process_definition_id"], "execution_time", "execution_time",
            significant=("variance",),
        ),
        "exp_throughput": _describe_job(
            [PROCESS, EXECUTION], "throughput", [single, "process_definition_id"], "throughput", "throughput", 12
        ),
        "exp_number_of_process_instances": _describe_job(
            [PROCESS, EXECUTION], "execution", [single, "process_definition_id"], "instances",
            "number_of_process_instances",
        ),
        "exp_number_of_construct_instances": _describe_job(
            [CONSTRUCT, CONSTRUCT_COUNT], "construct_count", [single, "construct_type", "construct_name"], "instances",
            "number_of_construct_instances",
        ),
        "exp_process_duration": _with(
            PROCESS, summary("s", "process_all", PROCESS_KEYS),
            rolled("rolled", "s", [single, "process_definition_id"]),
        ) + f"SELECT experiment_id, process_definition_id, {shown_roll('process_duration', True)} FROM rolled",
        "exp_construct_duration": _with(
            CONSTRUCT, summary("s", "construct_all", CONSTRUCT_KEYS),
            rolled("rolled", "s", [single, "construct_type", "construct_name"]),
        ) + f"""SELECT experiment_id, construct_type, construct_name, {shown_roll("construct_duration", True)}
FROM rolled""",
        "exp_driver_total_ops": _with(DRIVER) + """SELECT experiment_id, host AS faban_driver_host,
  l_returnflag AS faban_driver_name, round(avg(l_quantity), 6) AS faban_total_ops_mean FROM driver GROUP BY ALL""",
        "exp_driver_mix": _measures_job(
            [DRIVER, f"""mix_rows AS (
  SELECT experiment_id, {op_columns}, floor(l_quantity) AS successes,
         CASE WHEN l_tax < 0.075 THEN floor(l_extendedprice / 1000) END AS failures, l_discount AS mix FROM driver)"""],
            "mix_rows", op_keys, ["successes", "failures", "mix"],
            ["faban_successes", "faban_failures", "faban_mix"], 8, {},
        ),
        "exp_driver_delay_times": _with(DRIVER) + f"""SELECT experiment_id, {op_columns},
  round(avg(l_quantity), 6) AS faban_delay_times_weighted_avg, round(min(l_tax), 6) AS faban_delay_times_min,
  round(max(l_extendedprice), 6) AS faban_delay_times_max FROM driver GROUP BY ALL""",
        "exp_driver_response_times": _with(DRIVER) + f"""SELECT experiment_id, {op_columns},
  o_orderpriority AS faban_op_stat_name, round(min(l_extendedprice), 6) AS faban_op_stat_min,
  round(max(l_extendedprice), 6) AS faban_op_stat_max FROM driver GROUP BY ALL""",
        "exp_driver_custom_absolute": _with(
            DRIVER, custom, "absolute AS (SELECT * FROM custom WHERE faban_stat_name = 'O')",
            summary("s", "absolute", custom_keys),
        ) + f"SELECT {_list(custom_keys)}, {shown('faban_stat', modes=True)} FROM s",
        "exp_driver_custom_statistic": _with(DRIVER, custom) + f"""SELECT {_list(custom_keys)},
  round(min(x), 6) AS faban_stat_min, round(max(x), 6) AS faban_stat_max
FROM custom WHERE faban_stat_name <> 'O' GROUP BY ALL""",
    }
    details = out["trial_driver_details"].removeprefix("WITH ").split(",\ngrid AS (")[0]
    mix_rows = f"""mix_rows AS (
  SELECT experiment_id, {op_columns}, floor(l_quantity) AS successes,
         CASE WHEN l_tax < 0.075 THEN floor(l_extendedprice / 1000) END AS failures, l_discount AS mix FROM driver)"""
    usage_keys = ["experiment_id", "container_name", "host_id"]
    out |= {
        "levene_cut": out["levene_statistics"].split("SELECT\n  experiment_id")[0] + P_VALUES,
        "levene_p_values": out["levene_statistics"].split("SELECT\n  experiment_id")[0] + P_VALUES,
        "trial_slice": out["trial_execution_time"] + " WHERE experiment_id = 'p1' AND trial_id = 'p1_2'",
        "warmup_trim_long": out["warmup_trim"].replace("'p' || (user_id % 3) || '_' || (user_id % 5) AS trial_id", "'all' AS trial_id").replace("rn = 20", "rn = 1100"),
        "trial_ram_modes": modes([ENVIRONMENT], "environment", CONTAINER),
        "trial_process_duration_modes": modes([PROCESS], "process_all", PROCESS_KEYS),
        "trial_construct_duration_modes": modes([CONSTRUCT], "construct_all", CONSTRUCT_KEYS),
        "trial_driver_details_modes": modes([details], "cells", detail_keys,
                                            names={c: f"faban_details_{c}" for c in ("host", "section", "op_name")}),
        "exp_cpu_ranking": ranked([ENVIRONMENT], "environment", CONTAINER, usage_keys),
        "exp_ram_ranking": ranked([ENVIRONMENT], "environment", CONTAINER, usage_keys),
        "exp_process_duration_ranking": ranked([PROCESS], "process_all", PROCESS_KEYS, [single, "process_definition_id"]),
        "exp_construct_duration_ranking": ranked([CONSTRUCT], "construct_all", CONSTRUCT_KEYS, [single, "construct_type", "construct_name"]),
        "exp_io_modes": measure_modes([IO], "trial_io", [*usage_keys, "device"], ["reads", "writes", "total"]),
        "exp_byte_size_modes": modes([SIZES], "trial_size", [single], "size"),
        "exp_throughput_modes": modes([PROCESS, EXECUTION], "throughput", [single, "process_definition_id"], "throughput", digits=9),
        "exp_number_of_process_instances_modes": modes([PROCESS, EXECUTION], "execution", [single, "process_definition_id"], "instances"),
        "exp_number_of_construct_instances_modes": modes(
            [CONSTRUCT, CONSTRUCT_COUNT], "construct_count", [single, "construct_type", "construct_name"], "instances"),
        "exp_driver_mix_modes": measure_modes([DRIVER, mix_rows], "mix_rows", op_keys, ["successes", "failures", "mix"]),
        "exp_driver_custom_absolute_modes": modes(
            [DRIVER, custom, "absolute AS (SELECT * FROM custom WHERE faban_stat_name = 'O')"], "absolute", custom_keys),
    }
    same = " AND ".join(f"m.{k} IS NOT DISTINCT FROM s.{k}" for k in CONTAINER)
    shown_ram = ", ".join(f"s.{c}" for c in [*CONTAINER, "ram_num_data_points", "ram_mean", "ram_q2", "ram_mode_ties"])
    absolute, others = out["exp_driver_custom_absolute"], out["exp_driver_custom_statistic"]
    out |= {
        "upsert_by_key": _with(IO) + f"""SELECT {_list(CONTAINER)}, device,
  CASE WHEN device <> 'R' AND trial_id <> 'F_3' THEN reads ELSE -1 END AS reads, writes,
  CASE WHEN device <> 'R' AND trial_id <> 'F_3' THEN total END AS total FROM trial_io""",
        "ram_results": f"""SELECT {shown_ram}, m.mode, m.mode_freq
FROM ({out["trial_ram"].replace(", 8) AS ram_", f", {DIGITS}) AS ram_")}) s JOIN ({out["trial_ram_modes"]}) m ON {same}""",
        "custom_results": f"""SELECT {_list(custom_keys)}, faban_stat_min, faban_stat_max, 'absolute' AS target FROM ({absolute})
UNION ALL SELECT {_list(custom_keys)}, faban_stat_min, faban_stat_max, 'statistic' AS target FROM ({others})""",
    }
    run_rows = """runs AS (
  SELECT experiment_id, host AS faban_host, floor(l_quantity) AS duration, l_extendedprice AS metric_value FROM driver)"""
    out["exp_driver_run_info_modes"] = measure_modes([DRIVER, run_rows], "runs", ["experiment_id", "faban_host"], ["duration", "metric_value"])
    run_keys = ["experiment_id", "faban_host"]
    run = _measures_job(
        [DRIVER, """runs AS (
  SELECT experiment_id, host AS faban_host, floor(l_quantity) AS duration, l_extendedprice AS metric_value,
         CASE WHEN l_quantity = 50 AND l_discount > 0.095 THEN (CASE WHEN l_tax < 0.045 THEN NULL ELSE FALSE END)
              ELSE TRUE END AS passed FROM driver),
flags AS (SELECT experiment_id, faban_host, bool_and(coalesce(passed, FALSE)) AS faban_passed FROM runs GROUP BY ALL)"""],
        "runs", run_keys, ["duration", "metric_value"], ["faban_duration", "faban_metric_value"], 4,
        {"metric_value": ("variance",)},
    )
    out["exp_driver_run_info"] = run.replace(
        "SELECT m0.experiment_id", "SELECT 'ops/sec' AS faban_metric_unit, f.faban_passed, m0.experiment_id"
    ) + f" JOIN flags f USING ({_list(run_keys)})"
    return out
