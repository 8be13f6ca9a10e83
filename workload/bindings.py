"""The given tables seen as monitoring tables, by projection only: every row takes part.

Each function returns the table of that name in ``trialstats.sources.schemas``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Schemas of the given tables, declared so that a read starts no job.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def _iso(ts: str) -> str:
    return f"date_format(CAST({ts} AS timestamp), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || '+00:00'"


def environment_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings: the type is the experiment, users are split over trials and hosts."""
    return load(spark, sf_dir, "events").selectExpr(
        "event_type AS experiment_id",
        "event_type || '_' || user_id % 5 AS trial_id",
        "'app' || user_id % 5 AS container_id",
        "'app' AS container_name",
        "'h' || (user_id div 5) % 5 AS host_id",
        "CAST(event_id AS string) AS environment_data_id",
        f"{_iso('ts')} AS read_time",
        "value AS cpu_percent_usage",
        "value * 1048576 AS memory_usage",
    )


def core_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as readings of 64 cores."""
    return load(spark, sf_dir, "embeddings").selectExpr(
        "'e' || label AS experiment_id",
        "'e' || label || '_' || vec_id % 5 AS trial_id",
        "'app' || vec_id % 5 AS container_id",
        "'app' AS container_name",
        "'h' || label % 5 AS host_id",
        "CAST(vec_id AS string) AS environment_data_id",
        f"{_iso('timestamp_seconds(vec_id)')} AS read_time",
        "CAST(embedding AS array<double>) AS cpu_percpu_percent_usage",
    )


def host_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as hosts of growing size."""
    return load(spark, sf_dir, "nation").selectExpr(
        "'h' || n_nationkey AS host_id",
        "16 * (n_nationkey % 5 + 1) AS n_cpu",
        "(n_nationkey + 1) * 1073741824L AS mem_total",
    )


def container_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The containers that occur in the readings, with limits that depend on the trial."""
    places = ["experiment_id", "trial_id", "container_id", "host_id"]
    readings = environment_data(spark, sf_dir).select(*places).union(core_data(spark, sf_dir).select(*places))
    return readings.distinct().selectExpr(
        *places,
        "CASE container_id WHEN 'app0' THEN '0-3,7' WHEN 'app1' THEN '1' WHEN 'app3' THEN '0-1,4-5' "
        "WHEN 'app4' THEN '' END AS cpu_set_cpus",
        "CASE container_id WHEN 'app0' THEN '2g' WHEN 'app1' THEN '512 mb' WHEN 'app2' THEN '0' "
        "WHEN 'app4' THEN '2099945472' END AS mem_limit",
    )


def process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as process instances; very short ones are to be ignored, some flags are unknown."""
    hundredths = "CAST(round(value * 100) AS bigint)"
    return load(spark, sf_dir, "events").selectExpr(
        "'p' || user_id % 3 AS experiment_id",
        "'p' || user_id % 3 || '_' || user_id % 5 AS trial_id",
        "CAST(event_id AS string) AS source_process_instance_id",
        "event_type AS process_name",
        "CAST(ts AS timestamp) AS start_time",
        f"timestamp_micros(unix_micros(CAST(ts AS timestamp)) + {hundredths} * 10000) AS end_time",
        f"nullif({hundredths}, 1000) AS duration",
        f"CASE WHEN {hundredths} <> 200 THEN value < 1 END AS to_ignore",
    )


def construct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as construct instances; one part type has no name of its own."""
    lines, parts = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "part")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).selectExpr(
        "l_returnflag AS experiment_id",
        "l_returnflag || '_' || l_linenumber AS trial_id",
        "CAST(l_orderkey AS string) AS source_construct_instance_id",
        "nullif(p_type, 'ECONOMY') AS construct_type",
        "p_brand AS construct_name",
        "CAST(l_quantity AS bigint) AS duration",
        "l_tax = 0 AS to_ignore",
    )


def io_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as device counters, rarely without reads."""
    lost = "l_quantity = 50 AND l_discount > 0.095D AND l_tax > 0.075D"
    reads = f"CASE WHEN NOT ({lost}) THEN floor(l_quantity) END"
    return load(spark, sf_dir, "lineitem").selectExpr(
        "l_linestatus AS experiment_id",
        "l_linestatus || '_' || l_linenumber AS trial_id",
        "'app' || l_linenumber AS container_id",
        "'app' AS container_name",
        "'h' || l_suppkey % 5 AS host_id",
        "l_returnflag AS device",
        f"{reads} AS reads",
        "floor(l_extendedprice) AS writes",
        f"{reads} + floor(l_extendedprice) AS total",
    )


def database_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as database sizes."""
    return load(spark, sf_dir, "orders").selectExpr(
        "o_orderstatus AS experiment_id",
        "o_orderstatus || '_' || o_orderpriority AS trial_id",
        "CAST(o_orderkey AS string) AS dbms",
        "floor(o_totalprice) AS size",
    )


def _driver_rows(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order lines with their order and the nation of their supplier as the host."""
    lines, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    suppliers = load(spark, sf_dir, "supplier")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        suppliers, lines.l_suppkey == suppliers.s_suppkey
    )
    return joined.selectExpr(
        "o_orderstatus AS experiment_id",
        "o_orderstatus || '_' || l_linenumber AS trial_id",
        "CASE s_nationkey WHEN 7 THEN 'aggregate' ELSE 'n' || s_nationkey END AS host",
        *columns,
    )


def faban_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _driver_rows(
        spark, sf_dir,
        "CASE WHEN l_returnflag = 'N' THEN 'CPU' WHEN l_linestatus = 'O' THEN 'WebDriver Throughput (ops/s)' "
        "ELSE 'WebDriver Response Times (s)' END AS section",
        "o_orderpriority AS op_name",
        f"{_iso('l_shipdate')} AS time",
        "CASE WHEN l_tax < 0.075D THEN l_quantity END AS value",
    )


def faban_driver_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _driver_rows(
        spark, sf_dir, "l_returnflag AS name", "l_quantity AS total_ops_value", "'ops' AS total_ops_unit"
    )


def faban_driver_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _driver_rows(
        spark, sf_dir, "l_returnflag AS driver_name", "l_linestatus AS op_name",
        "floor(l_quantity) AS successes",
        "CASE WHEN l_tax < 0.075D THEN floor(l_extendedprice / 1000) END AS failures",
        "l_discount AS mix",
    )


def faban_driver_delay_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _driver_rows(
        spark, sf_dir, "l_returnflag AS driver_name", "l_linestatus AS op_name",
        "l_quantity AS actual_avg", "l_tax AS min", "l_extendedprice AS max",
    )


def faban_driver_response_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _driver_rows(
        spark, sf_dir, "l_returnflag AS driver_name", "l_linestatus AS op_name",
        "o_orderpriority AS stat_name", "l_extendedprice AS stat_value",
    )


def faban_run_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = "l_quantity = 50 AND l_discount > 0.095D"
    return _driver_rows(
        spark, sf_dir, "CAST(floor(l_quantity) AS int) AS duration", "'ops/sec' AS metric_unit",
        "l_extendedprice AS metric_value",
        f"CASE WHEN NOT ({failed}) THEN true WHEN l_tax >= 0.045D THEN false END AS passed",
    )


def faban_driver_custom_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _driver_rows(
        spark, sf_dir, "l_returnflag AS driver_name", "l_linestatus AS stat_name",
        "o_orderpriority AS description",
        "CASE WHEN l_linestatus = 'O' THEN 'absolute' WHEN l_returnflag = 'A' THEN 'statistic' END AS target",
        "l_quantity AS result",
    )
