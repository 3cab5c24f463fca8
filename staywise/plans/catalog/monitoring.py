"""The prediction log and its reports, as batch and as stream, with the events as the log."""

import uuid

from pyspark.sql import functions as F

from staywise.operators import monitoring, quantile_state, scoring
from staywise.plans.catalog.registry import PROPS_K, query, table
from staywise.session import work_dir
from staywise.sources import tables
from staywise.streaming import jobs

PROBABILITY_SQL = "value / (value + 50.0)"
THRESHOLD = 0.4
LOG_SQL = f"""SELECT ts AS created_at, event_type AS source, {PROBABILITY_SQL} AS probability,
    cast({PROBABILITY_SQL} >= {THRESHOLD} AS int) AS decision, {THRESHOLD} AS threshold FROM events"""


def as_log(events):
    """Events as log rows; works on a table and on a stream."""
    score = F.expr(PROBABILITY_SQL)
    return events.select(
        F.col("ts").alias("created_at"),
        F.col("event_type").alias("source"),
        score.alias("probability"),
        (score >= THRESHOLD).cast("int").alias("decision"),
        F.lit(THRESHOLD).alias("threshold"),
    )


def log_table(spark, sf_dir):
    return as_log(table(spark, sf_dir, "events"))


def scored_events(spark, sf_dir):
    """Scored rows with their input row carried along."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.expr(PROPS_K).alias("k"), "value"
    )
    payload = F.struct(
        "event_id", F.col("event_type").alias("événement"), F.nullif(F.col("k"), F.lit(7)).alias("k")
    )
    scored = events.withColumns({"_raw": payload, "proba_depart": F.expr(PROBABILITY_SQL)})
    return scoring.decide(scored, THRESHOLD)


PAYLOAD_SQL = f"""concat('{{"event_id":', event_id, ',"événement":"', event_type, '","k":',
    coalesce(cast(nullif({PROPS_K}, 7) AS varchar), 'null'), '}}')"""


@query(
    "prediction_log",
    f"""SELECT user_id AS id_employee, 'csv_file' AS source, {PROBABILITY_SQL} AS probability,
        cast({PROBABILITY_SQL} >= {THRESHOLD} AS int) AS decision, cast({THRESHOLD} AS double) AS threshold,
        {PAYLOAD_SQL} AS payload FROM events""",
)
def prediction_log(spark, sf_dir):
    return monitoring.build_log(
        scored_events(spark, sf_dir), "csv_file", THRESHOLD, F.col("_raw"), key="user_id"
    )


@query(
    "log_sink",
    f"""SELECT 'csv_file' AS source, decision, count(*) AS n, count(*) AS n_stamped, count(*) AS n_ids
        FROM ({LOG_SQL}) GROUP BY decision""",
)
def log_sink(spark, sf_dir):
    """Append the log rows to the log table; the sink stamps them with an id and the time."""
    database = f"log_{uuid.uuid4().hex[:12]}"
    tables.create_tables(spark, database, work_dir(spark, database))
    entries = monitoring.build_log(
        scored_events(spark, sf_dir), "csv_file", THRESHOLD, F.col("_raw"), key="user_id"
    )
    tables.append_log(entries, database)
    return (
        spark.table(f"{database}.{tables.LOG_TABLE}")
        .groupBy("source", "decision")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("created_at").alias("n_stamped"),
            F.countDistinct("log_id").alias("n_ids"),
        )
    )


VOLUME_SQL = f"SELECT source, count(*) AS n FROM ({LOG_SQL}) GROUP BY source"
TREND_SQL = f"""SELECT strftime(created_at, '%Y-%m-%d') AS day, count(*) AS n, round(avg(decision), 9) AS rate
    FROM ({LOG_SQL}) GROUP BY 1"""
USAGE_SQL = f"""SELECT strftime(created_at, '%Y-%m-%d') AS day, source, count(*) AS n
    FROM ({LOG_SQL}) GROUP BY 1, 2"""


@query("log_volume", VOLUME_SQL)
def log_volume(spark, sf_dir):
    return monitoring.log_volume(log_table(spark, sf_dir))


@query(
    "score_hist",
    f"""SELECT cast(least(floor(probability * 10), 9) AS int) AS bin, count(*) AS n,
        count(*) FILTER (probability >= threshold) AS n_above FROM ({LOG_SQL}) GROUP BY 1""",
)
def score_hist(spark, sf_dir):
    return monitoring.score_histogram(log_table(spark, sf_dir), "probability", "threshold")


def _trend(log):
    return monitoring.decision_trend(log, "created_at", "decision")


def _usage(log):
    return monitoring.daily_usage(log, "created_at", "source")


def _by_day(report, *columns):
    return report.select(F.date_format("period", "yyyy-MM-dd").alias("day"), *columns)


@query("decision_trend", TREND_SQL)
def decision_trend(spark, sf_dir):
    return _by_day(_trend(log_table(spark, sf_dir)), "n", F.round("rate", 9).alias("rate"))


@query("daily_usage", USAGE_SQL)
def daily_usage(spark, sf_dir):
    return _by_day(_usage(log_table(spark, sf_dir)), "source", "n")


@query(
    "drilldown",
    f"""SELECT "événement", k, cast(grouping("événement", k) AS bigint) AS level, count(*) AS n,
        round(avg(decision), 9) AS rate FROM (SELECT event_type AS "événement",
        cast(nullif({PROPS_K}, 7) AS varchar) AS k, cast({PROBABILITY_SQL} >= {THRESHOLD} AS int) AS decision
        FROM events) GROUP BY CUBE ("événement", k)""",
)
def drilldown(spark, sf_dir):
    """Rates by attributes that are read back out of the logged payload."""
    log = monitoring.build_log(
        scored_events(spark, sf_dir), "csv_file", THRESHOLD, F.col("_raw"), key="user_id"
    )
    found = monitoring.drill_down(log, ["événement", "k"], "`événement` string, k int", "decision")
    return found.withColumn("rate", F.round("rate", 9))


PERIOD_SQL = "CASE WHEN l_linestatus = 'O' THEN 'base' ELSE 'current' END"


def two_periods(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("period", F.expr(PERIOD_SQL))


def _psi_sql(counted: str, feature: str) -> str:
    return f"""SELECT '{feature}' AS feature, count(*) AS n_bins, round(sum((c - b) * ln(c / b)), 9) AS psi FROM (
        SELECT greatest(n_base / sum(n_base) OVER (), 1e-6) AS b, greatest(n_current / sum(n_current) OVER (), 1e-6) AS c
        FROM ({counted}))"""


_EDGES = "[" + ", ".join(str(i / 10) for i in range(1, 10)) + "]"
_COUNTS = "count(*) FILTER (period = 'base') AS n_base, count(*) FILTER (period = 'current') AS n_current"


@query(
    "drift_psi",
    _psi_sql(
        f"""SELECT bin, {_COUNTS} FROM (SELECT period, len(list_filter(list_distinct(edges), lambda e: v > e)) AS bin
            FROM (SELECT {PERIOD_SQL} AS period, l_extendedprice AS v FROM lineitem),
            (SELECT quantile_cont(l_extendedprice, {_EDGES}) AS edges FROM lineitem WHERE l_linestatus = 'O'))
            GROUP BY bin""",
        "l_extendedprice",
    ),
)
def drift_psi(spark, sf_dir):
    found = monitoring.drift_psi(two_periods(spark, sf_dir), "l_extendedprice", "period", "base", "current")
    return found.withColumn("psi", F.round("psi", 9))


STATE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount")
_BIN_SQL = f"CASE WHEN v = 0 THEN 0 ELSE ceil(ln(v) / {quantile_state.log_base()!r}) + {quantile_state.OFFSET} END"
_NAMES = ", ".join(f"'{c}'" for c in STATE_COLUMNS)
_BINNED_SQL = f"""SELECT feature, {_BIN_SQL} AS bin, d FROM (SELECT unnest([{_NAMES}]) AS feature,
    unnest([{", ".join(STATE_COLUMNS)}]) AS v, l_shipdate AS d FROM lineitem)"""
BASE_DAYS, CURRENT_DAYS = ("1995-01-01", "1997-12-31"), ("1998-01-01", "1998-06-30")


def month_state(spark, sf_dir):
    """Folder with the state of each month of shipping; one of them is written twice, which changes nothing."""
    items = table(spark, sf_dir, "lineitem").select(F.trunc("l_shipdate", "month").alias("month"), *STATE_COLUMNS)
    path = work_dir(spark, "quantile-state")
    counts = quantile_state.bin_counts(items, STATE_COLUMNS, "month")
    quantile_state.store_state(counts, path)
    quantile_state.store_state(counts.where("period = DATE '1998-03-01'"), path)
    return path


@query(
    "state_drift",
    f"""WITH b AS ({_BINNED_SQL}), base AS (SELECT * FROM b WHERE d >= '{BASE_DAYS[0]}' AND d < '1998-01-01'),
        current AS (SELECT * FROM b WHERE d >= '{CURRENT_DAYS[0]}' AND d < '1998-07-01'),
        edges AS (SELECT feature, list_distinct([{", ".join(f"list_sort(list(bin))[cast(floor((count(*) - 1) * {i / 10}) AS bigint) + 1]" for i in range(1, 10))}]) AS e
            FROM base GROUP BY feature),
        counted AS (SELECT feature, len(list_filter(e, lambda x: x < bin)) AS number, sum(o) AS n_base, sum(1 - o) AS n_current
            FROM (SELECT feature, bin, 1 AS o FROM base UNION ALL SELECT feature, bin, 0 FROM current) JOIN edges USING (feature) GROUP BY 1, 2)
        SELECT feature, count(*) AS n_bins, round(sum((c - s) * ln(c / s)), 9) AS psi FROM (SELECT feature,
            greatest(n_base / sum(n_base) OVER (PARTITION BY feature), 1e-6) AS s,
            greatest(n_current / sum(n_current) OVER (PARTITION BY feature), 1e-6) AS c FROM counted) GROUP BY feature""",
)
def state_drift(spark, sf_dir):
    """Drift of three columns between two periods, from the stored months and not from the rows."""
    path = month_state(spark, sf_dir)
    base, current = (quantile_state.state_between(spark, path, *days) for days in (BASE_DAYS, CURRENT_DAYS))
    return quantile_state.drift_from_states(base, current).withColumn("psi", F.round("psi", 9))


@query(
    "state_quantiles",
    f"""SELECT feature, n, {", ".join(f"CASE WHEN q{i} = 0 THEN 0.0 ELSE round(exp((q{i} - {quantile_state.OFFSET}) * {quantile_state.log_base()!r}) * {2 / (1.01 / 0.99 + 1)!r}, 6) END AS p{i}" for i in (5, 50, 95))}
        FROM (SELECT feature, count(*) AS n, {", ".join(f"list_sort(list(bin))[cast(floor((count(*) - 1) * {i / 100}) AS bigint) + 1] AS q{i}" for i in (5, 50, 95))}
        FROM ({_BINNED_SQL}) WHERE d >= '{BASE_DAYS[0]}' AND d < '1998-07-01' GROUP BY feature)""",
)
def state_quantiles(spark, sf_dir):
    """Quantiles of three columns over all stored months of both periods."""
    state = quantile_state.state_between(spark, month_state(spark, sf_dir), BASE_DAYS[0], CURRENT_DAYS[1])
    found = quantile_state.state_quantiles(state, (0.05, 0.5, 0.95))
    return found.select(
        "feature", "n", *[F.round(F.col("quantiles")[i], 6).alias(c) for i, c in enumerate(("p5", "p50", "p95"))]
    )


@query(
    "drift_psi_category",
    _psi_sql(
        f"SELECT l_returnflag, {_COUNTS} FROM (SELECT {PERIOD_SQL} AS period, l_returnflag FROM lineitem) GROUP BY 1",
        "l_returnflag",
    ),
)
def drift_psi_category(spark, sf_dir):
    found = monitoring.drift_psi_category(
        two_periods(spark, sf_dir), "l_returnflag", "period", "base", "current"
    )
    return found.withColumn("psi", F.round("psi", 9))


@query(
    "drift_ks",
    f"""SELECT 'l_extendedprice' AS feature, cast(max(tb) AS bigint) AS n_base, cast(max(tc) AS bigint) AS n_current,
        round(max(abs(cb / tb - cc / tc)), 9) AS ks FROM (SELECT sum(b) OVER w AS cb, sum(c) OVER w AS cc,
        sum(b) OVER () AS tb, sum(c) OVER () AS tc FROM (SELECT v, count(*) FILTER (period = 'base') AS b,
        count(*) FILTER (period = 'current') AS c FROM (SELECT {PERIOD_SQL} AS period, l_extendedprice AS v
        FROM lineitem) GROUP BY v) WINDOW w AS (ORDER BY v))""",
)
def drift_ks(spark, sf_dir):
    found = monitoring.drift_ks(two_periods(spark, sf_dir), "l_extendedprice", "period", "base", "current")
    return found.withColumn("ks", F.round("ks", 9))


@query(
    "latency",
    """SELECT count(*) AS n, round(quantile_cont(s, 0.5), 6) AS p50, round(quantile_cont(s, 0.95), 6) AS p95,
        round(quantile_cont(s, 0.99), 6) AS p99 FROM (SELECT cast(round(value * 1000) AS bigint) / 1e6 AS s FROM events)""",
)
def latency(spark, sf_dir):
    """Seconds from request to log entry; the event's value stands for them, in milliseconds."""
    delay = F.round(F.col("value") * 1000).cast("bigint")
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("created_at"), delay.alias("d"))
    log = events.withColumn("requested_at", F.timestamp_micros(F.unix_micros("created_at") - F.col("d")))
    found = monitoring.latency(log, "requested_at", "created_at")
    return found.select("n", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")])


LEVEL_SQL = "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END"


@query(
    "error_counts",
    f"""SELECT strftime(ts, '%Y-%m-%d') AS day, {LEVEL_SQL} AS level, count(*) AS n
        FROM events WHERE event_type <> 'click' GROUP BY 1, 2""",
)
def error_counts(spark, sf_dir):
    """Lines of a run log, some of them a continuation without time and level."""
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"),
        F.lit(" | "),
        F.rpad(F.expr(LEVEL_SQL), 8, " "),
        F.lit(" | user "),
        F.col("user_id").cast("string"),
    )
    lines = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "click", F.lit("  continued")).otherwise(line).alias("value")
    )
    return monitoring.error_counts(lines)


def _stream(spark, sf_dir, report, mode="complete"):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return jobs.report_stream(
        spark, sf_dir, schema, report, "ts", mode=mode, files="events.parquet", prepare=None
    )


@query("stream_volume", VOLUME_SQL)
def stream_volume(spark, sf_dir):
    return _stream(spark, sf_dir, lambda s: monitoring.log_volume(as_log(s)))


@query("stream_trend", TREND_SQL)
def stream_trend(spark, sf_dir):
    return _by_day(
        _stream(spark, sf_dir, lambda s: _trend(as_log(s))), "n", F.round("rate", 9).alias("rate")
    )


@query("stream_usage", USAGE_SQL)
def stream_usage(spark, sf_dir):
    return _by_day(_stream(spark, sf_dir, lambda s: _usage(as_log(s))), "source", "n")


@query(
    "stream_usage_closed",
    f"""SELECT * FROM ({USAGE_SQL}) WHERE day::date + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM events)""",
)
def stream_usage_closed(spark, sf_dir):
    """Append mode: only the days that the watermark, one day behind the latest event, has closed."""
    return _by_day(_stream(spark, sf_dir, lambda s: _usage(as_log(s)), "append"), "source", "n")


ARRIVALS = 4


@query("stream_update", USAGE_SQL)
def stream_update(spark, sf_dir):
    """Update mode: events arrive up to 16 hours late, in four lots; the state holds the days that are still open."""
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod("event_id", F.lit(5)) * 4 * 3_600_000_000
    events = table(spark, sf_dir, "events").withColumn("arrival", arrival)
    first, last = events.agg(F.min("arrival"), F.max("arrival")).first()
    folder, path, keys = work_dir(spark, "arrivals"), work_dir(spark, "report"), ["period", "source"]
    if first is None:
        first, last = 0, 0
    lot = F.least(F.floor((F.col("arrival") - first) * ARRIVALS / F.lit(max(1, last - first))), F.lit(ARRIVALS - 1))
    lots = events.withColumn("lot", lot)
    for i in range(ARRIVALS):  # each call of the stream goes on where the one before stopped
        lots.where(F.coalesce("lot", F.lit(0)) == i).drop("arrival", "lot").write.mode("append").parquet(folder)
        schema = table(spark, sf_dir, "events").schema
        stream = jobs.with_event_time(jobs.read_stream(spark, folder, schema), "ts", "1 day")
        report = _usage(as_log(stream))
        jobs.run_available(report, path, "update", keys=keys, compact_every=3)
    return _by_day(jobs.merged_table(spark, path, report.schema, keys), "source", "n")


@query(
    "stream_score",
    f"""SELECT event_type, prediction, count(*) AS n, round(avg(p), 9) AS mean_score FROM (SELECT event_type,
        {PROBABILITY_SQL} AS p, cast({PROBABILITY_SQL} >= {THRESHOLD} AS int) AS prediction FROM events)
        GROUP BY event_type, prediction""",
)
def stream_score(spark, sf_dir):
    """Rows scored as they arrive and appended to a table, read back as a whole."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    scored = jobs.score_stream(
        spark,
        sf_dir,
        schema,
        lambda s: s.select("event_id", "event_type", F.expr(PROBABILITY_SQL).alias("proba_depart")),
        lambda s: scoring.decide(s, THRESHOLD),
        work_dir(spark, "scores"),
        files="events.parquet",
    )
    return scored.groupBy("event_type", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("proba_depart"), 9).alias("mean_score")
    )
