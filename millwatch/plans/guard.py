"""The whole job: raw topics to evaluated readings, on tables and on streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from millwatch.functions.frames import localize
from millwatch.operators import context, parse, rules
from millwatch.operators.ordered import Cuts
from millwatch.operators.windows import LATENESS
from millwatch.plans import views
from millwatch.streaming import late, rule_state, sinks, stateful


def evaluate_topics(telemetry_raw: DataFrame, context_events: DataFrame, rule_rows: DataFrame,
                    cuts: Cuts | None = None) -> DataFrame:
    """Parse, keep the good readings, attach runs and anomalies, judge the rules."""
    readings = parse.good(parse.parse_telemetry(telemetry_raw))
    placed = context.attach_context(readings, context_events, anomalies=True, cuts=cuts)
    return rules.evaluate(placed, rules.latest_rules(rule_rows))


def breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaches of the temperature rule per machine and run."""
    hot = views.rules(spark).where((F.col("measurement") == "gas_temperature") & rules.is_instant()
                                   & (F.col("condition") == "greater_than"))
    cuts = views.cuts(spark, sf_dir)
    evaluated = evaluate_topics(views.raw_telemetry(spark, sf_dir), views.context(spark, sf_dir, cuts), hot, cuts)
    return (
        evaluated.where(~F.col("passed")).groupBy("machine_id", "run_id")
        .agg(F.count(F.lit(1)).alias("breaches"), F.max("gas_temperature").alias("max_temperature"),
             F.min("timestamp").alias("first_breach"))
    )


def start_guard(telemetry_raw: DataFrame, context_raw: DataFrame, read_rules: Callable[[], DataFrame],
                targets: sinks.Targets, checkpoint: str, *, once: bool = False,
                interval: str = sinks.FLUSH_INTERVAL, lateness: str = LATENESS, keep_ms: int = stateful.KEEP_MS,
                partitions: int | None = None, ticks: DataFrame | None = None) -> list[StreamingQuery]:
    """The running job over raw topics: ``start_evaluation`` of what parses, and the rest as dead letters.

    Readings and context events that do not parse, or have a clock ahead of time, go to the error topic.
    """
    parsed = parse.check_clock(parse.parse_telemetry(telemetry_raw))
    parsed_context = parse.check_clock(parse.parse_context(context_raw))
    failed = parse.failures(parsed, "telemetry-parser").unionByName(
        parse.failures(parsed_context, "context-parser"))

    def write_errors(batch: DataFrame, batch_id: int) -> None:
        sinks.write_errors(batch, batch_id, targets)

    started = start_evaluation(parse.good(parsed), parse.good(parsed_context), read_rules, targets, checkpoint, once=once,
                               interval=interval, lateness=lateness, keep_ms=keep_ms, partitions=partitions, ticks=ticks)
    if targets.errors:
        started.append(sinks.start(failed, write_errors, f"{checkpoint}/errors", once=once, interval=interval,
                                   name="errors", partitions=partitions))
    return started


def start_evaluation(readings: DataFrame, events: DataFrame, read_rules: Callable[[], DataFrame],
                     targets: sinks.Targets, checkpoint: str, *, once: bool = False,
                     interval: str = sinks.FLUSH_INTERVAL, lateness: str = LATENESS, keep_ms: int = stateful.KEEP_MS,
                     partitions: int | None = None, ticks: DataFrame | None = None) -> list[StreamingQuery]:
    """The running job, as queries with their own checkpoints.

    * ``evaluated``: readings in their run, once the watermark has passed them, to bronze, evaluation (with the implicit
      close that a reading is the first to follow) and alerts. ``read_rules`` is called for every micro-batch, so
      new rules count from the next one on; those that cannot be judged go to the error topic when they change.
    * ``several``: rates, durations and windows, as they arrive, as alert messages with ``change`` (1 raised, -1 withdrawn).
      These rules are taken when the query starts; its state holds readings, not verdicts, so a restart may change them.
    * ``closes``: implicit closes to the dead-letter topic.
    * ``context``, if it has a target: context events to a table. Readings that come when their context is no longer in
      state find it there, and readings that were given out before their context are given out again.

    ``ticks`` moves the watermark of a silent plant.
    """
    placed = stateful.attach_context_stream(readings, events, lateness=lateness, ticks=ticks, keep_ms=keep_ms, anomalies=True)
    closes = stateful.implicit_closes_stream(events, lateness=lateness, ticks=ticks)
    spark = readings.sparkSession
    empty = spark.createDataFrame([], readings.schema)
    at_start = rules.latest_rules(rules.complete(read_rules()))
    changes = rule_state.rule_changes_stream(readings, at_start, lateness=lateness, ticks=ticks, keep_ms=keep_ms)
    seen: dict[str, list] = {}

    def current(batch_id: int) -> DataFrame:
        """The rules that a reading by itself decides. When rules change, those that nothing judges become dead letters."""
        latest, rows = localize(rules.latest_rules(rules.complete(read_rules())))
        listed = sorted(map(str, rows)) if rows is not None else None
        if targets.errors and (listed is None or seen.get("rules") != listed):
            refused = rules.rejected_rules(latest, empty).unionByName(rule_state.several(latest, empty)[2])
            sinks.write_rejected(refused, batch_id, targets)
            seen["rules"] = listed
        return latest.where(rules.is_instant() & ~rules.is_rate())

    def write_evaluated(batch: DataFrame, batch_id: int) -> None:
        if not targets.context:
            sinks.write_batch(rules.evaluate(batch.drop("unplaced"), current(batch_id)), batch_id, targets)
            return
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)  # what comes out of state is read twice
        try:
            placed_rows = late.placed_again(held, sinks.read_context(spark, targets)).drop("unplaced")
            sinks.write_batch(rules.evaluate(placed_rows, current(batch_id)), batch_id, targets)
        finally:
            held.unpersist()

    def write_several(batch: DataFrame, batch_id: int) -> None:
        sinks.write_changes(rule_state.alerts_of(batch.where("rule_id is not null"), at_start), batch_id, targets)

    def write_closes(batch: DataFrame, batch_id: int) -> None:
        sinks.write_dlq(batch, batch_id, targets)

    def write_context(batch: DataFrame, batch_id: int) -> None:
        sinks.write_context(batch, batch_id, targets)
        first = batch.agg(F.min("timestamp")).first()[0]
        bronze = sinks.read_bronze(spark, targets, since=first) if targets.bronze and first is not None else None
        if bronze is not None and bronze.columns:
            for c in readings.columns:  # a column that bronze does not keep
                bronze = bronze if c in bronze.columns else bronze.withColumn(c, F.lit(None).cast(readings.schema[c].dataType))
            bronze = bronze.select(*readings.columns)
            changed = late.corrections(batch, bronze, sinks.read_context(spark, targets))
            latest = rules.latest_rules(rules.complete(read_rules())).where(rules.is_instant() & ~rules.is_rate())
            sinks.write_corrected(rules.evaluate(changed, latest), batch_id, targets)

    jobs = {"evaluated": (placed, write_evaluated)}
    if targets.alerts:
        jobs["several"] = (changes, write_several)
    if targets.dlq:
        jobs["closes"] = (closes, write_closes)
    if targets.context:
        jobs["context"] = (events, write_context)
    return [sinks.start(df, write, f"{checkpoint}/{name}", once=once, interval=interval, name=name, partitions=partitions)
            for name, (df, write) in jobs.items()]
