"""The streams, run over the given tables until nothing is left to read."""

from __future__ import annotations

import os
import time

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from telemill.acceptance.averaging import _rollover_sql, rounded
from telemill.acceptance.inputs import M2_SQL, READ2_SQL, m2, m2_of, r1, table, tasks_of
from telemill.acceptance.registry import query
from telemill.functions import values as V
from telemill.operators import averages as A
from telemill.operators.clean import explode_ports
from telemill.operators.rules import RuleBook
from telemill.session import shared_folder
from telemill.sources.messages import accepted, decode, to_wire, union_of_sources
from telemill.sources.stores import MainStore
from telemill.streaming import averages as SA
from telemill.streaming.clean import Sinks, clean_stream, parquet_batches
from telemill.streaming.late import BucketStore, late_stream
from telemill.streaming.progress import ProgressLog, progress_rows
from telemill.streaming.rule_changes import RuleChanges

ONCE = {"availableNow": True}
RECORDS = SA.RECORD.replace("num bigint", "num int")
WINDOWS = (
    "did string, pidx int, avg string, interval bigint, bucket bigint, sum double, num bigint"
)


# The events are streamed in so many parts, each in micro-batches of its own.
TURNS = 3


def turn_of(event_id, last):
    return F.floor(event_id * TURNS / (last + 1))


TURN_SQL = f"seq * {TURNS} // (SELECT max(event_id) + 1 FROM events)"


class Streamed:
    """The events table as messages, put into a folder part by part and cleaned by a stream."""

    def __init__(self, spark, sf_dir, rules=None, turn=None):
        self.spark = spark
        self.folder = shared_folder(spark, "stream")
        self.inbox, self.cleaned, self.readings = (
            os.path.join(self.folder, name) for name in ("inbox", "cleaned", "readings")
        )
        self.rules = rules or (lambda: r1(spark, sf_dir))
        events = table(spark, sf_dir, "events")
        last, rows = events.agg(F.max("event_id"), F.count(F.lit(1))).first()
        # Dealt out before the text is made. Only the rows of a part get there, as filters go below.
        messages = m2_of(events.repartition(tasks_of(rows // TURNS), "event_id"))
        own = turn_of(F.col("seq"), F.lit(last)) if turn is None else turn(m2_of(events))
        self.parts = to_wire(messages.withColumn("turn", own))

    def turns(self, first=0):
        """Cleans one part more each time."""
        for turn in range(first, TURNS):
            part = self.parts.filter(F.col("turn") == turn).drop("turn")
            part.write.mode("append").parquet(self.inbox)
            running = clean_stream(
                self.spark.readStream.schema(part.schema).parquet(self.inbox),
                self.rules,
                Sinks(
                    forward=parquet_batches(self.cleaned), readings=parquet_batches(self.readings)
                ),
                os.path.join(self.folder, "checkpoint"),
                keep=("seq",),
                arrival="seq",
                trigger=ONCE,
            )
            running.awaitTermination()
            yield turn

    def run(self):
        for _ in self.turns():
            pass
        return self

    def average(self, make, write, first=0):
        """Runs an average stream over the readings after each part, with one checkpoint."""
        return self.averages([(make, write)], first)[0]

    def averages(self, streams, first=0):
        """Runs average streams over the same readings, each with a checkpoint of its own."""
        checkpoints = [
            os.path.join(self.folder, f"average-checkpoint-{n}") for n in range(len(streams))
        ]
        for _ in self.turns(first):
            schema = self.spark.read.parquet(self.readings).schema
            for (make, write), checkpoint in zip(streams, checkpoints):
                rows = self.spark.readStream.schema(schema).parquet(self.readings)
                write(make(rows), checkpoint).awaitTermination()
        return checkpoints


def run_to_table(spark, stream, folder_name):
    """Runs a stream to its end into a Parquet table."""
    folder = shared_folder(spark, folder_name)
    running = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", os.path.join(folder, "checkpoint"))
        .option("path", os.path.join(folder, "rows"))
        .trigger(**ONCE).start()
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(os.path.join(folder, "rows"))


def to_parquet(path):
    def write(stream, checkpoint):
        return (
            stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", path).trigger(**ONCE).start()
        )

    return write


def averaged(spark, sf_dir, make, schema):
    """The rows that an average stream has written after all parts."""
    path = shared_folder(spark, "averages")
    Streamed(spark, sf_dir).average(make, to_parquet(path))
    return spark.read.schema(schema).parquet(path)


def values_of(spark, path):
    ports = explode_ports(accepted(decode(spark.read.parquet(path))))
    return ports.select(
        "seq", "app", "id", "pidx", "valid", V.to_double(F.col("value")).alias("value")
    )


@query(
    "stream_clean",
    f"""WITH {READ2_SQL}
    SELECT seq, app, id, 0 AS pidx, valid, CASE WHEN cmd IS NULL THEN value ELSE x END AS value
    FROM ruled2""",
)
def stream_clean(spark, sf_dir):
    return values_of(spark, Streamed(spark, sf_dir).run().cleaned)


@query(
    "stream_rule_refresh",
    f"""WITH {M2_SQL}
    SELECT seq, app, id, 0 AS pidx, valid, (1 + {TURN_SQL})::DOUBLE + value AS value
    FROM m2""",
)
def stream_rule_refresh(spark, sf_dir):
    """All rules are edited before each part: ADD:1, ADD:2, ADD:3."""
    added = iter(range(1, TURNS + 2))
    current = {"n": 0}

    def rules():
        users = table(spark, sf_dir, "events").select("user_id").distinct()
        return users.select(
            F.lit("all").alias("app"),
            F.col("user_id").alias("id"),
            F.concat(F.lit("dev"), F.col("user_id").cast("string")).alias("did"),
            F.lit(0).alias("pidx"),
            F.lit(f"ADD:{current['n']}").alias("cmd"),
            F.lit(None).cast("string").alias("avg"),
            F.lit(1).alias("used"),
        )

    streamed = Streamed(spark, sf_dir, rules)
    current["n"] = next(added)
    for _ in streamed.turns():
        current["n"] = next(added)
    return values_of(spark, streamed.cleaned)


@query("stream_rollover", _rollover_sql("ptimestamp"))
def stream_rollover(spark, sf_dir):
    SA.use_state_store(spark)
    return rounded(averaged(spark, sf_dir, SA.rollover_stream, RECORDS)).drop("app")


@query("stream_average_records", _rollover_sql("ptimestamp"))
def stream_average_records(spark, sf_dir):
    """The records as the main store has them."""
    SA.use_state_store(spark)
    main = shared_folder(spark, "records")

    def store(records, checkpoint):
        sinks = Sinks(main=MainStore(main))
        return SA.store_records(records, sinks, checkpoint, trigger=ONCE)

    Streamed(spark, sf_dir).average(SA.rollover_stream, store)
    return rounded(spark.read.schema(RECORDS).parquet(main)).drop("app", "day", "batch")


@query(
    "stream_window_avg",
    f"""WITH {READ2_SQL}
    SELECT did, pidx, avg, "interval", bucket, round(sum(x), 4) AS sum, count(x) AS num
    FROM read2 GROUP BY did, pidx, avg, "interval", bucket
    HAVING bucket + "interval" <= (SELECT max(ptimestamp) FROM read2)""",
)
def stream_window_avg(spark, sf_dir):
    """Buckets of all intervals that have ended; messages may be a part of the table late."""
    SA.use_state_store(spark)
    return rounded(averaged(spark, sf_dir, SA.window_stream, WINDOWS))


@query(
    "stream_progress",
    """SELECT count(*) AS num_records, count(*) AS valid_num,
              CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS invalid_num,
              true AS timed
       FROM events""",
)
def stream_progress(spark, sf_dir):
    """The totals after the last micro-batch."""
    path = shared_folder(spark, "progress")
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        Streamed(spark, sf_dir).run()
        deadline = time.time() + 60  # reports come in on a thread of their own
        while time.time() < deadline and _reports(spark, path) < TURNS:
            log.flush()
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    batches = progress_rows(spark, path).filter("num_records > 0")
    timed = (F.col("processing_ms") > 0) & (F.col("total_ms") >= F.col("processing_ms"))
    return batches.agg(
        F.max("records_so_far").alias("num_records"),
        F.max("valid_so_far").alias("valid_num"),
        F.max("invalid_so_far").alias("invalid_num"),
        F.bool_and(timed).alias("timed"),
    )


def _reports(spark, path):
    try:
        return progress_rows(spark, path).filter("num_records > 0").count()
    except AnalysisException:
        return 0


# Rules as changes: all users' rules first, then, before the second part, a third is deleted and a
# third edited; before the last part a part of the deleted ones comes back.
CHANGED_SQL = f"""WITH {M2_SQL},
turned AS (SELECT *, {TURN_SQL} AS turn FROM m2)
SELECT seq, app, id, 0 AS pidx, valid,
       CASE WHEN turn = 0 OR user_id % 3 = 0 THEN value + 1.0::DOUBLE
            WHEN user_id % 3 = 1 AND (turn = 1 OR user_id % 2 = 0) THEN value
            WHEN user_id % 3 = 1 THEN value + 3.0::DOUBLE
            ELSE value * 2.0::DOUBLE END AS value
FROM turned"""


@query("stream_rule_changes", CHANGED_SQL)
def stream_rule_changes(spark, sf_dir):
    """The rules of each part, by a feed of changes that a new run goes on with each time."""
    folder = shared_folder(spark, "rule-changes")
    feed, versions = os.path.join(folder, "feed"), os.path.join(folder, "versions")
    user = F.col("user_id")
    users = table(spark, sf_dir, "events").select("user_id").distinct()

    def send(wanted, turn, cmd, used=1):
        users.filter(wanted).select(
            F.concat(F.lit("dev"), user.cast("string")).alias("did"),
            F.lit(0).alias("pidx"),
            F.lit("all").alias("app"),
            user.alias("id"),
            F.lit(cmd).alias("cmd"),
            F.lit(None).cast("string").alias("avg"),
            F.lit(used).alias("used"),
            (user + turn * 1_000_000_000).alias("seq"),
        ).write.mode("append").parquet(feed)

    def changes(after):
        return spark.read.parquet(feed).filter(F.col("seq") > after)

    send(F.lit(True), 1, "ADD:1")
    streamed = Streamed(spark, sf_dir, RuleChanges(spark, changes, versions))
    for turn in streamed.turns():
        if turn == 0:
            send(user % 3 == 1, 2, "ADD:1", 0)
            send(user % 3 == 2, 2, "MUL:2")
        elif turn == 1:
            send((user % 3 == 1) & (user % 2 == 1), 3, "ADD:3")
        streamed.rules = RuleChanges(spark, changes, versions, merge_after=2)
    return values_of(spark, streamed.cleaned)


OVERLAP_HOURS = 12


def _overlapping(messages):
    """Parts by a time of arrival up to 12 hours after a message's own, so that they overlap."""
    first, last = messages.agg(F.min("ptimestamp"), F.max("ptimestamp")).first()
    arrival = F.col("ptimestamp") + F.col("seq") % (OVERLAP_HOURS + 1) * 3_600_000
    turn = F.floor((arrival - first) * TURNS / (last - first + 1))
    return F.least(turn, F.lit(TURNS - 1))


@query(
    "stream_late_readings",
    f"""WITH {READ2_SQL},
    bounds AS (SELECT min(ptimestamp) AS first, max(ptimestamp) AS last FROM m2),
    turned AS (
      SELECT read2.*, least({TURNS - 1}, (ptimestamp + seq % {OVERLAP_HOURS + 1} * 3600000 - first)
                            * {TURNS} // (last - first + 1)) AS turn
      FROM read2, bounds),
    marks AS (SELECT t AS turn, max(ptimestamp) AS mark FROM turned, range({TURNS}) AS turns(t)
              WHERE turned.turn <= t GROUP BY t)
    SELECT did, pidx, avg, "interval", bucket, round(sum(x), 4) AS sum, count(*) AS num,
           CAST(count(*) FILTER (WHERE bucket + "interval" <= mark) AS BIGINT) AS late_num,
           CASE WHEN bucket + "interval" <= (SELECT max(mark) FROM marks) THEN round(sum(x), 4) END
             AS closed_sum
    FROM turned LEFT JOIN marks ON marks.turn = turned.turn - 1
    GROUP BY did, pidx, avg, "interval", bucket""",
)
def stream_late_readings(spark, sf_dir):
    """Every bucket with its late readings counted, and the last record of those that are closed."""
    store = BucketStore(spark, shared_folder(spark, "buckets"))
    streamed = Streamed(spark, sf_dir, turn=_overlapping)
    streamed.average(lambda rows: rows, lambda rows, c: late_stream(rows, store, c, trigger=ONCE))
    closed = store.closed().select(*A.KEY, "bucket", F.col("sum").alias("closed_sum"))
    return rounded(store.totals().join(closed, [*A.KEY, "bucket"], "left")).withColumn(
        "closed_sum", F.round("closed_sum", 4)
    )


# How far the watermark stays behind, and when an open bucket is left behind by it: at the end of
# the part before that of the reading that would close it, or at the end of all.
EVICT_DELAY = 3_600_000
EVICTED_SQL = f"""WITH {READ2_SQL},
turned AS (SELECT *, {TURN_SQL} AS turn FROM read2),
marks AS (SELECT t AS turn, max(ptimestamp) - {EVICT_DELAY} AS mark
          FROM turned, range({TURNS}) AS turns(t) WHERE turned.turn <= t GROUP BY t),
marked AS (
  SELECT *, CASE WHEN lag(bucket) OVER w = bucket THEN 0 ELSE 1 END AS starts
  FROM turned WINDOW w AS (PARTITION BY did, pidx, "interval" ORDER BY seq)),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY did, pidx, "interval" ORDER BY seq) AS run FROM marked),
runs AS (
  SELECT did, pidx, avg, "interval", run, bucket, sum(x) AS total, count(*) AS num,
         arg_min(dtimestamp, seq) AS own_dts, arg_min(ptimestamp, seq) AS own_pts,
         min(turn) AS first_turn, max(turn) AS last_turn
  FROM numbered GROUP BY ALL),
followed AS (
  SELECT *, lead(own_dts) OVER w AS next_dts, lead(own_pts) OVER w AS next_pts,
         coalesce(lead(first_turn) OVER w, {TURNS}) AS next_turn
  FROM runs WINDOW w AS (PARTITION BY did, pidx, "interval" ORDER BY run)),
ended AS (
  SELECT followed.*, next_turn > last_turn AND bucket < mark - 2 * "interval" AS evicted
  FROM followed LEFT JOIN marks ON marks.turn = next_turn - 1)
SELECT m.emits, did AS id, pidx AS portid, avg,
       CASE WHEN evicted THEN own_dts ELSE next_dts END AS dtimestamp,
       CASE WHEN evicted THEN own_pts ELSE next_pts END AS ptimestamp,
       round(total, 4) AS sum, CAST(num AS INTEGER) AS num
FROM ended, (VALUES (true), (false)) AS m(emits)
WHERE CASE WHEN evicted THEN m.emits ELSE next_pts IS NOT NULL END"""


@query("stream_evict_idle", EVICTED_SQL)
def stream_evict_idle(spark, sf_dir):
    """Records with idle buckets dropped, and with them sent, by event time."""
    SA.use_state_store(spark)

    def evicting(emits):
        return lambda readings: SA.rollover_stream(
            readings, evict="event", emit_on_evict=emits, delay=f"{EVICT_DELAY} milliseconds"
        )

    paths = {emits: shared_folder(spark, "averages") for emits in (True, False)}
    # Both streams read the same readings, so the messages are cleaned once.
    Streamed(spark, sf_dir).averages(
        [(evicting(emits), to_parquet(path)) for emits, path in paths.items()]
    )
    sent, dropped = (
        rounded(spark.read.schema(RECORDS).parquet(path)).drop("app").withColumn("emits", F.lit(emits))
        for emits, path in paths.items()
    )
    return sent.unionByName(dropped)


@query(
    "stream_handover",
    _rollover_sql("ptimestamp", "").replace(
        "SELECT did AS id", "SELECT closer_pts IS NULL AS is_open, did AS id"
    ),
)
def stream_handover(spark, sf_dir):
    """The first part by a batch, the others by a stream that begins with what the batch left open."""
    SA.use_state_store(spark)
    path = shared_folder(spark, "handover")
    streamed = Streamed(spark, sf_dir)
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    history = m2(spark, sf_dir).filter(turn_of(F.col("seq"), F.lit(last)) == 0)
    book = RuleBook.of(r1(spark, sf_dir))
    runs = A.rollover_in_order(A.readings(history, book, ["seq"]), "seq")
    initial = SA.handed_over(A.still_open(runs))
    checkpoint = streamed.average(
        lambda rows: SA.rollover_stream(rows, initial=initial), to_parquet(path), first=1
    )
    records = A.avg_records(runs).unionByName(
        spark.read.schema(RECORDS).parquet(path).drop("app")
    ).withColumn("is_open", F.lit(False))
    still = SA.open_buckets(spark, checkpoint).select(
        F.lit(True).alias("is_open"), F.col("did").alias("id"), F.col("pidx").alias("portid"), "avg",
        F.lit(None).cast("bigint").alias("dtimestamp"), F.lit(None).cast("bigint").alias("ptimestamp"),
        "sum", F.col("num").cast("int").alias("num"),
    )
    return rounded(records.unionByName(still))


@query(
    "stream_two_sources",
    f"""WITH {READ2_SQL}
    SELECT did, pidx, avg, "interval", bucket, round(sum(x), 4) AS sum, count(x) AS num
    FROM read2 GROUP BY did, pidx, avg, "interval", bucket
    HAVING bucket + "interval" <= (
      SELECT min(last) FROM (SELECT max(ptimestamp) AS last FROM m2 GROUP BY seq % 2))""",
)
def stream_two_sources(spark, sf_dir):
    """Messages from two folders with rates of their own: one is read as a whole in the first
    micro-batch, the other part by part, so that it ends up weeks behind."""
    SA.use_state_store(spark)
    folder = shared_folder(spark, "sources")
    inboxes = [os.path.join(folder, f"inbox{n}") for n in range(2)]
    out, checkpoint = os.path.join(folder, "rows"), os.path.join(folder, "checkpoint")
    book = RuleBook.of(r1(spark, sf_dir))
    events = table(spark, sf_dir, "events")
    last, rows = events.agg(F.max("event_id"), F.count(F.lit(1))).first()
    # The first source comes at once, the other in nine parts, one by one.
    parts = 9
    part = F.floor(F.col("seq") * parts / F.lit(last + 1))

    def send(wanted, inbox, files):
        wire = to_wire(m2_of(events.repartition(files, "event_id")))
        wire.filter(wanted).write.mode("append").parquet(inbox)
        return wire.schema

    whole, each = tasks_of(rows // 2), tasks_of(rows // 2 // parts)
    schema = send(F.col("seq") % 2 == 0, inboxes[0], whole)
    for number in range(parts):
        send((F.col("seq") % 2 == 1) & (part == number), inboxes[1], each)
    streams = [
        spark.readStream.schema(schema).option("maxFilesPerTrigger", rate).parquet(inbox)
        for inbox, rate in zip(inboxes, (whole, each))
    ]
    messages = union_of_sources(streams, offset="seq")
    rows = A.readings(messages, book, ["event_time"])
    to_parquet(out)(SA.window_stream(rows), checkpoint).awaitTermination()
    return rounded(spark.read.schema(WINDOWS).parquet(out))
