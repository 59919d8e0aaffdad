"""Device messages: stream and file sources, decoding, quarantine and the wire format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.schemas import KEY_TYPES, MESSAGE_COLUMNS, OPTIONAL_KEYS, PORT_KEYS, REQUIRED_KEYS


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str
) -> DataFrame:
    """The message topic as a stream with the text in `value`, and `partition`, `offset`, `sent_at`
    and `arrival` beside it; keys are not used.

    Needs the Kafka connector on the class path. Topic partitions set the parallelism;
    `maxOffsetsPerTrigger` bounds a micro-batch.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
        .transform(topic_rows)
    )


def topic_rows(records: DataFrame) -> DataFrame:
    """Records of a topic (binary `value`, `partition`, `offset`, `timestamp`) as `value`, `partition`,
    `offset`, `sent_at` (epoch ms) and `arrival`, which orders the messages of a device.

    A device's messages keep to one partition, where offsets give their order; so `arrival` is the
    offset.
    """
    return records.select(
        F.col("value").cast("string").alias("value"),
        "partition",
        "offset",
        F.unix_millis("timestamp").alias("sent_at"),
        F.col("offset").alias("arrival"),
    )


def read_text_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A folder that receives text files, one message per line, as a stream.

    `maxFilesPerTrigger` or `maxBytesPerTrigger` is the rate of this source.
    """
    return spark.readStream.options(**options).text(path)


def union_of_sources(
    sources: Sequence[DataFrame],
    delay: str = "0 seconds",
    policy: str = "min",
    column: str = "value",
    offset: str | None = None,
) -> DataFrame:
    """Accepted messages of several streams as one, with `source`, the number of the stream,
    `event_time`, and, if `offset` names the column that counts the messages of a stream, `arrival`.

    Each source keeps the rate it was opened with, and its own watermark, `delay` behind its newest
    message. With the policy "min" the stream's watermark is that of the source furthest behind, so
    a source that lags loses nothing; with "max" the source furthest ahead sets it. After a restart
    the watermark stands still until every source has had a message. `arrival` orders
    by (offset, source), so messages of a device that keep to one source stay in their order.
    """
    spark = sources[0].sparkSession
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
    whole = None
    for number, stream in enumerate(sources):
        messages = accepted(decode(stream, column)).withColumn("source", F.lit(number))
        if offset is not None:
            place = F.col(offset) * len(sources) + number
            messages = messages.withColumn("arrival", place.cast("bigint"))
        timed = messages.withColumn("event_time", F.timestamp_millis("ptimestamp")).withWatermark(
            "event_time", delay
        )
        whole = timed if whole is None else whole.unionByName(timed)
    return whole


# Most messages have the expected types and are read by one typed parse. What that parse cannot
# take as it is (text numbers, odd ports, broken JSON) leaves its text in `_odd` and is read again
# as a variant.
_TYPED = (
    ", ".join(f"`{key}` {kind}" for key, kind in KEY_TYPES.items())
    + ", `values` array<map<string,variant>>, `_odd` string"
)
_TEXT_MAP = "map<string,variant>"


def _map(body: Column) -> Column:
    return F.try_variant_get(body, "$", _TEXT_MAP)


def _rest(entries: Column, known: tuple[str, ...]) -> Column:
    """JSON text of the other keys of an object, null if there are none."""
    rest = F.map_filter(entries, lambda key, _: ~key.isin(*known))
    return F.when(F.size(rest) > 0, F.to_json(rest))


def _has_others(size: Column, known: list[Column]) -> Column:
    """An object has more keys than known ones with a value; only then `_rest` has to look."""
    return size > sum((c.isNotNull().cast("int") for c in known), F.lit(0))


def _is_object(body: Column) -> Column:
    return F.coalesce(F.schema_of_variant(body).startswith("OBJECT"), F.lit(False))


def _typed_port(entries: Column) -> Column:
    value, valid, unit = [F.try_element_at(entries, F.lit(key)) for key in PORT_KEYS]
    return F.struct(
        value.alias("value"),
        F.try_variant_get(valid, "$", "boolean").alias("valid"),
        F.try_variant_get(unit, "$", "string").alias("unit"),
        F.when(entries.isNull(), F.lit("null"))
        .when(_has_others(F.size(entries), [value, valid, unit]), _rest(entries, PORT_KEYS))
        .alias("extra"),
    )


def _odd_port(body: Column) -> Column:
    """One element of `values`; what is no object is kept as text in `extra`."""
    return F.struct(
        F.try_variant_get(body, "$.value", "variant").alias("value"),
        F.try_variant_get(body, "$.valid", "boolean").alias("valid"),
        F.try_variant_get(body, "$.unit", "string").alias("unit"),
        F.when(_is_object(body), _rest(_map(body), PORT_KEYS))
        .otherwise(F.to_json(body))
        .alias("extra"),
    )


def decode(df: DataFrame, column: str = "value") -> DataFrame:
    """JSON text as message columns, `raw` and `reject`, the reason of a message to set aside."""
    own = (column, "raw", "reject", "_odd", "_body", *MESSAGE_COLUMNS)
    kept = [c for c in df.columns if c not in own]
    typed = F.from_json("raw", _TYPED, {"columnNameOfCorruptRecord": "_odd"})
    is_odd = F.col("_odd").isNotNull() | (F.trim(F.coalesce("raw", F.lit(""))) == "")
    # The generators keep filters above them, so that no filter parses a text a second time.
    parsed = (
        df.select(*kept, F.col(column).alias("raw"))
        .select("*", F.inline_outer(F.array(typed)))
        .select("*", F.explode(F.array(F.when(is_odd, F.try_parse_json("raw")))).alias("_body"))
    )
    body, known = F.col("_body"), REQUIRED_KEYS + OPTIONAL_KEYS
    elements = F.try_variant_get(body, "$.values", "array<variant>")
    columns = {
        key: F.when(is_odd, F.try_variant_get(body, f"$.{key}", kind)).otherwise(F.col(key))
        for key, kind in KEY_TYPES.items()
    }
    reject = _reject_reason(columns, is_odd, elements)
    columns["values"] = F.when(is_odd, F.transform(elements, _odd_port)).otherwise(
        F.transform("values", _typed_port)
    )
    has_others = _has_others(F.size(F.json_object_keys("raw")), [F.col(k) for k in known])
    columns["extra"] = F.when(is_odd, _rest(_map(body), known)).when(
        has_others, _rest(F.from_json("raw", _TEXT_MAP), known)
    )
    return parsed.select(
        *kept, *[columns[c].alias(c) for c in MESSAGE_COLUMNS], "raw", reject.alias("reject")
    )


def _reject_reason(columns: dict[str, Column], is_odd: Column, elements: Column) -> Column:
    ports, portnum = F.col("values"), columns["portnum"]
    no_values = F.when(is_odd, elements.isNull()).otherwise(ports.isNull())
    reason = F.when(is_odd & ~_is_object(F.col("_body")), F.lit("not_json"))
    for key in REQUIRED_KEYS:
        missing = no_values if key == "values" else columns[key].isNull()
        reason = reason.when(missing, F.lit(f"missing_{key}"))

    def used(array: Column) -> Column:
        return F.slice(array, F.lit(1), F.greatest(portnum, F.lit(0)))

    not_object = F.when(is_odd, F.exists(used(elements), lambda e: ~_is_object(e))).otherwise(
        F.exists(used(ports), lambda entries: entries.isNull())
    )
    size = F.when(is_odd, F.size(elements)).otherwise(F.size(ports))
    return reason.when(portnum > size, F.lit("portnum_exceeds_values")).when(
        not_object, F.lit("port_not_object")
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reject").isNull()).drop("reject", "raw")


def quarantined(decoded: DataFrame) -> DataFrame:
    """Messages that cannot be cleaned, as text with the reason."""
    others = [c for c in decoded.columns if c not in ("reject", "raw", *MESSAGE_COLUMNS)]
    return decoded.filter(F.col("reject").isNotNull()).select(*others, "reject", "raw")


def as_map(text: Column) -> Column:
    """JSON text of an object as a map; other text gives an empty one."""
    return F.coalesce(F.from_json(text, _TEXT_MAP), F.create_map().cast(_TEXT_MAP))


def _plain_port(port: Column) -> Column:
    return F.struct(*[port[k].alias(k) for k in PORT_KEYS])


def _whole_port(port: Column) -> Column:
    """A port with the keys of `extra` merged in, as a variant."""
    known = F.from_json(F.to_json(_plain_port(port)), _TEXT_MAP)
    whole = F.to_variant_object(F.map_concat(known, as_map(port["extra"])))
    is_object = F.coalesce(port["extra"].startswith("{"), F.lit(True))
    return F.when(is_object, whole).otherwise(F.parse_json(port["extra"]))


def to_wire(messages: DataFrame, column: str = "value") -> DataFrame:
    """Messages as JSON text, with the keys that have no column merged back in.

    Other columns of the input stay beside the text.
    """
    names = [c for c in MESSAGE_COLUMNS if c in messages.columns and c != "extra"]
    extra = F.col("extra") if "extra" in messages.columns else F.lit(None).cast("string")

    def known(ports: Column) -> Column:
        return F.struct(*[(ports if c == "values" else F.col(c)).alias(c) for c in names])

    plain = F.to_json(known(F.transform("values", _plain_port)))
    # Only messages with further keys pay for the merge.
    merged_ports = F.to_json(known(F.transform("values", _whole_port)))
    whole = F.to_json(F.map_concat(F.from_json(merged_ports, _TEXT_MAP), as_map(extra)))
    has_more = extra.isNotNull() | F.coalesce(
        F.exists("values", lambda port: port["extra"].isNotNull()), F.lit(False)
    )
    others = [F.col(c) for c in messages.columns if c not in MESSAGE_COLUMNS]
    return messages.select(*others, F.when(has_more, whole).otherwise(plain).alias(column))
