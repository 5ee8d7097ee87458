"""Raw sensor lines to typed events, with a reason for every line that is dropped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.utils import AnalysisException

from roadflux.functions.timeparts import parse_event_time, parse_to_second
from roadflux.schema import RAW_EVENT

NUMBER = r"^-?(\d+\.?\d*|\.\d+)$"  # fixed value: what counts as an unquoted number
LITERALS = ["true", "false", "null"]  # fixed value


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def non_blank(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("value").isNotNull() & (F.trim("value") != ""))


def repaired_json(line: Column) -> Column:
    """Quote bare keys and bare strings of a flat ``{key: value, ...}`` line.

    NULL when the result still is not a JSON object or names no field at all.
    A comma inside a quoted string splits the pair; such lines are valid JSON
    already and never get here when ``parse_lines`` reads them.
    """
    trimmed = F.trim(line)
    body = F.substring(trimmed, F.lit(2), F.length(trimmed) - 2)
    pairs = F.filter(F.split(body, ","), lambda pair: pair.contains(":"))

    def quoted(pair: Column) -> Column:
        key = F.trim(F.substring_index(pair, ":", 1))
        value = F.trim(F.substring(pair, F.instr(pair, ":") + 1, F.length(pair)))
        bare = lambda text: F.concat(F.lit('"'), text, F.lit('"'))
        is_text = value.startswith('"') & value.endswith('"')
        keep = is_text | value.rlike(NUMBER) | value.isin(*LITERALS)
        return F.concat(
            F.when(key.startswith('"'), key).otherwise(bare(key)),
            F.lit(":"),
            F.when(keep, value).otherwise(bare(value)),
        )

    rebuilt = F.concat(F.lit("{"), F.array_join(F.transform(pairs, quoted), ","), F.lit("}"))
    return _checked(rebuilt, lambda text: (text != "{}") & is_object(text))


def _checked(text: Column, test: Callable[[Column], Column]) -> Column:
    """``text`` where ``test`` holds, else NULL; ``text`` is evaluated once."""
    return F.transform(F.array(text), lambda t: F.when(test(t), t))[0]


def regex_repaired_json(line: Column) -> Column:
    """Second try for a line the pair-wise repair could not save."""
    # A bare word before a colon, and a bare value after one.
    keyed = F.regexp_replace(line, r"(\w+):", r'"$1":')
    valued = F.regexp_replace(keyed, r':\s*([^",\{\}\[\]]+?)\s*(?=[,\}])', r':"$1"')
    return _checked(valued, is_object)


def is_object(text: Column) -> Column:
    return F.json_object_keys(text).isNotNull()


def standard_json(line: Column) -> Column:
    """The line itself when it is a JSON object, else its repaired form, else NULL.

    Both repairs look for ``key: value``, so a line without a colon is not worth a try.
    """
    repaired = F.coalesce(repaired_json(line), regex_repaired_json(line))
    return F.coalesce(F.when(is_object(line), line), F.when(line.contains(":"), repaired))


def typed_fields(json_lines: DataFrame, column: str = "json_str") -> DataFrame:
    """Parse by the declared schema and flatten; a field of the wrong type is NULL."""
    return json_lines.withColumn("_data", F.from_json(column, RAW_EVENT)).select(
        *[c for c in json_lines.columns if c != column], "_data.*"
    )


CORRUPT = "_corrupt_record"


def audited_events(lines: DataFrame) -> DataFrame:
    """Every line with its typed fields and a ``reject_reason`` (NULL when accepted).

    Sound JSON is parsed once; only lines that fail are repaired and parsed again.
    """
    checked = T.StructType([*RAW_EVENT.fields, T.StructField(CORRUPT, T.StringType())])
    blank = F.coalesce(F.trim("value") == "", F.lit(True))
    first = lines.withColumn("_first", F.when(~blank, F.from_json("value", checked)))
    sound = F.col("_first").isNotNull() & F.col(f"_first.{CORRUPT}").isNull()
    fixed = first.withColumn("_fixed", F.when(~blank & ~sound, standard_json(F.col("value"))))
    fields = F.struct(*[F.col(f"_first.{name}").alias(name) for name in RAW_EVENT.names])
    parsed = fixed.withColumn("_data", F.when(sound, fields).otherwise(F.from_json("_fixed", RAW_EVENT)))
    timed = parsed.withColumn("_time", parse_event_time(F.col("_data.event_time")))
    reason = (
        F.when(blank, "blank")
        .when(~sound & F.col("_fixed").isNull(), "bad_json")
        .when(F.col("_time").isNull(), "bad_time")
    )
    # Out of a generator, the reason is a column like any other; a filter on it
    # would otherwise be pushed down and parse every line a second time.
    return timed.select("*", F.explode(F.array(reason)).alias("reject_reason")).select(
        *lines.columns,
        *[F.col(f"_data.{name}").alias(name) for name in RAW_EVENT.names if name != "event_time"],
        F.col("_time").alias("event_time"),
        "reject_reason",
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Accepted events only."""
    kept = audited_events(lines).filter(F.col("reject_reason").isNull())
    return kept.select(*RAW_EVENT.names)


def rejected_lines(lines: DataFrame) -> DataFrame:
    return audited_events(lines).filter(F.col("reject_reason").isNotNull()).select("value", "reject_reason")


def stage_aggregates() -> list[Column]:
    """Aggregates over ``audited_events``: lines left after each ingest stage."""
    reason = F.col("reject_reason")
    survived = lambda *lost: F.count(F.when(~F.coalesce(reason.isin(*lost), F.lit(False)), 1))
    return [
        F.count("*").alias("raw_lines"),
        survived("blank").alias("non_blank"),
        survived("blank", "bad_json").alias("converted"),
        survived("blank", "bad_json", "bad_time").alias("accepted"),
        F.count(F.when(reason == "bad_time", 1)).alias("bad_time"),
    ]


def stage_counts(lines: DataFrame) -> DataFrame:
    """Lines left after each ingest stage, one row, one pass."""
    return audited_events(lines).agg(*stage_aggregates())


def strict_json(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Strict JSON lines; undecodable lines are dropped, measures become doubles."""
    reader = spark.read.schema(RAW_EVENT).option("mode", "DROPMALFORMED")
    rows = reader.option("recursiveFileLookup", str(recursive).lower()).json(path)
    return with_double_measures(rows)


def with_double_measures(rows: DataFrame) -> DataFrame:
    measures = ["vehicle_count", "average_speed", "occupancy_rate"]
    timed = rows.withColumn("event_time", parse_event_time(F.col("event_time")))
    return timed.filter(F.col("event_time").isNotNull()).withColumns(
        {name: F.col(name).cast("double") for name in measures}
    )


def decodable(lines: DataFrame) -> DataFrame:
    """Lines that are JSON objects as they stand."""
    return non_blank(lines).filter(is_object(F.col("value")))


def to_second(rows: DataFrame) -> DataFrame:
    """Whole-second event time; rows whose time cannot be read carry a NULL, for quarantine."""
    return rows.withColumn("event_second", parse_to_second(F.col("event_time")))


def parquet_or(spark: SparkSession, path: str, fallback: Callable[[], DataFrame]) -> DataFrame:
    """Read ``path``, or take the caller's other input when there is nothing to read."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return fallback()


# --- streams ---------------------------------------------------------------

def kafka_stream(spark: SparkSession, servers: str, topic: str, max_per_trigger: int | None = None) -> DataFrame:
    """Raw messages of a topic as ``value`` text; needs the Kafka connector on the classpath."""
    reader: DataStreamReader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_lines(messages: DataFrame) -> DataFrame:
    """Every message with typed fields and ``reject_reason``, repaired as in batch; event time usable for a watermark.

    ``ingested_at`` only says when the engine saw the row; nothing is computed from it.
    """
    audited = audited_events(messages).withColumn("event_time", F.col("event_time").cast("timestamp"))
    return audited.withColumn("ingested_at", F.current_timestamp())


def stream_events(messages: DataFrame) -> DataFrame:
    """Accepted events of a message stream; ``stream_rejects`` has all others."""
    kept = stream_lines(messages).filter(F.col("reject_reason").isNull())
    return kept.select(*RAW_EVENT.names, "ingested_at")


def stream_rejects(messages: DataFrame) -> DataFrame:
    """Messages that are not events, and why; for a sink of their own."""
    lost = stream_lines(messages).filter(F.col("reject_reason").isNotNull())
    return lost.select("value", "reject_reason", "ingested_at")
