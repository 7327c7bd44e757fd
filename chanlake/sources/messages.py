"""Message logs: JSON Lines, one or more objects per line, plain or gzipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.functions.messages import peer_known
from chanlake.schemas import (
    CORRUPT,
    FORWARD_VIEW,
    MEDIA_TAGS,
    MESSAGE_TAGS,
    PRIVATE_MESSAGE,
    RAW_MESSAGE,
    Schema,
    ddl,
)
from chanlake.sources.packs import unpacked
from chanlake.sources.paths import list_exists

MESSAGE_FILES = "*.jsonl{,.gz}"
ERROR = "decode_error"

# Where two objects meet on one line. An unescaped quote and a key cannot follow a
# brace inside a JSON string, so text that holds "}{" is never cut.
GLUE = r'(?<=\})(?=\{\s*"\w+"\s*:)'


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    modified_after: str | None = None,
    files: str = MESSAGE_FILES,
    packs: bool = False,
) -> DataFrame:
    """Non-blank lines of all message files below ``path``, with their file's path and time.

    With ``packs`` the files hold many logs each (see ``packs.py``).
    """
    reader = spark.read.option("pathGlobFilter", files).option("recursiveFileLookup", True)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    lines = with_source(reader.text(path))
    return unpacked(lines) if packs else lines


def with_source(lines: DataFrame) -> DataFrame:
    """Lines with their file: its path as it is named, not as the URI that Spark gives."""
    uri = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return lines.select(
        "value",
        F.url_decode(uri).alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
    ).filter(F.trim("value") != "")


def repair_concatenated_json(lines: DataFrame, value: str = "value") -> DataFrame:
    """One object per row: lines that hold several glued objects are split."""
    return lines.withColumn(
        value,
        F.explode(
            F.when(F.contains(F.col(value), F.lit("}{")), F.split(value, GLUE)).otherwise(F.array(value))
        ),
    )


def _key_absent(text: Column, key: str) -> Column:
    return ~F.coalesce(F.array_contains(F.json_object_keys(text), key), F.lit(False))


def _first_error(checks: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*(F.when(failed, F.lit(reason)) for failed, reason in checks))


def decode(lines: DataFrame, schema: Schema = RAW_MESSAGE, value: str = "value") -> DataFrame:
    """Lines decoded by a fixed schema; unknown keys are ignored.

    Lines that break the record contract keep their text and get a reason in
    ``decode_error``; see ``valid`` and ``quarantined``.
    """
    fields = ddl({**schema, CORRUPT: "string"})
    record = F.from_json(value, fields, {"columnNameOfCorruptRecord": CORRUPT})
    # As a generator the record is parsed once per line: as a plain column the filters on
    # its fields would be pushed below it and parse the line again for each of them.
    rows = lines.select("*", F.explode(F.array(record)).alias("_record"))
    rows = rows.select(
        *(c for c in lines.columns if c not in schema),
        *(F.col(f"_record.{name}").alias(name) for name in schema),
        F.col(f"_record.{CORRUPT}").alias(CORRUPT),
    )
    return rows.withColumn(ERROR, _first_error(_checks(schema, F.col(value)))).drop(CORRUPT)


def _checks(schema: Schema, text: Column) -> list[tuple[Column, str]]:
    cut_off = ~F.endswith(F.rtrim(text), F.lit("}"))
    checks = [
        (F.col(CORRUPT).isNotNull() | cut_off, "not a record of this shape"),
        (F.col("id").isNull(), "id missing"),
    ]
    if "_" in schema:
        content = F.col("_") == "Message"
        media = F.col("media")
        checks += [
            (~F.coalesce(F.col("_").isin(*MESSAGE_TAGS), F.lit(False)), "unknown tag"),
            # Key lists are built only for the few rows whose date is null.
            (
                F.when(F.col("date").isNull(), _key_absent(text, "date")).otherwise(False),
                "date missing",
            ),
            (content & F.col("message").isNull(), "message missing"),
            (
                F.when(
                    (F.col("_") == "MessageService") & F.col("action").isNull(),
                    _key_absent(text, "action"),
                ).otherwise(False),
                "action missing",
            ),
            (
                media.isNotNull() & ~F.coalesce(media["_"].isin(*MEDIA_TAGS), F.lit(False)),
                "unknown media tag",
            ),
            (
                ((media["_"] == "MessageMediaPhoto") & media["photo"]["id"].isNull())
                | ((media["_"] == "MessageMediaDocument") & media["document"]["id"].isNull())
                | ((media["_"] == "MessageMediaWebPage") & media["webpage"]["id"].isNull()),
                "media id missing",
            ),
            (
                F.col("replies").isNotNull() & F.col("replies")["replies"].isNull(),
                "reply count missing",
            ),
            (
                F.exists(
                    F.col("reactions")["results"],
                    lambda r: r["count"].isNull() | r["reaction"].isNull(),
                ),
                "reaction incomplete",
            ),
            (~peer_known(F.col("from_id")), "unknown peer tag"),
        ]
    checks.append(
        (
            F.when(
                F.col("fwd_from").isNotNull() & F.col("fwd_from")["date"].isNull(),
                _key_absent(F.get_json_object(text, "$.fwd_from"), "date"),
            ).otherwise(False),
            "forward date missing",
        )
    )
    if "_" in schema:
        checks.append((~peer_known(F.col("fwd_from")["from_id"]), "unknown peer tag"))
    return checks


def valid(decoded: DataFrame, value: str = "value") -> DataFrame:
    return decoded.filter(F.col(ERROR).isNull()).drop(ERROR, value)


def without_valid_text(decoded: DataFrame, value: str = "value") -> DataFrame:
    """Good lines without their text, which their columns hold; bad ones keep it for the quarantine."""
    return decoded.withColumn(value, F.when(F.col(ERROR).isNotNull(), F.col(value)))


def quarantined(decoded: DataFrame, value: str = "value") -> DataFrame:
    """Undecodable lines with the reason, in place of an aborted job."""
    kept = [c for c in ("file_path", "file_modified", value, ERROR) if c in decoded.columns]
    return decoded.filter(F.col(ERROR).isNotNull()).select(*kept)


def decode_messages(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema = RAW_MESSAGE,
    modified_after: str | None = None,
    files: str = MESSAGE_FILES,
    packs: bool = False,
) -> DataFrame:
    """All records below ``path``, good and bad: read, repair, decode."""
    lines = read_lines(spark, path, modified_after, files, packs)
    return decode(repair_concatenated_json(lines), schema)


def scan_messages(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema = RAW_MESSAGE,
    modified_after: str | None = None,
) -> DataFrame:
    """The good records below ``path``."""
    return valid(decode_messages(spark, path, schema, modified_after))


def scan_private_messages(
    spark: SparkSession, path: str | list[str], modified_after: str | None = None
) -> DataFrame:
    """Messages before pseudonymisation, with entities and personal fields."""
    return scan_messages(spark, path, PRIVATE_MESSAGE, modified_after)


def scan_forward_view(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``fwd_from`` and ``reply_to`` only, of records with any tag.

    ``path`` may be a folder, one file, or missing: then the result is empty.
    """
    if list_exists(spark, path):
        lines = read_lines(spark, path)
    else:
        lines = spark.createDataFrame(
            [], "value string, file_path string, file_modified timestamp"
        )
    return valid(decode(repair_concatenated_json(lines), FORWARD_VIEW))
