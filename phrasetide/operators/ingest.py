"""From text lines to clean messages, and from messages to stored posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phrasetide import schemas
from phrasetide.functions.numbers import synthetic_downs
from phrasetide.functions.times import from_epoch


def _keys(column: str) -> Column:
    # NULL for broken JSON and for anything that is not an object.
    return F.json_object_keys(column)


def _complete(column: str) -> Column:
    """Every required key is there, whatever its value (null counts as there)."""
    wanted = F.array(*[F.lit(key) for key in schemas.REQUIRED_KEYS])
    return F.size(F.array_except(wanted, _keys(column))) == 0


def _over_18(raw: str) -> Column:
    """True or false; the numbers 0 and 1 count too, text and null do not."""
    kind = F.schema_of_variant(F.col(raw))
    number = F.try_variant_get(F.col(raw), "$", "double")
    return F.when(kind != "STRING", number != 0)


def _whole(text: Column) -> Column:
    """The whole number that a JSON number spells (3 and 3.0 alike), else null."""
    number = text.try_cast("decimal(38,6)")
    return F.when(number == F.floor(number), number.cast("bigint"))


def _fault(message: Column) -> Column:
    """What is wrong with the values of a parsed object; null if nothing is."""
    ups = _whole(message["ups"])
    found = F.when(ups.isNull() | (ups < 0), F.lit("up-votes missing or negative"))
    for name in schemas.WHOLE:
        if name != "ups":
            found = found.when(message[name].isNotNull() & _whole(message[name]).isNull(),
                               F.lit(f"not a whole number: {name}"))
    at = message["created_utc"]
    return found.when(at.isNotNull() & at.try_cast("decimal(20,6)").isNull(),
                      F.lit("not a time: created_utc"))


def _judged(rows: DataFrame, column: str, required: Column) -> DataFrame:
    """Rows with the parsed object ``m`` and the ``reason`` against it, if any.

    Objects that are not ``required`` are left out; broken JSON stays.
    """
    return (rows.filter(_keys(column).isNull() | required)
            .withColumn("m", F.from_json(column, schemas.RAW_MESSAGE))
            .withColumn("reason", F.when(_keys(column).isNull(), F.lit("not a JSON object"))
                        .otherwise(_fault(F.col("m")))))


def _accepted(judged: DataFrame, column: str, on_bad: str) -> DataFrame:
    """Messages of the rows without a reason; others stop the job or are left out."""
    if on_bad == "quarantine":
        good = judged.filter(F.col("reason").isNull())
    elif on_bad == "fail":
        good = judged
    else:
        raise ValueError(f"on_bad must be 'fail' or 'quarantine', not {on_bad!r}")
    whole = {f.name: _whole(F.col(f.name)) for f in schemas.MESSAGE
             if isinstance(f.dataType, T.LongType)}
    if on_bad == "fail":
        # On a column, not in a filter: there the object would be parsed once more.
        stop = F.raise_error(F.concat("reason", F.lit(": "), F.coalesce("_raw", F.lit("null"))))
        whole["ups"] = F.when(F.col("reason").isNull(), whole["ups"]).otherwise(
            stop.cast("bigint"))
    return (good.select("reason", F.col(column).alias("_raw"), "m.*")
            .withColumns({**whole, "over_18": _over_18("over_18")})
            .select(*schemas.MESSAGE.fieldNames()))


def _rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNotNull()).drop("m")


def _clean(messages: DataFrame) -> DataFrame:
    text = {f.name: F.lower(f.name) for f in schemas.MESSAGE
            if isinstance(f.dataType, T.StringType)}
    return (messages
            .withColumns(text)
            .withColumn("downs", synthetic_downs("id", "ups"))
            .select(*schemas.MESSAGE.fieldNames()))


def read_messages(lines: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Messages of a ``line`` column holding one JSON object per row.

    Lines lacking a required key are skipped. Broken JSON, up-votes that are not
    a whole number >= 0, other counts that are not whole and times that are no
    number stop the job, or with ``on_bad="quarantine"`` are left out here and
    returned by :func:`rejected_lines`.
    """
    return _clean(_accepted(_judged(lines, "line", _complete("line")), "line", on_bad))


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The lines ``read_messages(lines, "quarantine")`` set aside, with a reason."""
    return _rejected(_judged(lines, "line", _complete("line")))


def to_values(messages: DataFrame) -> DataFrame:
    """One JSON ``value`` per message, nulls written out so that no key is lost."""
    return messages.select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def from_values(values: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Messages of topic values, judged as lines are; empty objects are dropped."""
    filled = F.size(_keys("value")) > 0
    return _accepted(_judged(values, "value", filled), "value", on_bad)


def rejected_values(values: DataFrame) -> DataFrame:
    """The values ``from_values(values, "quarantine")`` set aside, with a reason."""
    return _rejected(_judged(values, "value", F.size(_keys("value")) > 0))


def keep_one_per_id(messages: DataFrame, key: str = "id",
                    first_by: Column | None = None) -> DataFrame:
    """One row per id: the earliest, then the smallest in column order.

    A plain aggregate, so copies of a hot id are merged before the shuffle.
    """
    if first_by is None:
        first_by = F.col("created_utc").cast("decimal(20,6)")
    rest = [c for c in messages.columns if c != key]
    kept = messages.groupBy(key).agg(
        F.min(F.struct(first_by.alias("_first"), *_title_first(rest))).alias("k"))
    return kept.select(*[F.col(c) if c == key else F.col(f"k.{c}") for c in messages.columns])


def _title_first(columns: list[str]) -> list[str]:
    return sorted(columns, key=lambda c: c != "title")


def safe_only(messages: DataFrame) -> DataFrame:
    """Posts known not to be over-18; an unknown flag drops the post."""
    return messages.filter(F.col("over_18") == F.lit(False))


def to_posts(matched: DataFrame) -> DataFrame:
    """Matched messages in the layout of the stored posts."""
    return matched.select(
        "query",
        from_epoch("created_utc").alias("created_utc"),
        F.col("id").alias("doc_id"),
        "subreddit", "title", "permalink", "url", "author",
        F.col("ups").cast("bigint").alias("ups"),
        F.col("downs").cast("bigint").alias("downs"),
    )
