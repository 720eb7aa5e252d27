"""Abbreviation dictionaries (S5-S7) as tables ``(source_file, line_no, abbr, full)``.

``dictionary()`` turns the table into the ``abbr -> full`` mapping used by
``expand_abbreviations``: a duplicate key keeps its **last** line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.maps import MAX_INLINE_ENTRIES, bounded_dict

# Column names of the CSV form
CSV_ABBR, CSV_FULL = "viết_tắt", "từ_đầy_đủ"


def _line_numbers(df: DataFrame) -> DataFrame:
    """``(source_file, line_no)``: the position of a line among all input lines.

    Within one file the splits keep their offset order, and the generated ids
    grow with it; across files the file name orders them.
    """
    return (df.withColumn("source_file", F.input_file_name())
            .withColumn("line_no", F.monotonically_increasing_id()))


def read_abbreviations_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with columns ``viết_tắt``, ``từ_đầy_đủ``."""
    df = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
          .csv(path))
    return _line_numbers(df).select("source_file", "line_no", F.col(CSV_ABBR).alias("abbr"),
                                    F.col(CSV_FULL).alias("full"))


def read_abbreviations_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object ``{abbr: full}`` per file."""
    raw = spark.read.text(path, wholetext=True).withColumn("source_file", F.input_file_name())
    m = F.from_json(F.col("value"), "map<string,string>")
    return (raw.select("source_file", F.posexplode(F.map_entries(m)).alias("line_no", "e"))
            .select("source_file", F.col("line_no").cast("long"), F.col("e.key").alias("abbr"),
                    F.col("e.value").alias("full")))


def parse_abbreviation_lines(lines: DataFrame, value: str = "value",
                             line_no: str = "line_no") -> DataFrame:
    """S7 body: ``key:value`` lines, stripped; adds ``ok`` (exactly one colon).

    Lines without a colon and lines with two or more are rejected (D9: they
    are skipped and counted, instead of losing the whole dictionary).
    """
    from ..functions.text import strip
    s = strip(F.col(value))
    pieces = F.split(s, ":", -1)
    keep = [F.col("source_file")] if "source_file" in lines.columns else []
    return lines.select(*keep, F.col(line_no), F.get(pieces, 0).alias("abbr"),
                        F.get(pieces, 1).alias("full"), (F.size(pieces) == 2).alias("ok"),
                        F.col(value).contains(":").alias("has_colon"))


def read_abbreviations_txt(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """``key:value`` lines.  ``strict=True`` raises on any bad line."""
    lines = _line_numbers(spark.read.text(path))
    parsed = parse_abbreviation_lines(lines)
    if strict:
        bad = parsed.filter(~F.col("ok")).count()
        if bad:
            raise ValueError(f"{bad} dictionary lines are not 'key:value'")
    return parsed.filter("ok").select("source_file", "line_no", "abbr", "full")


def read_abbreviations(spark: SparkSession, path: str) -> DataFrame:
    """By extension, like the reference."""
    if path.endswith(".csv"):
        return read_abbreviations_csv(spark, path)
    if path.endswith(".json"):
        return read_abbreviations_json(spark, path)
    if path.endswith(".txt"):
        return read_abbreviations_txt(spark, path)
    raise ValueError("abbreviations must be .csv, .json or .txt")


def last_wins(table: DataFrame) -> DataFrame:
    """S5 rule: ``(abbr, full)`` with the last line of every key (partial aggregation); a
    line without a key or an expansion is left out.

    Lines are ordered by ``(source_file, line_no)`` when the file is known.
    """
    order = (F.struct("source_file", "line_no") if "source_file" in table.columns
             else F.col("line_no"))
    table = table.where(F.col("abbr").isNotNull() & F.col("full").isNotNull())
    return table.groupBy("abbr").agg(F.max_by("full", order).alias("full"))


def dictionary(table: DataFrame, limit: int = MAX_INLINE_ENTRIES) -> dict[str, str]:
    """The mapping for ``expand_abbreviations``; refuses dictionaries above ``limit``."""
    d = bounded_dict(last_wins(table), "abbr", "full", limit)
    if d is None:
        raise ValueError(f"dictionary has more than {limit} keys; use expand_with_table")
    return d


def expand_with_table(df: DataFrame, text: str, key: str, table: DataFrame,
                      out: str | None = None) -> DataFrame:
    """T7 for a dictionary too large to inline: explode tokens, join, reassemble.

    Tokens of a row are put back in order by ``key`` (unique row key); each
    group is one row's tokens, so it is bounded by the text, not the table.
    """
    from ..functions.text import tokens
    d = last_wins(table)
    if d.isEmpty():  # nothing to look up: texts stay as they are, runs of spaces too
        return df.withColumn(out or text, F.col(text))
    ex = df.select(F.col(key).alias("__vb_k"), F.posexplode(tokens(F.col(text))).alias("__vb_p", "abbr"))
    looked = ex.join(d, "abbr", "left").select(
        "__vb_k", "__vb_p", F.coalesce("full", "abbr").alias("w"))
    back = looked.groupBy("__vb_k").agg(
        F.array_sort(F.collect_list(F.struct("__vb_p", "w"))).alias("__vb_ws"))
    joined = df.join(back, df[key] == back["__vb_k"], "left")
    val = F.when(F.col(text).isNotNull(), F.coalesce(
        F.array_join(F.transform("__vb_ws", lambda s: s["w"]), " "), F.lit("")))
    return joined.withColumn(out or text, val).drop("__vb_k", "__vb_ws")
