"""CSV files read in splits, though cells hold line breaks and headers differ by file.

Whether a line begins inside a quoted cell depends on every quote before it. Quotes are
counted per split of a file, the parity before each split follows from a running sum over
the splits, and within a split from a running sum over its lines. A record begins at a line
with an even number of quotes before it. Splits that hold no odd line and begin evenly,
which is most of them, need no sum over lines and are not shuffled.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterbill.operators.spread import stage

#: Different header lines among the files of one table; they are handled by the driver.
MOST_LAYOUTS = 1000

SPLIT = ["file", "split"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, the start of its split, and its order within the split."""
    return (
        spark.read.text(path, lineSep="\n")
        .selectExpr(
            "_metadata.file_path AS file",
            "_metadata.file_block_start AS split",
            "monotonically_increasing_id() AS place",
            "value AS line",
        )
        .withColumn("odd", F.expr("(length(line) - length(replace(line, '\\\"', ''))) % 2 = 1"))
    )


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: whether it begins inside a cell, and where a cut record goes.

    `whole`: each line is a record. `tail_of`: the last split before in which a record
    begins; lines up to this split's first record belong to that split's last one.
    """
    before = "(PARTITION BY file ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return (
        lines.groupBy(*SPLIT)
        .agg(
            F.count_if("odd").alias("odds"),
            F.expr("min(place) FILTER (WHERE odd)").alias("first_odd"),
            F.max("place").alias("last"),
        )
        .selectExpr("*", f"coalesce(sum(odds) OVER {before}, 0) % 2 = 1 AS inside")
        .selectExpr("*", "NOT inside OR coalesce(first_odd < last, false) AS has_start")
        .selectExpr(
            *SPLIT,
            "inside",
            "NOT inside AND odds = 0 AS whole",
            f"last(if(has_start, split, NULL)) IGNORE NULLS OVER {before} AS tail_of",
        )
    )


def _joined(lines: DataFrame) -> DataFrame:
    """The records of splits in which some record has more than one line."""
    in_split = "PARTITION BY file, split ORDER BY place"
    return (
        lines.selectExpr(
            "*",
            f"""(cast(inside AS int) + coalesce(sum(cast(odd AS int)) OVER ({in_split}
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) % 2 = 0 AS starts""",
        )
        .selectExpr(
            "*",
            f"max(if(starts, place, NULL)) OVER ({in_split} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS start",
            "max(if(starts, place, NULL)) OVER (PARTITION BY file, split) AS last_start",
        )
        # a split's last record, which may go on in the next, has no start in its key
        .selectExpr(
            "file",
            "if(start IS NULL, tail_of, split) AS of_split",
            "if(start IS NULL OR start = last_start, NULL, start) AS of_start",
            "struct(split, place, line) AS part",
        )
        .groupBy("file", "of_split", "of_start")
        .agg(F.sort_array(F.collect_list("part")).alias("parts"))
        .selectExpr(
            "file",
            "parts[0].split AS split",
            "parts[0].place AS place",
            "array_join(transform(parts, part -> part.line), '\\n') AS record",
        )
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, place, record): every CSV record of the files, line breaks kept.

    Blank records are left out. Quotes within cells are doubled and stand in quoted cells
    only, as RFC 4180 has it. A quote that is never closed makes the rest of its file one record.
    """
    lines = _lines(spark, path)
    known = lines.join(_splits(lines), SPLIT)
    single = known.where("whole").selectExpr(*SPLIT, "place", "line AS record")
    several = _joined(known.where("NOT whole"))
    return single.unionByName(several).withColumn(
        "record", F.regexp_replace("record", "\r$", "")
    ).where("trim(record) <> ''")


def _first_records(rows: DataFrame) -> DataFrame:
    """The first record of each file: (file, split, place)."""
    first = rows.groupBy("file").agg(F.min("split").alias("split"))
    return rows.join(first, SPLIT).groupBy(*SPLIT).agg(F.min("place").alias("place"))


def _cell(names_by_layout: list[list[str]], name: str) -> Column:
    """The cell under a header; of equal headers in one file the first counts."""
    cell = F.lit(None).cast("string")
    for number, names in enumerate(names_by_layout):
        if name in names:
            cell = F.when(F.col("layout") == number, F.col(f"cells.c{names.index(name)}")).otherwise(cell)
    return cell.alias(name)


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The rows of CSV files as text columns, each file read by its own header line.

    Files may order their columns differently and lack some; what a file lacks is null.
    `columns` keeps those of the headers that it names. A cell reads as Spark's own reader
    has it: empty is null, quotes are doubled. The records are written once to the shared
    folder, as the header lines must be known before the plan is made.
    """
    rows = stage(records(spark, path))
    heads = stage(rows.join(_first_records(rows), [*SPLIT, "place"]).select("file", "record"))
    layouts = [r.record for r in heads.select("record").distinct().limit(MOST_LAYOUTS + 1).collect()]
    if len(layouts) > MOST_LAYOUTS:
        raise ValueError(f"the files of {path} have over {MOST_LAYOUTS} different header lines")
    layouts.sort()
    named = [next(csv.reader([text], strict=False)) if "\n" not in text else next(csv.reader(text.splitlines(True))) for text in layouts]
    names = list(dict.fromkeys(n for layout in named for n in layout if n and (columns is None or n in columns)))
    if not layouts:
        return rows.selectExpr(*[f"cast(NULL AS string) AS `{c}`" for c in columns or []]).limit(0)
    number = F.lit(None).cast("int")
    for i, text in enumerate(layouts):
        number = F.when(F.col("record") == text, i).otherwise(number)
    files = heads.select("file", number.alias("layout"))
    first = _first_records(rows).withColumn("header", F.lit(True))
    width = max(map(len, named))
    cells = F.from_csv(
        "record", ", ".join(f"c{i} string" for i in range(width)), {"escape": '"', "maxColumns": str(max(20480, width + 1))}
    )
    return (
        rows.join(first, [*SPLIT, "place"], "left")
        .where("header IS NULL")
        .join(files, "file")
        .select("layout", cells.alias("cells"))
        .select(*[_cell(named, name) for name in names])
    )
