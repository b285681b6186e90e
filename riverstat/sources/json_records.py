"""Records of large JSON arrays, read in pieces by many tasks.

Spark's own reader takes a JSON array as one value: the file is one task's, which holds all records of the array at once.
Here a file is text whose lines end at `}`. Spark cuts such a file into splits as it does with any text, and each line
that ends outside of a quoted text closes an object. What lies behind the last opening brace of the line is an object
without objects inside: a record, which a task parses alone. So a task holds one record at a time, whatever the size of
the array, and one file is read by as many tasks as it has splits.

A brace inside a quoted text ends a line too early. Such a line has an odd number of quotes (those after a backslash do
not count), so files that have any are known for certain, and only their lines are put together again: each split
counts its quotes, the counts of a file's splits are added up, and lines between two real ends are joined in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A quoted text; possessive, so that it takes constant stack and never goes back.
_QUOTED = r'"(?:[^"\\]++|\\.)*+"'

# From the last brace outside of quoted texts on.
_INNERMOST = rf'(?s)\{{(?:[^{{"]++|{_QUOTED})*+$'


def read_objects(spark: SparkSession, *paths: str) -> DataFrame:
    """Every object without objects inside: `file`, `before` (the text since the last brace) and `object` (JSON text).

    A closing brace of an object with objects inside gives no row. Files may have any layout of lines.
    """
    lines = spark.read.option("lineSep", "}").text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value"
    )
    unescaped = F.regexp_replace("value", r"\\.", "")
    odd = lines.withColumns({
        "odd": F.length(F.regexp_replace(unescaped, '[^"]++', "")) % 2, "place": F.monotonically_increasing_id(),
    })
    # Names of some of the files, of which the driver holds the whole list anyway.
    broken = F.broadcast(odd.filter("odd = 1").select("file").distinct())
    whole = odd.join(broken, "file", "left_anti").select("file", "value")
    texts = whole.unionByName(_joined(odd.join(broken, "file", "left_semi")))
    opened = F.regexp_extract("value", _INNERMOST, 0)
    return (
        texts.withColumn("opened", opened).filter("opened <> ''")
        .select("file", F.expr("substring(value, 1, length(value) - length(opened))").alias("before"),
                F.concat("opened", F.lit("}")).alias("object"))
    )


def _joined(lines: DataFrame) -> DataFrame:
    """Lines of files with braces in quoted texts, joined from one real end to the next."""
    in_split = Window.partitionBy("file", "split").orderBy("place")
    so_far = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)

    def before(name: str) -> Column:
        return F.coalesce(F.sum(name).over(earlier), F.lit(0))

    quotes = lines.groupBy("file", "split").agg(F.sum("odd").alias("n")).select("file", "split", before("n").alias("n_before"))
    ended = (
        lines.withColumn("n", F.sum("odd").over(so_far)).join(quotes, ["file", "split"])
        .withColumn("ends", ((F.col("n") + F.col("n_before")) % 2 == 0).cast("int"))
    )
    ends = ended.groupBy("file", "split").agg(F.sum("ends").alias("e")).select("file", "split", before("e").alias("e_before"))
    numbered = (
        ended.withColumn("e", F.sum("ends").over(so_far) - F.col("ends")).join(ends, ["file", "split"])
        .withColumn("record", F.col("e") + F.col("e_before"))
    )
    gathered = F.sort_array(F.collect_list(F.struct("split", "place", "value")))
    return numbered.groupBy("file", "record").agg(F.array_join(gathered["value"], "}").alias("value")).select("file", "value")


def elements(objects: DataFrame, array: str | None = None) -> DataFrame:
    """Objects that are elements of the file's array, or of its outermost object's array of that name.

    Without a name, an object that is no part of anything (a file with a single record, or a record a line) counts as well.
    Records with objects inside, and objects in arrays of other names, are errors, so that nothing is left out or mixed up.
    """
    unquoted = F.regexp_replace("before", _QUOTED, '""')

    def error(text: str) -> Column:
        return F.raise_error(F.concat(F.lit(text), F.col("file"))).cast("boolean")

    opens = F.regexp_extract("before", rf'({_QUOTED})\s*:\s*\[\s*$', 1)
    taken = F.when(unquoted.rlike(r"[\[,]\s*\{"), error("a record has objects inside in ")).when(
        (opens != "") & (opens != (f'"{array}"' if array else "")), error("objects in an array of another name in ")
    ).otherwise(F.col("before").rlike(r"[\[,]\s*$" if array else r"(^|[\[,])\s*$"))
    return objects.filter(taken)


def named(objects: DataFrame, name: str) -> DataFrame:
    """Objects that are the value of a name."""
    return objects.filter(F.col("before").rlike(rf'"{name}"\s*:\s*$'))


def parsed(objects: DataFrame, schema: T.StructType, *kept: str) -> DataFrame:
    """The objects' fields as columns, `kept` columns in front."""
    return objects.select(*kept, F.from_json("object", schema).alias("_record")).select(*kept, "_record.*")
