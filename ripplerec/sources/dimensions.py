"""Dimension files: A5 ``read_id_map`` / ``write_id_map`` and A6
``read_embeddings`` / ``write_embeddings``.

The reference keeps each dictionary as one JSON object (raw id text -> dense
int) and the embeddings as one object ``{"user": [[..]], "item": [[..]]}``.
Both are read in parallel however large the object is: the files are cut into byte
ranges at the object's own separators (``,`` of a map, ``]`` of a matrix row), so a
task holds one entry at a time, and a row's position follows from counts per byte range.
A file may hold one object or several, and a folder several files.  The
writers produce objects of bounded size.  Parquet ``(id, vec)`` tables are the scalable
form for embeddings and are read by plain ``spark.read.parquet``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Rows of one JSON object that a writer makes.
ROWS_PER_OBJECT = 100_000

_PAIR = r'"\s*(-?[0-9]+)\s*"\s*:\s*(-?[0-9]+)'


def _broken(path: str) -> Column:
    return F.raise_error(F.lit(f"not a JSON object: a file of {path}"))


def _pieces(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, block, at, value): the text between separators; ``at`` rises within a byte range."""
    return spark.read.option("lineSep", sep).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


def _check_closed(pieces: DataFrame, path: str) -> None:
    """An object that does not end fails the job instead of reading as fewer rows."""
    def number(c: str) -> Column:
        return F.sum(F.length("value") - F.length(F.replace(F.col("value"), F.lit(c), F.lit(""))))
    odd = pieces.groupBy("file").agg(number("{").alias("a"), number("}").alias("b")).where("a <> b or a = 0")
    found = odd.first()
    if found:
        raise ValueError(f"not a JSON object: {found['file']}")


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """A5: JSON object file(s) -> (raw_id BIGINT, dense_id INT)."""
    pieces = _pieces(spark, path, ",")
    _check_closed(pieces, path)
    rest = F.trim(F.regexp_replace("value", r"[{}\s]|" + _PAIR, ""))
    pairs = F.when(rest == "", F.regexp_extract_all("value", F.lit(_PAIR), 0)).otherwise(_broken(path))
    return pieces.select(F.explode(pairs).alias("p")).select(
        F.regexp_extract("p", _PAIR, 1).cast("bigint").alias("raw_id"),
        F.regexp_extract("p", _PAIR, 2).cast("int").alias("dense_id"))


def write_id_map(id_map: DataFrame, path: str, parts: int | None = None,
                 rows_per_part: int = 1_000_000) -> None:
    """Write (raw_id, dense_id) as JSON-object files, one per hash part of
    the keys.  Unless ``parts`` is given, the part count is the measured row
    count / ``rows_per_part``, so no object (one task) grows with the data."""
    if parts is None:
        parts = max(1, -(-id_map.count() // rows_per_part))
    grouped = (id_map.withColumn("_part", F.pmod(F.hash("raw_id"), F.lit(parts)))
               .groupBy("_part")
               .agg(F.map_from_entries(F.collect_list(F.struct(
                   F.col("raw_id").cast("string"), F.col("dense_id")))).alias("m")))
    (grouped.select(F.to_json("m").alias("value")).repartition(parts)
     .write.mode("overwrite").text(path))


def read_embeddings(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """``{"user": [[f..]], "item": [[f..]]}`` file(s) -> (kind, id, vec).

    Row position in the JSON array is the dense id; where several objects hold rows of a
    kind, in one file or in a folder of files, the positions go on from one to the
    next, in the order of the file names.  ``kind`` keeps one entity type.

    A matrix row is the text up to its ``]``; the name of a kind stands before the kind's first
    row.  Counts per byte range and per named stretch give every row its position,
    so no task sees more than its own range.
    """
    pieces = _pieces(spark, path, "]")
    _check_closed(pieces, path)
    body = F.regexp_extract("value", r"\[([^\[]*)$", 1)
    is_row = F.col("value").rlike(r"[\[,]\s*\[[^\[]*$")  # else the end of a matrix, or an empty one
    name = F.regexp_extract("value", r'"([^"]*)"\s*:\s*\[\s*\[[^\[]*$', 1)
    odd = ~is_row & (F.trim(F.regexp_replace("value", r'[{},\s]|"[^"]*"\s*:\s*\[?', "")) != "")
    vec = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<float>", {"mode": "FAILFAST"})
    rows = pieces.select("file", "block", "at", F.when(odd, _broken(path).cast("boolean")).otherwise(is_row).alias("row"),
                         F.when(is_row & (name != ""), name).alias("name"), F.when(is_row, vec).alias("vec"))
    # parsed and written once: the counts and the rows come from the same ranges
    rows = materialize(rows.where("row").drop("row"), "embedding_rows")
    # rows before each byte range (a table of the ranges)
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    ranges = ranges.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), "n")
    placed = rows.withColumn("nth", F.row_number().over(Window.partitionBy("file", "block").orderBy("at")) - 1)
    placed = placed.join(ranges.select("file", "block", "before"), ["file", "block"]).select(
        "file", "block", (F.col("before") + F.col("nth")).alias("g"), "name", "vec")
    # the named stretches (one an object and kind): where they begin and their kind's rows before
    after = Window.orderBy("start")
    total = rows.count()
    stretch = placed.where("name is not null").select(F.col("name").alias("kind"), F.col("g").alias("start"))
    stretch = stretch.withColumn("stop", F.lead("start", 1, total).over(after))
    earlier = Window.partitionBy("kind").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    stretch = stretch.withColumn("offset", F.coalesce(F.sum(F.col("stop") - F.col("start")).over(earlier), F.lit(0)))
    # a byte range meets the few stretches that overlap it
    spans = ranges.join(stretch, (F.col("start") < F.col("before") + F.col("n")) & (F.col("stop") > F.col("before"))) \
        .groupBy("file", "block").agg(F.collect_list(F.struct("start", "stop", "kind", "offset")).alias("spans"))
    found = placed.drop("name").join(spans, ["file", "block"], "left").withColumn(
        "in", F.get(F.filter("spans", lambda s: (s["start"] <= F.col("g")) & (F.col("g") < s["stop"])), F.lit(0)))
    out = found.select(F.coalesce("in.kind", _broken(path)).alias("kind"),
                       (F.col("g") - F.col("in.start") + F.col("in.offset")).cast("int").alias("id"), "vec")
    return out if kind is None else out.where(F.col("kind") == kind)


def write_embeddings(user_vecs: DataFrame, item_vecs: DataFrame, path: str, dim: int,
                     rows_per_object: int = ROWS_PER_OBJECT) -> None:
    """Write dense-id vectors in the reference's JSON layout (rows indexed by dense id;
    ids with no vector get zeros): one object per kind and range of ``rows_per_object``
    ids, in files that go on from one range to the next.  No task holds more than a range."""
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    both = user_vecs.select(F.lit("user").alias("kind"), F.col("id").cast("long").alias("id"), "vec").union(
        item_vecs.select(F.lit("item").alias("kind"), F.col("id").cast("long").alias("id"), "vec"))
    tops = both.groupBy("kind").agg(F.max("id").alias("top"))
    parts = tops.select("kind", "top", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("top") / rows_per_object))).alias("part"))
    first = F.col("part") * rows_per_object
    ids = parts.select("kind", "part", F.explode(F.sequence(
        first, F.least(first + rows_per_object - 1, F.col("top")))).alias("id"))
    full = ids.join(both, ["kind", "id"], "left").select("kind", "part", "id", F.coalesce("vec", zero).alias("vec"))
    objects = full.groupBy("kind", "part").agg(F.array_sort(F.collect_list(F.struct("id", "vec"))).alias("r"))
    text = F.concat(F.lit('{"'), F.col("kind"), F.lit('":'), F.to_json(F.transform("r", lambda x: x["vec"])), F.lit("}"))
    n = parts.count()
    # file names follow the ranges' order
    (objects.select("kind", "part", text.alias("value")).repartitionByRange(max(n, 1), "kind", "part")
     .sortWithinPartitions("kind", "part").select("value").write.mode("overwrite").text(path))
