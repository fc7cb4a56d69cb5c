"""One huge pretty-printed graph document, read by many tasks.

A JSON string cannot hold a raw line break, so every line of a document starts outside strings. Lines are read into
runs of ``RUN``, one row each: a task reads the lines of a run together, so they are packed before the only shuffle
that moves text. Sums of how much lines open and close give the depth at which every line starts: inside the row,
carried from run to run by a row of numbers for each. A line that stays inside an item is kept as it is; of the others,
keys at the top and commas between items become marks. Sums of these marks give every item its number, the last key
its list. An item that ends in the run it began in is cut there; only fragments at the ends of runs meet in a group.

A document on a single line stays one row; such files are what ``read_graph`` reads. A key and its colon have to share
a line.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from evgraph.functions.text import let, with_prefix_sums
from evgraph.session import held, scratch_path, written
from evgraph.sources.graph_json import EDGE_FIELDS, NODE_FIELDS, PLACE, _fields

RUN_BITS = 13
RUN = 1 << RUN_BITS  # lines
PLACE_WIDTH = len(str(RUN))  # digits of a line's place in its run
STEP = 32  # lines summed at once
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
TOKEN = STRING + r'|[{}\[\]:,]|[^\s{}\[\]:,"]+|"'  # a lone quote is an error that surfaces when an item is parsed
KEY, ITEM, END = "\x01", "\x02", "\x03"  # marks; control characters cannot stand in JSON text
CUT = "spark.sql.files.maxPartitionBytes"
BLANK = " \t\r\n"
DEEP = 3  # depth inside an item


def _change(token: Column) -> Column:
    return F.when(token.isin("{", "["), 1).when(token.isin("}", "]"), -1).otherwise(0)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def _starts(changes: Column) -> Column:
    """The sum of all values before each."""
    def inside(carry: Column, some: Column) -> Column:
        return F.transform(some, lambda x, i: carry + _sum(F.slice(some, F.lit(1), i)))

    def step(totals: Column) -> Column:
        return F.flatten(F.transform(totals, lambda t, b: let(_sum(F.slice(totals, F.lit(1), b)), lambda carry: let(
            F.slice(changes, b * STEP + 1, F.lit(STEP)), lambda some: inside(carry, some)
        ))))

    steps = F.sequence(F.lit(0), F.floor((F.size(changes) - 1) / STEP).cast("int"))
    return let(F.transform(steps, lambda b: _sum(F.slice(changes, b * STEP + 1, F.lit(STEP)))), step)


def _packed(df: DataFrame, name: str) -> DataFrame:
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _cut_every(spark: SparkSession, size: str | None) -> Iterator[None]:
    """Files read meanwhile are cut at this size."""
    before = spark.conf.get(CUT)
    spark.conf.set(CUT, size or before)
    try:
        yield
    finally:
        spark.conf.set(CUT, before)


def packed_runs(spark: SparkSession, path: str, cut: str | None = None) -> DataFrame:
    """doc, run (in order inside it), lines (each with what it opens and closes) and the change of depth of every run.

    ``cut`` is the size at which files are cut, for compressed ones that hold many lines."""
    lines = spark.read.text(path).select(
        F.input_file_name().alias("doc"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value"
    )
    # a line moves as one text that its place in the run leads, in digits of one width
    place = F.lpad((F.col("at") % (1 << RUN_BITS)).cast("string"), PLACE_WIDTH, "0")
    runs = lines.groupBy("doc", F.struct("block", F.shiftright("at", RUN_BITS).alias("part")).alias("run")).agg(
        F.sort_array(F.collect_list(F.concat(place, "value"))).alias("_lines")
    )

    def counted(line: Column) -> Column:
        return let(F.substr(line, F.lit(PLACE_WIDTH + 1)), weighed)

    def weighed(text: Column) -> Column:
        def without(chars: str, bare: Column) -> Column:
            return F.length(bare) - F.length(F.translate(bare, chars, ""))

        return let(F.regexp_replace(text, STRING, ""), lambda bare: F.struct(
            text.alias("value"), without("{[", bare).alias("opens"), without("}]", bare).alias("closes")
        ))

    runs = runs.select("doc", "run", F.transform("_lines", counted).alias("lines"))
    change = F.aggregate("lines", F.lit(0), lambda s, x: s + x["opens"] - x["closes"])
    with _cut_every(spark, cut):
        return _packed(runs.withColumn("change", change), "runs")


def _marked(tokens: Column, start: Column) -> Column:
    """The line as text: keys at the top and commas between items become marks, and what lies outside items goes."""
    def rebuilt(before) -> Column:
        def one(token: Column, i: Column) -> Column:
            depth = start + before(i)
            key = (depth == 1) & token.startswith('"') & F.coalesce(F.get(tokens, i + 1) == ":", F.lit(False))
            closing = token.isin("}", "]")
            inside = (depth > 2) | ((depth == 2) & ~closing)
            return F.when(key, F.concat(F.lit(KEY), token, F.lit(END))).when((depth == 2) & (token == ","), ITEM).when(inside, token).otherwise("")

        return F.array_join(F.transform(tokens, one), " ")

    return let(F.transform(tokens, _change), lambda changes: with_prefix_sums(changes, rebuilt))


def _commas(marked: Column) -> Column:
    return F.length(marked) - F.length(F.replace(marked, F.lit(ITEM), F.lit("")))


def _joined(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """Rows with the numbers (doc, run and others) of their run, which are written first and come to the rows."""
    numbers = held(written(numbers, "numbers")).withColumnsRenamed({"doc": "_doc", "run": "_run"})
    return rows.join(numbers, (F.col("doc") == F.col("_doc")) & (F.col("run") == F.col("_run"))).drop("_doc", "_run")


def marked_runs(spark: SparkSession, path: str, cut: str | None = None) -> DataFrame:
    """doc, run, the marked text of its lines, its keys and its number of commas between items."""
    runs = packed_runs(spark, path, cut)
    if not runs.groupBy("doc").agg(F.sum("change").alias("_left")).where("_left != 0").isEmpty():
        raise ValueError("a document closes less or more than it opens")
    before = Window.partitionBy("doc").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    depths = runs.select("doc", "run", F.coalesce(F.sum("change").over(before), F.lit(0)).cast("int").alias("_depth"))

    def text(starts: Column) -> Column:
        def one(line: Column, i: Column) -> Column:
            start = F.col("_depth") + F.get(starts, i)
            tokens = F.regexp_extract_all(line["value"], F.lit(TOKEN), F.lit(0))
            return F.when(start - line["closes"] >= DEEP, line["value"]).otherwise(let(tokens, lambda ts: _marked(ts, start)))

        return F.array_join(F.transform("lines", one), "\n")

    changes = F.transform("lines", lambda x: x["opens"] - x["closes"])
    marked = _joined(runs.drop("change"), depths).select("doc", "run", let(let(changes, _starts), text).alias("marked"))
    keys = F.regexp_extract_all("marked", F.lit(f"{KEY}([^{END}]*){END}"), F.lit(1))
    return _packed(marked.withColumns({"keys": keys, "commas": _commas(F.col("marked"))}), "marked")


def items(spark: SparkSession, path: str, cut: str | None = None) -> DataFrame:
    """doc, part (``nodes`` or ``edges``), pos and the JSON text of every item of these lists at the top of the documents."""
    runs = marked_runs(spark, path, cut)
    lists = runs.select("doc", F.explode("keys").alias("key")).where(F.col("key").isin('"nodes"', '"edges"'))
    if not lists.groupBy("doc", "key").count().where("count > 1").isEmpty():
        raise ValueError("a document names a list twice")
    # the list and the number of the item that a run begins in: the last key before it, and the commas since
    before = Window.partitionBy("doc").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    tail = _commas(F.substring_index("marked", KEY, -1))
    numbers = runs.select("doc", "run", "commas", F.element_at("keys", F.when(F.size("keys") > 0, -1)).alias("_key"), tail.alias("_tail"))
    numbers = numbers.withColumn("_up_to", F.coalesce(F.sum("commas").over(before), F.lit(0)))
    last = F.when(F.col("_key").isNotNull(), F.struct(F.col("_key").alias("part"), (F.col("_up_to") + F.col("commas") - F.col("_tail")).alias("begins")))
    numbers = numbers.withColumn("_open", F.last(last, ignorenulls=True).over(before))
    numbers = numbers.select("doc", "run", F.col("_open.part").alias("_part"), (F.col("_up_to") - F.col("_open.begins")).alias("_past"))
    n_keys = F.size("keys").alias("_n")
    pieces = _joined(runs, numbers).select("doc", "run", "_part", "_past", n_keys, F.posexplode(F.split("marked", KEY, -1)).alias("_k", "_piece"))
    own = F.col("_k") > 0
    pieces = pieces.select(
        "doc", "run", "_k", "_n", F.btrim(F.when(own, F.substring_index("_piece", END, 1)).otherwise(F.col("_part")), F.lit('"')).alias("part"),
        F.when(own, F.lit(0)).otherwise(F.col("_past")).alias("_past"), F.split(F.substring_index("_piece", END, -1), ITEM, -1).alias("_items"),
    ).where(F.col("part").isin("nodes", "edges"))
    first, last = (F.col("_k") == 0) & (F.col("_i") == 0), (F.col("_k") == F.col("_n")) & (F.col("_i") == F.col("_m") - 1)
    fragments = pieces.select("doc", "run", "part", "_k", "_n", "_past", F.size("_items").alias("_m"), F.posexplode("_items").alias("_i", "text"))
    fragments = fragments.select("doc", "run", "part", (F.col("_past") + F.col("_i")).cast("int").alias("pos"), "text", (first | last).alias("_cut"))
    whole = fragments.where("not _cut").select("doc", "part", "pos", "text")
    met = fragments.where("_cut").groupBy("doc", "part", "pos").agg(F.array_sort(F.collect_list(F.struct("run", "text"))).alias("_f"))
    met = met.select("doc", "part", "pos", F.array_join(F.transform("_f", lambda f: f["text"]), "\n").alias("text"))
    return whole.unionByName(met).where(F.btrim("text", F.lit(BLANK)) != "")


def read_split(spark: SparkSession, path: str, cut: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Node and edge rows of pretty-printed documents, as ``graph_json.nodes`` and ``edges`` give them."""
    raw = items(spark, path, cut).select("doc", F.lit(0).cast("long").alias("line"), "pos", "part", F.parse_json("text").alias("raw"))
    return (
        raw.where("part = 'nodes'").select(*PLACE, *_fields(NODE_FIELDS), "raw"),
        raw.where("part = 'edges'").select(*PLACE, *_fields(EDGE_FIELDS), "raw"),
    )
