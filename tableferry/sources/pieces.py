"""Text files whose records do not end where a line does, read in parallel.

A file is cut at a delimiter into pieces, by as many tasks as it has blocks.
Whether a piece starts inside a quoted text depends on all the pieces before
it; that state is worked out per block first and then over the few blocks. So
no task ever needs a whole file, and the rows carry their place in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tableferry.sources.relation import materialize

FILE, BLOCK, POS, TEXT = "__file", "__block", "__pos", "__text"
_RECORD, _BEFORE = "__record", "__before"


def read_pieces(spark: SparkSession, path: str | list[str], delimiter: str) -> DataFrame:
    """One row per piece, with its file, the start of its block and its place there."""
    text = spark.read.option("lineSep", delimiter).text(path)
    return text.select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(POS),
        F.col("value").alias(TEXT),
    )


def count_of(text: Column, mark: str) -> Column:
    """How often a character occurs in a text."""
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def with_total_before(pieces: DataFrame, value: Column, name: str) -> DataFrame:
    """Add the total of ``value`` over all earlier pieces of the same file."""
    earlier = (W.unboundedPreceding, -1)
    valued = pieces.withColumn(name, value.cast("bigint"))
    in_file = W.partitionBy(FILE).orderBy(BLOCK).rowsBetween(*earlier)
    blocks = (
        valued.groupBy(FILE, BLOCK)
        .agg(F.sum(name).alias(_BEFORE))
        .withColumn(_BEFORE, F.coalesce(F.sum(_BEFORE).over(in_file), F.lit(0)))
    )
    in_block = W.partitionBy(FILE, BLOCK).orderBy(POS).rowsBetween(*earlier)
    return (
        valued.withColumn(name, F.coalesce(F.sum(name).over(in_block), F.lit(0)))
        .join(blocks, [FILE, BLOCK])
        .withColumn(name, F.col(name) + F.col(_BEFORE))
        .drop(_BEFORE)
    )


def _starts(steps: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add ``__known`` and ``__parity``: how each step starts, given steps that fix or turn the state.

    ``__fixed`` is the state that a step leaves whatever it was, or NULL;
    ``__turn`` is 1 if it turns the state over. Before the first fixed step only
    the parity of the turns is known.
    """
    earlier = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    turns = F.coalesce(F.sum("__turn").over(earlier), F.lit(0))
    counted = steps.withColumn("__turns", turns)
    mark = F.when(F.col("__fixed").isNotNull(), F.struct("__fixed", "__turns"))
    last = counted.withColumn("__last", F.last(mark, ignorenulls=True).over(earlier))
    since = F.col("__last.__fixed") + F.col("__turns") - F.col("__last.__turns")
    return last.withColumns({"__known": since % 2, "__parity": F.col("__turns") % 2})


def _steps(pieces: DataFrame, outside: Column, inside: Column) -> DataFrame:
    """Add what a piece makes of the state, inside (1) or outside (0) of a quoted text, see ``_starts``.

    ``outside`` and ``inside`` tell, for a piece on its own, whether it would end
    inside if it started there.
    """
    known = pieces.withColumns({"__out": outside.cast("int"), "__in": inside.cast("int")})
    return known.withColumns(
        {
            "__fixed": F.when(F.col("__out") == F.col("__in"), F.col("__out")),
            "__turn": (F.col("__out") > F.col("__in")).cast("int"),
        }
    ).drop("__out", "__in")


def with_records(pieces: DataFrame, outside: Column, inside: Column, record: str) -> DataFrame:
    """Add the number of the record of each piece: a piece that starts outside of quotes begins one.

    The pieces of a block are brought together and stored once, each with its state
    and the records begun so far, for a block that starts outside and one that starts
    inside. What a block makes of its start is then put together over the blocks of a
    file, which starts outside, and says which of the two holds.
    """
    in_block = _starts(_steps(pieces, outside, inside), [FILE, BLOCK], POS)
    upto = W.partitionBy(FILE, BLOCK).orderBy(POS).rowsBetween(W.unboundedPreceding, 0)

    def begun_from(start: int) -> Column:
        state = F.coalesce("__known", (F.lit(start) + F.col("__parity")) % 2)
        return F.sum(1 - state).over(upto)

    kept = ("__known", "__parity", "__fixed", "__turn", "__n0", "__n1")
    counted = in_block.withColumns({"__n0": begun_from(0), "__n1": begun_from(1)})
    stored = materialize(counted.select(FILE, BLOCK, POS, TEXT, *kept))
    last = stored.groupBy(FILE, BLOCK).agg(F.max_by(F.struct(*kept), POS).alias("l"))
    fixed = F.coalesce("l.__fixed", (F.col("l.__known") + F.col("l.__turn")) % 2)
    blocks = last.select(
        FILE,
        BLOCK,
        fixed.alias("__fixed"),
        F.when(fixed.isNull(), (F.col("l.__parity") + F.col("l.__turn")) % 2).otherwise(0).alias("__turn"),
        F.col("l.__n0").alias("__of0"),
        F.col("l.__n1").alias("__of1"),
    )
    begun = _starts(blocks, [FILE], BLOCK).withColumn("__begun", F.coalesce("__known", "__parity"))
    earlier = W.partitionBy(FILE).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    own = F.when(F.col("__begun") == 0, F.col("__of0")).otherwise(F.col("__of1"))
    before = F.coalesce(F.sum(own).over(earlier), F.lit(0))
    begun = begun.select(FILE, BLOCK, "__begun", before.alias(_BEFORE))
    number = F.col(_BEFORE) + F.when(F.col("__begun") == 0, F.col("__n0")).otherwise(F.col("__n1"))
    # a row for each block, which Spark broadcasts if they are few
    return stored.join(begun, [FILE, BLOCK]).select(FILE, BLOCK, POS, TEXT, number.alias(record))


def join_records(pieces: DataFrame, record: str, delimiter: str) -> DataFrame:
    """Join the pieces of each record: its text, and the block and place where it starts.

    A group is a single record, so it is as large as that record and no larger.
    """
    parts = F.array_sort(F.collect_list(F.struct(BLOCK, POS, TEXT)))
    joined = pieces.groupBy(FILE, record).agg(parts.alias("__parts"))
    first = F.get("__parts", F.lit(0))
    return joined.select(
        FILE,
        record,
        first[BLOCK].alias(BLOCK),
        first[POS].alias(POS),
        F.array_join(F.transform("__parts", lambda p: p[TEXT]), delimiter).alias(TEXT),
    )


# -- quoted CSV ---------------------------------------------------------------


def _leaves_open(text: Column, sep: str) -> Column:
    """Whether a CSV text that starts outside of quotes ends inside.

    A quote opens a cell only at the cell's start, and closes it only before a
    separator or the end; any other quote is a character like the rest.
    """
    edge = "\\Q" + sep + "\\E"
    closed = rf'(\A|{edge})"(?:[^"]|"")*+"(?={edge}|\r?\z)'
    rest = F.regexp_replace(text, closed, "$1")
    opened = rest.rlike(rf'(?:\A|{edge})"(?:[^"]|"")*+\z')
    return F.contains(text, F.lit('"')) & opened


def spans_lines(spark: SparkSession, path: str | list[str], sep: str) -> bool:
    """Whether any line leaves a quote open, so that a record spans lines."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return bool(lines.agg(F.some(_leaves_open(F.col("value"), sep))).first()[0])


def csv_records(spark: SparkSession, path: str | list[str], sep: str) -> DataFrame:
    """The records of quoted CSV files with their places, header lines left out."""
    text = F.col(TEXT)
    # "~ stands for what a cell that is open already began with
    outside, inside = _leaves_open(text, sep), _leaves_open(F.concat(F.lit('"~'), text), sep)
    lines = with_records(read_pieces(spark, path, "\n"), outside, inside, _RECORD)
    plain = F.regexp_replace(text, r"\r\z", "")
    found = join_records(lines, _RECORD, "\n").select(FILE, _RECORD, BLOCK, POS, plain.alias(TEXT))
    records = materialize(found.where((F.col(_RECORD) == 1) | (F.trim(TEXT) != "")))
    bare = F.regexp_replace(text, "\\A\ufeff", "")
    if records.where(F.col(_RECORD) == 1).select(bare).distinct().limit(2).count() > 1:
        raise ValueError("the files have different headers")
    return records.where(F.col(_RECORD) > 1).drop(_RECORD)


# -- JSON ---------------------------------------------------------------------


def _with_json_state(pieces: DataFrame, delimiter: str) -> DataFrame:
    """Add what each piece holds outside quoted texts, and the depth it starts at.

    ``__open`` tells whether the delimiter after the piece is outside a text.
    A closing brace that served as delimiter counts for its piece.
    """
    unescaped = F.regexp_replace(TEXT, r"(?s)\\.", "")
    marked = with_total_before(
        pieces.withColumn("__plain", unescaped), count_of(unescaped, '"'), "__quotes"
    )
    inside = F.col("__quotes") % 2
    outside = F.array_join(
        F.filter(F.split(F.col("__plain"), '"'), lambda _, i: i % 2 == inside), " "
    )
    free = (F.col("__quotes") + count_of(F.col("__plain"), '"')) % 2 == 0
    marked = marked.withColumns({"__outside": outside, "__free": free})
    bare = F.col("__outside")
    if delimiter == "}":
        rise = count_of(bare, "{") - F.when(F.col("__free"), 1).otherwise(0)
    else:
        ups = count_of(bare, "{") + count_of(bare, "[")
        rise = ups - count_of(bare, "}") - count_of(bare, "]")
    deep = with_total_before(marked.withColumn("__rise", rise), F.col("__rise"), "__depth")
    # Stored once, as every further total over the pieces reads it twice.
    ended = F.col("__depth") + F.col("__rise") <= 0
    trails = bare.rlike(r"\}\s*\{") | ended & bare.rlike(r"\}\s*[^\s}]+\s*\z")
    opening = (F.col(BLOCK) == 0) & (F.col("__quotes") == 0) & bare.rlike(r"\A[\s﻿]*[\[{]")
    return materialize(
        deep.select(
            FILE, BLOCK, POS, TEXT, "__quotes", "__free", "__rise", "__depth",
            opening.alias("__first"), trails.alias("__trails"),
        )
    )


def json_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The objects of JSON arrays, one per row and free of line breaks."""
    pieces = _with_json_state(read_pieces(spark, path, "}"), "}")
    ends = F.col("__free") & (F.col("__depth") + F.col("__rise") == 0)
    pieces = with_total_before(pieces, F.when(ends, 1).otherwise(0), _RECORD)
    joined = join_records(pieces, _RECORD, "}")
    # Only the brackets after the last object of a file make a record without an object.
    objects = joined.where(~F.col(TEXT).rlike(r"\A[\s﻿]*\[?\s*\]?\s*\z"))
    # An array has one opening bracket, at its start; any other stays and is refused.
    text = F.regexp_replace(F.col(TEXT), r"\A[\s﻿]*[,\[]\s*", "")
    value = F.concat(F.translate(text, "\r\n", "  "), F.lit("}"))
    return objects.select(FILE, BLOCK, POS, value.alias("value"))


def json_cells(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The cells of column-wise JSON: file, column_no, title, label, cell."""
    pieces = _with_json_state(read_pieces(spark, path, ","), ",")
    after = F.col("__depth") + F.col("__rise")
    late = (F.col("__depth") <= 0) & ~F.col("__first") & (F.trim(TEXT) != "") | F.col("__trails")
    pieces = pieces.withColumn(
        TEXT,
        F.when(late, F.raise_error(F.lit("content after the end of a JSON object"))).otherwise(F.col(TEXT)),
    )
    # The outer object is depth 1 and a column depth 2, so a cell ends at depth 2 or less.
    ends = F.when(F.col("__free") & (after <= 2), 1).otherwise(0)
    heads = F.when((F.col("__depth") <= 1) & (F.col("__quotes") % 2 == 0), 1).otherwise(0)
    pieces = with_total_before(pieces.withColumns({"__after": after}), ends, _RECORD)
    pieces = with_total_before(pieces, heads, "__column")
    pieces = pieces.withColumn("__column", F.col("__column") + heads)

    parts = F.array_sort(F.collect_list(F.struct(BLOCK, POS, TEXT, "__after")))
    joined = pieces.groupBy(FILE, "__column", _RECORD).agg(parts.alias("__parts")).select(
        FILE,
        "__column",
        F.array_join(F.transform("__parts", lambda p: p[TEXT]), ",").alias(TEXT),
        F.element_at("__parts", -1)["__after"].alias("__after"),
    )
    # The last cell of a column ends with the column's brace, that of the file with one more.
    brace, text = r"\s*\}\s*\z", F.col(TEXT)
    text = F.when(F.col("__after") <= 1, F.regexp_replace(text, brace, "")).otherwise(text)
    text = F.when(F.col("__after") <= 0, F.regexp_replace(text, brace, "")).otherwise(text)
    head = r'\A[﻿\s]*\{?\s*("(?:[^"\\]|\\.)*+")\s*:\s*\{'
    title = F.nullif(F.regexp_extract(text, head, 1), F.lit(""))
    pair = F.concat(F.lit("{"), F.regexp_replace(text, head, ""), F.lit("}"))
    cells = joined.select(FILE, "__column", title.alias("title"), pair.alias("pair"))
    titles = cells.where("title IS NOT NULL").select(
        FILE,
        "__column",
        F.from_json(F.concat(F.lit("["), "title", F.lit("]")), "array<string>")[0].alias("title"),
    )
    # No hint: Spark broadcasts the titles if they turn out small, and otherwise
    # splits a column that holds many of the cells.
    return (
        cells.drop("title")
        .join(titles, [FILE, "__column"])
        .select(
            F.col(FILE).alias("file"),
            F.col("__column").alias("column_no"),
            "title",
            F.explode(F.from_json("pair", "map<string,string>", {"mode": "FAILFAST"})).alias(
                "label", "cell"
            ),
        )
    )
