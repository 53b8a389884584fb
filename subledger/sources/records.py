"""Records that no separator alone delimits: elements of a JSON array, CSV records
with line ends inside quotes. Large files are cut by many tasks.

A file is scanned in pieces (a JSON array at every ``}``, a CSV file at every line
end). Whether a piece starts inside a string or a quoted field, and how deep it is
nested, depends on all that stands before it, so every piece is summed up for both
possible starts, and the sums are composed: along the pieces of a split, then along
the splits of a file (one row each, written once), then back to the pieces. A piece
that starts outside opens a record; the pieces up to the next opening are joined.
A record that crosses splits has its fragments, two per split at most, joined in a
last step over the fragments alone.

No task holds more than one split, except for a record that is itself longer. A file
that ends inside a string, a quoted field or a bracket is not stitched: what is left
open is handed out in fragments of one split at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.session import written
from subledger.sources.lines import scanned

_SPLIT = ("_source_file", "_block")
#: A CSV line, its start outside quotes, that ends inside a quoted field: whole
#: fields (plain, or quoted and whatever follows the closing quote) and an open one.
_OPEN_FIELD = r'(?s)^(?:(?:[^",][^,]*+|"[^"]*+(?:""[^"]*+)*+"(?!")[^,]*+)?,)*+"[^"]*+(?:""[^"]*+)*+$'


def _before(part: tuple[str, ...], order: str):
    return Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _upto(part: tuple[str, ...], order: str):
    return Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _state_before(df: DataFrame, part: tuple[str, ...], order: str) -> DataFrame:
    """Compose ``_const`` (the state a row ends in whatever its start, else null) and
    ``_flip`` (it ends in the other state than it starts in) along ``order``: the
    state before a row is ``_known``, or that at the part's start where null,
    reversed if ``_odd``."""
    flips = df.withColumn("_flips", F.sum(F.col("_flip").cast("int")).over(_upto(part, order)))
    mark = F.when(F.col("_const").isNotNull(), F.struct(F.col(order), F.col("_const").alias("state"), F.col("_flips").alias("flips")))
    marked = flips.withColumn("_last", F.max(mark).over(_before(part, order)))
    since = F.col("_flips") - F.col("_flip").cast("int") - F.coalesce("_last.flips", F.lit(0))
    return marked.withColumns({"_known": F.col("_last.state"), "_odd": since % 2 == 1}).drop("_flips", "_last")


def _xor(a: Column, b: Column) -> Column:
    return a != b


def _texts(separator: str) -> Column:
    """The pieces of a group in order, the separator between them."""
    ordered = F.array_sort(F.collect_list(F.struct("_mid", "value")))
    return F.array_join(F.transform(ordered, lambda p: p["value"]), separator)


# -------------------------------------------------------------------- JSON arrays


def _net_depth(outside: Column) -> Column:
    """Opening minus closing brackets."""
    return (F.char_length(F.translate(outside, "]}", "")) - F.char_length(F.translate(outside, "[{", ""))).cast("bigint")


def _json_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces between ``}`` with their quotes (_flip) and the net depth of what is
    outside strings if the split starts outside (_a) or inside (_b) one."""
    raw = scanned(spark, path, "}").withColumn("_plain", F.regexp_replace(F.concat("value", F.lit("}")), r"(?s)\\.", ""))
    quotes = F.char_length("_plain") - F.char_length(F.replace("_plain", F.lit('"'), F.lit("")))
    strings = r'"[^"]*"?'
    out = raw.select(
        *_SPLIT,
        "_mid",
        "_size",
        "value",
        F.lit(None).cast("boolean").alias("_const"),
        (quotes % 2 == 1).alias("_flip"),
        _net_depth(F.regexp_replace("_plain", strings, "")).alias("_d0"),
        _net_depth(F.regexp_replace(F.concat(F.lit('"'), "_plain"), strings, "")).alias("_d1"),
    )
    own = _state_before(out, _SPLIT, "_mid")
    a, b = F.when(F.col("_odd"), F.col("_d1")).otherwise(F.col("_d0")), F.when(F.col("_odd"), F.col("_d0")).otherwise(F.col("_d1"))
    return own.withColumns({"_a": a, "_b": b}).drop("_d0", "_d1")


def _json_splits(pieces: DataFrame) -> DataFrame:
    """One row per split: whether it starts inside a string (_in), how deep (_depth),
    whether the next one starts with a new element (_fresh_after), and of its file
    the last split, whether a ``}`` ends it (_closed) and whether it ends as an
    array must (_sound)."""
    per = pieces.groupBy(*_SPLIT).agg(
        F.sum(F.col("_flip").cast("int")).alias("flips"),
        F.sum("_a").alias("a"),
        F.sum("_b").alias("b"),
        F.sum(F.octet_length("value").cast("bigint") + 1).alias("bytes"),
        F.max("_size").alias("size"),
    )
    file = ("_source_file",)
    whole = Window.partitionBy(*file)
    along = Window.partitionBy(*file).orderBy("_block")
    inside = per.withColumn("_in", F.coalesce(F.sum("flips").over(_before(file, "_block")), F.lit(0)) % 2 == 1)
    deep = inside.withColumn("d", F.when(F.col("_in"), F.col("b")).otherwise(F.col("a")))
    placed = deep.withColumns(
        {
            "_depth": F.coalesce(F.sum("d").over(_before(file, "_block")), F.lit(0)),
            "_last_block": F.max("_block").over(whole),
            "_closed": F.sum("bytes").over(whole) == F.max("size").over(whole),
            "end_in": F.sum("flips").over(whole) % 2 == 1,
        }
    )
    end_depth = F.sum("d").over(whole) + F.when(F.col("_closed"), 0).otherwise(1)
    fresh = ~F.col("_in") & (F.col("_depth") <= 1)
    return placed.select(
        *_SPLIT,
        "_in",
        "_depth",
        "_last_block",
        "_closed",
        F.coalesce(F.lead(fresh).over(along), F.lit(True)).alias("_fresh_after"),
        (~F.col("end_in") & ~F.col("_closed") & (end_depth == 0)).alias("_sound"),
    )


def _with_elements(runs: DataFrame, judged: Column) -> DataFrame:
    """Runs with ``_elements``, each as text, and their number ``_n``. A run starts
    with the opening bracket (at depth 0) or a comma and, if it is the file's last,
    ends with the closing bracket; where it does not, or holds no JSON, _elements is
    null and the run counts as one. Only runs that are ``judged`` are parsed; those
    with elements need no text any more."""
    bare = r"^\s+|\s+$"
    none = F.array().cast("array<string>")
    first = F.col("_depth") == 0
    whole = runs.withColumn("_t", F.regexp_replace("_text", bare, ""))
    whole = whole.withColumn("_body", F.when(F.col("_last"), F.regexp_replace("_t", r"\]$", "")).otherwise(F.col("_t")))
    cut_off = F.col("_last") & (F.col("_t") != "") & ~F.endswith("_t", F.lit("]"))
    inner = F.regexp_replace(F.substr("_body", F.lit(2)), bare, "")
    parsed = F.from_json(F.concat(F.lit("["), inner, F.lit("]")), "array<string>", {"allowUnquotedControlChars": "false"})
    found = F.when(F.col("_body") == "", none).when(
        F.startswith("_body", F.when(first, F.lit("[")).otherwise(F.lit(","))), F.when(inner != "", parsed).when(first, none)
    )
    made = whole.withColumn("_elements", F.when(judged & ~cut_off, found)).drop("_t", "_body")
    n = F.when(judged, F.when(F.col("_elements").isNull(), 1).otherwise(F.size("_elements"))).otherwise(0)
    return made.withColumns({"_n": n.cast("bigint"), "_text": F.when(F.col("_elements").isNull(), F.col("_text"))})


def json_array_elements(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(elements, lost) of JSON array files.

    elements: (_source_file, _source_row_no, _line): every element as its own text,
    numbered from 1 in its file. lost, with the same columns: what stands between two
    separators but is no JSON, or behind no separator, which counts as one element;
    and at place 0 the text of files that do not end as an array, in pieces of one
    split at most.
    """
    pieces = _json_pieces(spark, path)
    sums = {c: F.coalesce(F.sum(c).over(_before(_SPLIT, "_mid")), F.lit(0)) for c in ("_a", "_b")}
    # A split's last piece is the file's last in its last split.
    tail = F.lead(F.lit(False), 1, True).over(Window.partitionBy(*_SPLIT).orderBy("_mid"))
    splits = written(_json_splits(pieces), "array-splits")
    placed = pieces.withColumns({"_sum_a": sums["_a"], "_sum_b": sums["_b"], "_tail": tail}).join(splits, list(_SPLIT))
    depth = F.col("_depth") + F.when(F.col("_in"), F.col("_sum_b")).otherwise(F.col("_sum_a"))
    placed = placed.withColumns({"_depth": depth, "_opens": ~_xor(F.col("_in"), F.col("_odd")) & (depth <= 1)})
    keyed = placed.withColumn("_key", F.max(F.when(F.col("_opens"), F.col("_mid"))).over(_upto(_SPLIT, "_mid")))
    same = ("_fresh_after", "_sound", "_last_block", "_closed")
    runs = keyed.groupBy(*_SPLIT, "_key").agg(
        _texts("}").alias("_text"), F.min_by("_depth", "_mid").alias("_depth"), F.max("_tail").alias("_tail"), *[F.first(c).alias(c) for c in same]
    )
    last = F.col("_tail") & (F.col("_block") == F.col("_last_block"))
    text = F.concat("_text", F.when(last & ~F.col("_closed"), F.lit("")).otherwise(F.lit("}")))
    whole = F.col("_key").isNotNull() & (~F.col("_tail") | F.col("_fresh_after"))
    shaped = runs.select(*_SPLIT, "_key", text.alias("_text"), "_depth", last.alias("_last"), whole.alias("_whole"), "_sound")
    counted = _with_elements(shaped, F.col("_sound") & F.col("_whole")).withColumn(
        "_ahead", F.coalesce(F.sum("_n").over(_before(_SPLIT, "_key")), F.lit(0))
    )
    stored = written(counted, "array-runs")

    order = Window.partitionBy("_source_file").orderBy("_block", "_key")
    fragments = stored.where("_sound and not _whole").withColumn("_group", F.sum(F.col("_key").isNotNull().cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.struct("_block", F.coalesce("_key", F.lit(-1)).alias("key"))
    joined = fragments.groupBy("_source_file", "_group").agg(
        F.min("_block").alias("_block"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("p"), F.col("_text").alias("t")))), lambda x: x["t"]), "").alias("_text"),
        F.min_by("_depth", place).alias("_depth"),
        F.max("_last").alias("_last"),
        F.min_by("_ahead", place).alias("_ahead"),
    )
    stitched = _with_elements(joined, F.lit(True)).select(*_SPLIT, "_elements", "_text", "_n", "_ahead")
    ready = stored.where("_sound and _whole").select(*_SPLIT, "_elements", "_text", "_n", "_ahead").unionByName(stitched)

    totals = ready.groupBy(*_SPLIT).agg(F.sum("_n").alias("_n"))
    base = written(totals.select(*_SPLIT, F.coalesce(F.sum("_n").over(_before(("_source_file",), "_block")), F.lit(0)).alias("_base")), "array-bases")
    numbered = ready.join(base, list(_SPLIT)).withColumn("_from", F.col("_base") + F.col("_ahead") + 1)
    items = F.transform("_elements", lambda x: F.coalesce(x, F.lit("null")))
    elements = numbered.select("_source_file", "_from", F.posexplode(items).alias("_pos", "_line")).select(
        "_source_file", (F.col("_from") + F.col("_pos")).alias("_source_row_no"), "_line"
    )
    wrong = numbered.where("_elements is null").select("_source_file", F.col("_from").alias("_source_row_no"), F.col("_text").alias("_line"))
    parts = F.array_sort(F.collect_list(F.struct(F.coalesce("_key", F.lit(-1)).alias("key"), F.col("_text").alias("t"))))
    lost = stored.where("not _sound").groupBy(*_SPLIT).agg(F.array_join(F.transform(parts, lambda x: x["t"]), "").alias("_line"))
    broken = wrong.unionByName(lost.select("_source_file", F.lit(0).cast("bigint").alias("_source_row_no"), "_line"))
    return elements, broken.withColumn("_line", F.regexp_replace("_line", r"^\s+|\s+$", "")).where("_line <> ''")


# ------------------------------------------------------------------- CSV records


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(_source_file, _first, _open, _record): every record of CSV files, its line
    ends inside quotes kept (as \\n); _first marks a file's first one (the header),
    _open a record, or a fragment of it, that the file's end leaves open. Empty lines
    are no records."""
    lines = scanned(spark, path, "\n").withColumn("value", F.regexp_replace("value", "\r$", ""))
    ends = lines.withColumns({"_e0": F.col("value").rlike(_OPEN_FIELD), "_e1": F.concat(F.lit('"'), "value").rlike(_OPEN_FIELD)})
    functions = ends.select(
        *_SPLIT,
        "_mid",
        "value",
        F.when(F.col("_e0") == F.col("_e1"), F.col("_e0")).alias("_const"),
        (F.col("_e0") & ~F.col("_e1")).alias("_flip"),
    )
    own = _state_before(functions, _SPLIT, "_mid")

    file = ("_source_file",)
    along = Window.partitionBy(*file).orderBy("_block")
    after = F.struct(F.coalesce("_const", "_known").alias("known"), F.when(F.col("_const").isNotNull(), False).otherwise(_xor(F.col("_odd"), F.col("_flip"))).alias("odd"))
    per = own.groupBy(*_SPLIT).agg(F.max_by(after, "_mid").alias("f"))
    per = per.select(*_SPLIT, _xor(F.col("f.known"), F.col("f.odd")).alias("_const"), (F.col("f.known").isNull() & F.col("f.odd")).alias("_flip"))
    starts = _state_before(per, file, "_block").withColumn("_in", _xor(F.coalesce("_known", F.lit(False)), F.col("_odd")))
    end = F.coalesce("_const", _xor(F.col("_in"), F.col("_flip")))
    splits = starts.select(
        *_SPLIT,
        "_in",
        F.coalesce(~F.lead("_in").over(along), ~end).alias("_fresh_after"),
        F.last(end).over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_unclosed"),
    )

    tail = F.lead(F.lit(False), 1, True).over(Window.partitionBy(*_SPLIT).orderBy("_mid"))
    first = F.lag(F.lit(False), 1, True).over(Window.partitionBy(*_SPLIT).orderBy("_mid")) & (F.col("_block") == 0)
    placed = own.withColumns({"_tail": tail, "_first": first}).join(written(splits, "csv-splits"), list(_SPLIT))
    inside = _xor(F.coalesce("_known", F.col("_in")), F.col("_odd"))
    keyed = placed.withColumn("_key", F.max(F.when(~inside, F.col("_mid"))).over(_upto(_SPLIT, "_mid")))
    runs = keyed.groupBy(*_SPLIT, "_key").agg(
        _texts("\n").alias("_record"), *[F.max(c).alias(c) for c in ("_tail", "_first")], *[F.first(c).alias(c) for c in ("_fresh_after", "_unclosed")]
    )
    stored = written(runs.withColumn("_whole", F.col("_key").isNotNull() & (~F.col("_tail") | F.col("_fresh_after"))), "csv-runs")

    order = Window.partitionBy(*file).orderBy("_block", "_key")
    fragments = stored.where("not _whole").withColumn(
        "_group", F.sum(F.col("_key").isNotNull().cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    left_open = F.col("_unclosed") & (F.col("_group") == F.max("_group").over(Window.partitionBy(*file)))
    fragments = fragments.withColumn("_open", left_open)
    parts = F.array_sort(F.collect_list(F.struct("_block", F.coalesce("_key", F.lit(-1)).alias("key"), "_record")))
    joined = fragments.where("not _open").groupBy(*file, "_group").agg(
        F.array_join(F.transform(parts, lambda x: x["_record"]), "\n").alias("_record"), F.max("_first").alias("_first"), F.lit(False).alias("_open")
    )
    columns = [*file, "_first", "_open", "_record"]
    done = stored.where("_whole").withColumn("_open", F.lit(False)).select(*columns)
    records = done.unionByName(joined.select(*columns)).unionByName(fragments.where("_open").select(*columns))
    return records.where("_first or trim(_record) <> ''")
