"""Benchmark decontamination over a positional inverted index.

The index stores (document, position, term) postings of the training tokens
whose term occurs in any benchmark item. A benchmark window is looked up from
its rarest terms: the posting lists of its two least frequent words are
adjusted by their offsets in the item and intersected, which leaves almost only
true occurrences; these are then compared word by word with the document. All
of it is DataFrame work: the only broadcast sides are small tables that the
planner finds to be small from their files.

Proximity matches are looked up from the same lists: a window is near where all but
a fifth of its words stand within ``slop`` places of one alignment, so that their
offset-adjusted places span no more than that. Of any two more of its rarest words
than may be missing, two must be there; their lists, dealt into cells of slop + 1
places, give the candidates, which are then counted out in the document.

Results depend on a document's text alone. Rows are joined back by (doc_id,
text hash), so a null or repeated doc_id does no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import cut, word_array

#: Words in a window.
WINDOW = 10


def _keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows as struct r, with the two columns that they are joined by (null
    ids share a number)."""
    return documents.select(
        F.struct("*").alias("r"), F.coalesce(F.col(id_col), F.lit(-1)).cast("long").alias("did"), F.xxhash64(text_col).alias("h")
    )


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(iid, item_ids, words): the distinct word sequences of the items and the
    ids that have them. Items without words are left out; a null item_id keeps
    its words but adds no id."""
    words = benchmark.select("item_id", word_array(F.col("text")).alias("words")).where(F.size("words") > 0)
    distinct = words.groupBy("words").agg(F.collect_set("item_id").alias("item_ids"))
    return cut(distinct.select(F.monotonically_increasing_id().alias("iid"), "item_ids", "words"), "benchmark-items")


def benchmark_terms(items: DataFrame) -> DataFrame:
    """(term, tid): the distinct words of the items."""
    terms = items.select(F.explode("words").alias("term")).distinct()
    return cut(terms.select("term", F.monotonically_increasing_id().alias("tid")), "benchmark-terms")


def build_index(documents: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, h, pos, tid): every place of a term in the documents, words from 0."""
    docs = _keyed(documents, id_col, text_col)
    tokens = docs.select("did", "h", F.posexplode(word_array(F.col("r")[text_col])).alias("pos", "term"))
    return cut(tokens.join(terms, "term").select("did", "h", "pos", "tid"), "postings")


def rarest_places(items: DataFrame, terms: DataFrame, index: DataFrame, window: int, n_rarest: int = 2) -> tuple[DataFrame, DataFrame]:
    """(windows, places): the windows whose terms all occur in the documents, as
    (iid, item_ids, start, words, anchors) with the item positions of their
    rarest terms, and the distinct (tid, iid, ipos) of those positions."""
    counts = index.groupBy("tid").agg(F.count("*").alias("n"))
    known = terms.join(counts, "tid")
    placed = (
        items.select("iid", F.posexplode("words").alias("ipos", "term"))
        .join(known, "term", "left")
        .groupBy("iid")
        .agg(F.sort_array(F.collect_list(F.struct("ipos", F.coalesce("n", F.lit(0)).alias("n"), "tid"))).alias("ps"))
    )
    last = F.greatest(F.size("words") - window, F.lit(0))
    within = F.sequence(F.lit(0), F.least(F.size("words"), F.lit(window)) - 1)

    def at(start: Column) -> Column:
        # Element by element: a slice, or the item beside each of its windows, would copy all of a long item every time.
        return F.struct(
            start.alias("start"),
            F.transform(within, lambda i: F.get("words", start + i)).alias("words"),
            F.transform(within, lambda i: F.get("ps", start + i)).alias("ps"),
        )

    wins = (
        items.join(placed, "iid")
        .select("iid", "item_ids", F.explode(F.transform(F.sequence(F.lit(0), last), at)).alias("w"))
        .select("iid", "item_ids", "w.*")
        .where(~F.exists("ps", lambda p: p["n"] == 0))
    )
    by_count = F.array_sort(F.transform("ps", lambda p: F.struct(p["n"].alias("n"), p["ipos"].alias("ipos"), p["tid"].alias("tid"))))
    wins = cut(wins.select("iid", "item_ids", "start", "words", F.slice(by_count, 1, n_rarest).alias("rare")), "windows")
    places = cut(wins.select("iid", F.explode("rare").alias("r")).select("r.tid", "iid", "r.ipos").distinct(), "anchors")
    return wins.select("iid", "item_ids", "start", "words", F.transform("rare", lambda r: r["ipos"]).alias("anchors")), places


def _aligned(index: DataFrame, places: DataFrame) -> DataFrame:
    """(did, h, iid, diag, at): where item ``iid`` would start in the document for
    the postings of its anchors to fit, and the item positions that do."""
    hits = index.join(places, "tid").select("did", "h", "iid", (F.col("pos") - F.col("ipos")).alias("diag"), "ipos")
    return hits.groupBy("did", "h", "iid", "diag").agg(F.collect_set("ipos").alias("at"))


def phrase_candidates(index: DataFrame, windows: DataFrame, places: DataFrame) -> DataFrame:
    """(did, h, cands): by document, the windows whose rarest terms stand at the
    right distance, with the word index where each would start."""
    # An item shorter than a window can have a single anchor; others need two.
    single = windows.select("iid", (F.size("anchors") < 2).alias("one")).groupBy("iid").agg(F.max("one").alias("one"))
    met = _aligned(index, places).join(single, "iid").where("one or size(at) > 1")
    # Windows are met by item and anchor place, so that no place of an item is held against all its windows.
    asked = windows.select("iid", "start", F.size("anchors").alias("need"), F.explode("anchors").alias("ipos"))
    full = (
        met.select("did", "h", "iid", "diag", F.explode("at").alias("ipos"))
        .join(asked, ["iid", "ipos"])
        .where(F.col("diag") + F.col("start") >= 0)
        .groupBy("did", "h", "iid", "diag", "start")
        .agg(F.count("*").alias("n"), F.first("need").alias("need"))
        .where("n = need")
    )
    alive = full.join(windows, ["iid", "start"])
    cand = F.struct((F.col("diag") + F.col("start")).alias("at"), "words", "item_ids")
    return alive.groupBy("did", "h").agg(F.collect_list(cand).alias("cands"))


def may_miss(size: Column) -> Column:
    """How many of a window's words a proximity match may lack: a fifth."""
    return F.floor(size / 5).cast("int")


def near_windows(items: DataFrame, terms: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """(iid, item_ids, start, words, anchors, need): every window that can still have a
    proximity match, absent words or not, with its rarest places, two more than may be
    missing (at most as many as it has words), and how many of these must be met."""
    counts = index.groupBy("tid").agg(F.count("*").alias("n"))
    placed = (
        items.select("iid", F.posexplode("words").alias("ipos", "term"))
        .join(terms.join(counts, "tid"), "term", "left")
        .groupBy("iid")
        .agg(F.sort_array(F.collect_list(F.struct("ipos", F.coalesce("n", F.lit(0)).alias("n")))).alias("ps"))
    )
    last = F.greatest(F.size("words") - window, F.lit(0))
    within = F.sequence(F.lit(0), F.least(F.size("words"), F.lit(window)) - 1)

    def at(start: Column) -> Column:
        rare = F.transform(within, lambda i: F.struct(F.get("ps", start + i)["n"].alias("n"), (start + i).alias("ipos")))
        return F.struct(start.alias("start"), F.transform(within, lambda i: F.get("words", start + i)).alias("words"), F.array_sort(rare).alias("rare"))

    wins = items.join(placed, "iid").select("iid", "item_ids", F.explode(F.transform(F.sequence(F.lit(0), last), at)).alias("w")).select("iid", "item_ids", "w.*")
    missing = may_miss(F.size("words"))
    absent = F.size(F.filter("rare", lambda r: r["n"] == 0))
    asked = F.least(missing + 2, F.size("words"))
    ready = wins.where(absent <= missing).select(
        "iid", "item_ids", "start", "words", F.transform(F.slice("rare", F.lit(1), asked), lambda r: r["ipos"]).alias("anchors"), (asked - missing).alias("need")
    )
    return cut(ready, "near-windows")


def near_candidates(index: DataFrame, items: DataFrame, terms: DataFrame, windows: DataFrame, slop: int) -> DataFrame:
    """(did, h, near): by document, the ``near_windows`` of whose rarest words enough
    stand within two neighbouring cells of slop + 1 offset-adjusted places, with the
    word index where the window would start at the first of these places."""
    places = windows.select("iid", F.explode("anchors").alias("ipos")).distinct()
    of_term = items.select("iid", F.posexplode("words").alias("ipos", "term")).join(terms, "term").join(places, ["iid", "ipos"]).select("tid", "iid", "ipos")
    cell = F.floor((F.col("pos") - F.col("ipos")) / (slop + 1))
    met = (
        index.join(cut(of_term, "near-anchors"), "tid")
        .select("did", "h", "iid", "ipos", F.explode(F.array(cell - 1, cell)).alias("cell"))
        .groupBy("did", "h", "iid", "cell")
        .agg(F.collect_set("ipos").alias("at"))
    )
    least = windows.groupBy("iid").agg(F.min("need").alias("least"))
    asked = windows.select("iid", "start", "need", F.explode("anchors").alias("ipos"))
    full = (
        met.join(least, "iid")
        .where(F.size("at") >= F.col("least"))
        .select("did", "h", "iid", "cell", F.explode("at").alias("ipos"))
        .join(asked, ["iid", "ipos"])
        .groupBy("did", "h", "iid", "cell", "start")
        .agg(F.count("*").alias("n"), F.first("need").alias("need"))
        .where("n >= need")
    )
    cand = F.struct((F.col("cell") * (slop + 1) + F.col("start")).cast("int").alias("at"), "words", "item_ids")
    return full.join(windows, ["iid", "start"]).groupBy("did", "h").agg(F.collect_list(cand).alias("near"))


def _is_near(words: Column, c: Column, slop: int) -> Column:
    """Does a candidate hold in a document of these words, from some place of its first
    cell on?"""
    m = F.size(c["words"])

    def there(start: Column) -> Column:
        one = lambda x, i: F.exists(F.sequence(F.lit(0), F.lit(slop)), lambda t: F.coalesce(F.get(words, start + i + t) == x, F.lit(False)))
        return F.size(F.filter(F.transform(c["words"], one), lambda ok: ok)) >= m - may_miss(m)

    return F.exists(F.sequence(F.lit(0), F.lit(slop)), lambda d: there(c["at"] + d))


def _hits(documents: DataFrame, benchmark: DataFrame, window: int, id_col: str, text_col: str, slop: int | None = None) -> DataFrame:
    """(r, n_words, hits): the rows, and the windows that truly occur in them as
    (at, words, item_ids); with ``slop`` also near: the item_ids of windows that are
    near in them."""
    items = benchmark_items(benchmark)
    terms = benchmark_terms(items)
    index = build_index(documents, terms, id_col, text_col)
    windows, places = rarest_places(items, terms, index, window)
    found = phrase_candidates(index, windows, places)
    if slop is not None:
        about = near_windows(items, terms, index, window)
        found = found.join(near_candidates(index, items, terms, about, slop), ["did", "h"], "full")
    found = cut(found, "contaminated")
    joined = _keyed(documents, id_col, text_col).join(found, ["did", "h"], "left")
    none = F.array().cast(found.schema["cands"].dataType)

    def look(w: Column) -> Column:
        # Word by word: a slice would copy the whole of a long document for each candidate.
        def equal(c: Column) -> Column:
            return F.forall(F.transform(c["words"], lambda x, i: F.get(w, c["at"] + i) == x), lambda ok: F.coalesce(ok, F.lit(False)))

        shown = [F.size(w).cast("long").alias("n_words"), F.coalesce(F.filter("cands", equal), none).alias("hits")]
        if slop is not None:
            near = F.filter("near", lambda c: _is_near(w, c, slop))
            shown.append(F.coalesce(F.flatten(F.transform(near, lambda c: c["item_ids"])), F.array()).alias("near"))
        return F.struct(*shown)

    # The words are a lambda's argument, so that they are made once a row, not once a candidate.
    looked = F.get(F.transform(F.array(word_array(F.col("r")[text_col])), look), F.lit(0))
    return joined.select("r", looked.alias("x")).select("r", "x.*")


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", slop: int | None = None
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, item_ids, spans; with
    ``slop`` also near_ids.

    A window is ``window`` consecutive words of an item, or the whole of a
    shorter item. ``n_hit`` counts the document's words inside any occurrence of
    a window, ``item_ids`` holds the ids (sorted as strings) of the items with
    occurring windows, ``spans`` the sorted (start, words) of the occurrences.
    ``near_ids`` holds the ids, sorted likewise, of the items with a window that is
    near: of its places all but a fifth (rounded down) can be met by its words in the
    document within ``slop`` places of one alignment.
    Null, empty and wordless texts have no words and no hits; an empty benchmark
    hits nothing. Rows that repeat stay; other columns are passed over.
    """
    exact = _hits(documents.select(id_col, text_col), benchmark, window, id_col, text_col, slop)
    near = [] if slop is None else [_sorted_ids(F.col("near")).alias("near_ids")]
    covered = F.transform("hits", lambda c: F.sequence(c["at"], c["at"] + F.size(c["words"]) - 1))
    ids = _sorted_ids(F.flatten(F.transform("hits", lambda c: c["item_ids"])))
    # As one number each: distinct numbers are found by hash, distinct structs are not.
    packed = F.array_sort(F.array_distinct(F.transform("hits", lambda c: F.shiftleft(c["at"].cast("long"), 31) + F.size(c["words"]))))
    spans = F.transform(
        packed,
        lambda x: F.struct(F.shiftright(x, 31).cast("int").alias("start"), x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("words")),
    )
    return exact.select(
        F.col("r")[id_col].alias("doc_id"),
        "n_words",
        F.size(F.array_distinct(F.flatten(covered))).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        ids.alias("item_ids"),
        spans.alias("spans"),
        *near,
    )


def _sorted_ids(ids: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(ids, lambda i: i.cast("string"))))


def clean_documents(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents, all their columns, in which no window occurs. Null and empty
    texts stay; rows that repeat stay or go together; an empty benchmark or table
    takes none away."""
    return _hits(documents, benchmark, window, id_col, text_col).where(F.size("hits") == 0).select("r.*")


def proximity_matches(documents: DataFrame, benchmark: DataFrame, slop: int, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id), distinct, of the items with a window that is near in a
    document, with ``slop`` (see ``contamination``). Exact phrases are among them;
    documents without one and items without an id have no row."""
    found = contamination(documents, benchmark, window, slop=slop)
    return found.select("doc_id", F.explode("near_ids").alias("item_id")).distinct()
