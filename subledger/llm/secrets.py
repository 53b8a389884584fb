"""Secret scan with DataFrame functions alone.

Three base patterns (assignments, access keys, hex runs) give spans of their
own. Further spans come from two character Markov models: one of random strings,
trained on what the base patterns caught, one of ordinary identifiers, trained
on the other words of texts. Any token of 12 or more characters that no base span
holds whole is a secret if the log-likelihood ratio of its character pairs, per pair,
is above the threshold of its length, which the ordinary tokens of the texts
without base spans set: all but one in a thousand of them lie below.

Positions come from the text itself: matches are wrapped in two control
characters, the text is split at them, and running sums of the pieces' lengths
are the starts. No pattern can match a control character or a line end.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import cut

#: Base patterns (fixed values). Hex runs and access keys are maximal runs of a
#: character class, so their least lengths can stand in the pattern; an
#: assignment's value is measured after the match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LENGTH = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")

#: Tokens that the models judge: whole ones of 12 or more of these characters.
_TOKEN = "A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![\p{{L}}\p{{N}}{_TOKEN}])[{_TOKEN}]{{12,}}+(?![\p{{L}}\p{{N}}])"
#: Least lengths of the classes of tokens that have a threshold each.
LENGTHS = (12, 16, 20, 32)
#: Share of the ordinary tokens of a class that lies below its threshold.
ORDINARY_SHARE = 0.999
#: Mean log-likelihood ratio of a pair that a threshold never falls below.
THRESHOLD = 0.3
#: Words that count as ordinary identifiers when the models are trained.
ORDINARY = rf"[{_TOKEN}]{{4,}}"

_OPEN, _CLOSE, _STAND_IN = "\x01", "\x02", "�"
_GROUP = 256
#: Characters of the models; any other one is class 0.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=.-"
_CLASSES = len(ALPHABET) + 1


def _starts(lengths: Column) -> Column:
    """Sum of all elements before each one; groups of _GROUP elements are summed
    first, so the work stays far below the square of their number."""
    groups = F.transform(F.sequence(F.lit(0), F.size(lengths) - 1, F.lit(_GROUP)), lambda i: F.slice(lengths, i + 1, _GROUP))

    def running(xs: Column, head: Column) -> Column:
        return F.aggregate(xs, F.array(head), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))

    totals = F.transform(groups, lambda g: F.aggregate(g, F.lit(0).cast("long"), lambda a, x: a + x))
    heads = running(totals, F.lit(0).cast("long"))
    return F.flatten(F.zip_with(groups, F.slice(heads, 1, F.size(groups)), lambda g, h: F.slice(running(g, h), 1, F.size(g))))


def _with_spans(df: DataFrame, out: str, kind: int, pattern: str, gate: Column, keep=None) -> DataFrame:
    """Add ``out``: array of (start, kind, end, value) of the matches of
    ``pattern`` in column _t, for texts that pass ``gate``; else empty."""
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string>>")
    marked = F.split(F.regexp_replace("_t", pattern, f"{_OPEN}$0{_CLOSE}"), _OPEN)
    df = df.withColumn("_seg", F.when(gate, marked))
    # The first piece has no closing mark, every other one has.
    df = df.withColumn("_len", F.transform("_seg", lambda x, i: F.char_length(x).cast("long") - F.when(i > 0, 1).otherwise(0)))
    df = df.withColumn("_at", F.when(F.size("_seg") > 1, _starts(F.col("_len"))))

    def span(x: Column, start: Column) -> Column:
        value = F.substring_index(x, _CLOSE, 1)
        return F.struct(
            start.alias("start"), F.lit(kind).alias("kind"), (start + F.char_length(value)).alias("end"), value.alias("value")
        )

    found = F.slice(F.zip_with("_seg", "_at", span), 2, F.size("_seg"))
    if keep is not None:
        found = F.filter(found, lambda s: keep(s["value"]))
    return df.withColumn(out, F.when(F.size("_seg") > 1, found).otherwise(none)).drop("_seg", "_len", "_at")


def _prepared(documents: DataFrame, text_col: str) -> DataFrame:
    """The documents with _t: the text, null as empty, without the control
    characters that serve as marks."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return documents.withColumn("_t", F.replace(F.replace(text, F.lit(_OPEN), F.lit(_STAND_IN)), F.lit(_CLOSE), F.lit(_STAND_IN)))


def _base(df: DataFrame) -> DataFrame:
    """Add _assign, _access and _hex, the spans of the base patterns."""
    low = F.lower("_t")
    named = F.lit(False)
    for word in ASSIGN_WORDS:
        named = named | F.contains(low, F.lit(word))
    long_value = lambda v: F.char_length(F.regexp_extract(v, ASSIGN, 2)) >= ASSIGN_LENGTH
    df = _with_spans(df, "_assign", 0, ASSIGN, named, long_value)
    df = _with_spans(df, "_access", 1, ACCESS, F.contains("_t", F.lit("AKIA")))
    return _with_spans(df, "_hex", 2, HEX, F.col("_t").rlike(HEX))


def _secret_part(span: Column) -> Column:
    """What a span's model learns from: an assignment's value, else the match."""
    return F.when(span["kind"] == 0, F.regexp_extract(span["value"], ASSIGN, 2)).otherwise(span["value"])


@dataclass(frozen=True)
class Markov:
    """Log-likelihood ratios (random against ordinary) of character pairs, by
    class of the first and of the second character, row by row, and the threshold
    of each class of ``LENGTHS``."""

    ratios: tuple[float, ...]
    thresholds: tuple[float, ...] = (THRESHOLD,) * len(LENGTHS)

    def is_secret(self, token: Column) -> Column:
        """Is the mean ratio of a token above the threshold of its length?"""
        least = F.lit(self.thresholds[0])
        for n, t in zip(LENGTHS[1:], self.thresholds[1:], strict=True):
            least = F.when(F.char_length(token) >= n, t).otherwise(least)
        return self.per_pair(token) > least

    def per_pair(self, token: Column) -> Column:
        """Mean ratio over the pairs of a token (of two characters or more)."""
        classes = [0] * 128
        for i, c in enumerate(ALPHABET):
            classes[ord(c)] = i + 1
        of = F.array(*[F.lit(c) for c in classes])
        ratio = F.array(*[F.lit(r) for r in self.ratios])

        def char(i: Column) -> Column:
            return F.coalesce(F.get(of, F.ascii(F.substring(token, i, F.lit(1)))), F.lit(0))

        pairs = F.char_length(token) - 1
        total = F.aggregate(
            F.sequence(F.lit(1), pairs), F.lit(0.0), lambda acc, i: acc + F.get(ratio, char(i) * _CLASSES + char(i + 1))
        )
        return total / pairs


def _strings(documents: DataFrame, text_col: str) -> DataFrame:
    """(k, s, n): every string that the models learn from, with the number of its
    places in the distinct texts: 1 the values of base spans, 0 the words of texts
    without base spans, 2 the tokens of those texts that a model would judge."""
    texts = _prepared(documents.where(F.col(text_col).isNotNull()).select(F.col(text_col)), text_col)
    # Copies are one text; they meet inside the scan tasks first.
    based = _base(texts.select("_t").distinct()).select("_t", F.concat("_assign", "_access", "_hex").alias("spans"))

    def marked(k: int, strings: Column) -> Column:
        return F.transform(strings, lambda s: F.struct(F.lit(k).alias("k"), s.alias("s")))

    free = [marked(k, F.regexp_extract_all("_t", F.lit(p), 0)) for k, p in ((0, ORDINARY), (2, CANDIDATE))]
    found = F.when(F.size("spans") > 0, marked(1, F.transform("spans", _secret_part))).otherwise(F.concat(*free))
    return based.select(F.explode(found).alias("x")).groupBy("x.k", "x.s").agg(F.count("*").alias("n"))


def train(documents: DataFrame, smoothing: float = 0.5, text_col: str = "text") -> Markov:
    """Count character pairs in labelled strings of all distinct texts: values of base
    spans are random strings, words of texts without base spans are ordinary; their
    tokens set the thresholds.

    At most 2 * 69 * 69 counts and one threshold for each length reach the driver.
    Without strings of one kind, smoothing alone speaks for it; without ordinary
    tokens of a length its threshold is THRESHOLD.
    """
    strings = cut(_strings(documents, text_col), "secret-strings")
    pairs = strings.where((F.col("k") < 2) & (F.char_length("s") > 1)).select(
        F.col("k").alias("y"),
        "n",
        F.explode(F.transform(F.sequence(F.lit(1), F.char_length("s") - 1), lambda i: F.substring(F.col("s"), i, F.lit(2)))).alias("pair"),
    )
    known = pairs.where(F.col("pair").rlike(f"^[.{_TOKEN}]{{2}}$"))
    counts = {(r["y"], r["pair"]): float(r["n"]) for r in known.groupBy("y", "pair").agg(F.sum("n").alias("n")).collect()}
    table = [0.0] * (_CLASSES * _CLASSES)
    for i, a in enumerate(ALPHABET, 1):
        after = [sum(counts.get((y, a + b), 0.0) for b in ALPHABET) + smoothing * len(ALPHABET) for y in (0, 1)]
        for j, b in enumerate(ALPHABET, 1):
            random, ordinary = ((counts.get((y, a + b), 0.0) + smoothing) / after[y] for y in (1, 0))
            table[i * _CLASSES + j] = round(math.log(random / ordinary), 6)
    model = Markov(tuple(table))
    classed = strings.where("k = 2").select(sum((F.char_length("s") >= n).cast("int") for n in LENGTHS).alias("c"), model.per_pair(F.col("s")).alias("r"))
    found = {r["c"]: r["q"] for r in classed.groupBy("c").agg(F.percentile_approx("r", ORDINARY_SHARE, 100_000).alias("q")).collect()}
    return Markov(model.ratios, tuple(max(THRESHOLD, found.get(i, THRESHOLD)) for i in range(1, len(LENGTHS) + 1)))


def scan_secrets(documents: DataFrame, model: Markov, text_col: str = "text", out: str = "spans") -> DataFrame:
    """The documents with ``out``: array of (start, kind, end) of all secrets, by
    start, then kind (see KINDS); code points from 0, end exclusive.

    Null and empty texts have none. Rows that repeat stay, other columns are kept
    (one named like ``out`` is replaced). No shuffle.
    """
    own = [c for c in documents.columns if c != out]
    # The row's columns travel in one struct, where no name can clash with those used here.
    held = documents.select(F.struct(*own).alias("_own"), F.col(text_col).alias("_text"))
    df = _base(_prepared(held, "_text"))
    df = _with_spans(df, "_cand", 3, CANDIDATE, F.col("_t").rlike(CANDIDATE))
    random = F.filter("_cand", lambda c: model.is_secret(c["value"]))
    plain = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    df = df.withColumn("_every", F.array_sort(F.transform(F.concat("_assign", "_access", "_hex", random), plain)))

    def free(every: Column) -> Column:
        """Without the tokens that a base span, which starts no later, holds whole."""
        ends = F.transform(every, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(F.lit(0).cast("long")))
        both = F.arrays_zip(every.alias("s"), _largest_before(ends).alias("e"))
        kept = F.filter(both, lambda x: (x["s"]["kind"] < 3) | (x["e"] < x["s"]["end"]))
        return F.transform(kept, lambda x: x["s"])

    return df.select("_own.*", F.when(F.size("_cand") > 0, free(F.col("_every"))).otherwise(F.col("_every")).alias(out))


def span_text(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _group_starts(values: Column) -> Column:
    """0, _GROUP, 2 * _GROUP and so on; 0 alone for an empty array."""
    return F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), F.lit(_GROUP))


def _largest_before(values: Column) -> Column:
    """The largest element before each one, 0 before the first; in groups, as
    ``_starts``."""

    def running(xs: Column, head: Column) -> Column:
        return F.aggregate(xs, F.array(head), lambda acc, x: F.array_append(acc, F.greatest(F.element_at(acc, -1), x)))

    def of(groups: Column) -> Column:
        heads = running(F.transform(groups, F.array_max), F.lit(0).cast("long"))
        return F.flatten(F.zip_with(groups, F.slice(heads, 1, F.size(groups)), lambda g, h: F.slice(running(g, h), 1, F.size(g))))

    return _let(F.transform(_group_starts(values), lambda i: F.slice(values, i + 1, _GROUP)), of)


def redact(text: Column, spans: Column, stand_in: str = "[SECRET]") -> Column:
    """The text with every stretch that ``spans`` (by start) cover, or touch one
    another in, replaced by one ``stand_in``; a text without spans as it is. To cut a
    piece out of a text costs the way to it, so a stretch is cut out for every
    _GROUP spans first, and their pieces out of that."""
    ends = F.transform(spans, lambda s: s["end"])
    gaps = F.zip_with(spans, _largest_before(ends), lambda s, c: F.struct(c.alias("from"), s["start"].alias("to")))

    def piece(g: Column, first: Column, base: Column, stretch: Column) -> Column:
        kept = F.substring(stretch, (g["from"] - base + 1).cast("int"), (g["to"] - g["from"]).cast("int"))
        return F.when(g["to"] > g["from"], F.concat(kept, F.lit(stand_in))).when(first, F.lit(stand_in)).otherwise(F.lit(""))

    def part(group: Column, i: Column) -> Column:
        base, size = F.get(group, F.lit(0))["from"], F.element_at(group, -1)["to"] - F.get(group, F.lit(0))["from"]
        stretch = F.substring(text, (base + 1).cast("int"), F.greatest(size, F.lit(0)).cast("int"))
        return _let(stretch, lambda x: F.array_join(F.transform(group, lambda g, k: piece(g, (i == 0) & (k == 0), base, x)), ""))

    parts = _let(gaps, lambda all_: F.transform(_group_starts(spans), lambda i: _let(F.slice(all_, i + 1, _GROUP), lambda group: part(group, i))))
    rest = F.substring(text, (F.array_max(ends) + 1).cast("int"), F.char_length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(text)


def without_secrets(documents: DataFrame, model: Markov, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The documents, all their columns, with secrets replaced in the text and the
    number of code points (where there is such a column) counted anew.

    Null and empty texts stay as they are; rows that repeat stay; an empty table
    gives an empty one; columns of any name pass through untouched.
    """
    held = documents.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    scanned = scan_secrets(held, model, "text", out="spans")
    clean = scanned.select("row", "spans", redact(F.col("text"), F.col("spans")).alias("clean"))
    new = {text_col: F.col("clean")}
    if size_col in documents.columns:
        size = F.when(F.size("spans") > 0, F.char_length("clean")).otherwise(F.col("row").getField(size_col))
        new[size_col] = size.cast(documents.schema[size_col].dataType)
    return clean.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in documents.columns])
